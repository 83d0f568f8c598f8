"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "recolith", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times and adaptive plans; on a cluster set shuffle partitions to its size."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    builder = builder.config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
