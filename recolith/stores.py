"""Stores as tasks see them: Spark's settings are the driver's, so paths are qualified there, and tasks open what they are given by its scheme."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession


def qualify(spark: SparkSession, path: str) -> str:
    """The path, which exists, by the URI of the store that has it. Without a scheme it is the default file system's, which tasks would take for their own disk."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).resolvePath(p).toString()


def file_system(uri: str) -> tuple[Any, str]:
    """pyarrow's file system and path of a URI or path."""
    from pyarrow import fs

    uri = uri.replace("s3a://", "s3://", 1)
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
