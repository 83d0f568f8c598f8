"""Source coverage: counts by source, statuses, roll-ups by family, and checks of counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import collection_status, release_status


def citation_counts(*cited: DataFrame) -> DataFrame:
    """source and citations, over the citations arrays of all frames."""
    every = None
    for frame in cited:
        rows = frame.select(F.explode("citations.source").alias("source")).where("source IS NOT NULL")
        every = rows if every is None else every.unionByName(rows)
    return every.groupBy("source").agg(F.count("*").alias("citations"))


def coverage(catalog: DataFrame, snapshots: DataFrame, records: DataFrame, citations: DataFrame) -> DataFrame:
    """Catalog (source, family, inventory) full-outer observed counts (source, n): a row a source, with statuses."""
    seen = snapshots.select("source", F.col("n").alias("snapshots")).join(records.select("source", F.col("n").alias("records")), "source", "full_outer").join(citations.select("source", F.col("citations")), "source", "full_outer")
    rows = catalog.withColumn("cataloged", F.lit(True)).join(seen, "source", "full_outer")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return rows.select(
        "source",
        F.coalesce("family", F.lit("unclassified")).alias("family"),
        F.coalesce("cataloged", F.lit(False)).alias("cataloged"),
        zero("snapshots").alias("snapshots"),
        zero("records").alias("records"),
        zero("citations").alias("citations"),
        collection_status(F.col("snapshots"), F.col("records")).alias("collection_status"),
        release_status(F.col("inventory"), F.col("citations"), F.col("snapshots"), F.col("records")).alias("release_status"),
    )


def family_rollup(rows: DataFrame) -> DataFrame:
    """family, kind of status, status, n, and rows of the family. One grouping by family and both statuses, then small ones."""
    fine = rows.groupBy("family", "collection_status", "release_status").agg(F.count("*").alias("n"))
    total = fine.groupBy("family").agg(F.sum("n").alias("family_rows"))
    each = fine.select("family", F.explode(F.array(F.struct(F.lit("collection").alias("kind"), F.col("collection_status").alias("status")), F.struct(F.lit("release").alias("kind"), F.col("release_status").alias("status")))).alias("s"), "n")
    return each.groupBy("family", F.col("s.kind").alias("status_kind"), F.col("s.status").alias("status")).agg(F.sum("n").alias("n")).join(total, "family")


def relation_examples(relations: DataFrame, has_source: Column, position: Column) -> DataFrame:
    """kind and the first relation of it, one with a source if there is one."""
    return relations.groupBy("kind").agg(F.min_by(F.struct("from_id", "to_id"), F.struct((~has_source).alias("n"), position.alias("p"))).alias("e")).select("kind", "e.from_id", "e.to_id")


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("")).alias("value")).agg(F.count("*").alias("n"))


def checks(actual: DataFrame, expected: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, expected, actual, ok: a full outer join, so that what is missing on either side shows."""
    both = expected.select(*keys, F.col(value).alias("expected")).join(actual.select(*keys, F.col(value).alias("actual")), keys, "full_outer")
    return both.withColumn("ok", F.col("expected").eqNullSafe(F.col("actual")))


def uniqueness(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with n."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
