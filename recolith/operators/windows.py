"""Window-like computations: fill forward, first a key, changes against the first, paging budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def fill_forward(rows: DataFrame, partition: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: the last value that isn't null, up to the row. Partitions are pages or conversations, of bounded length."""
    w = W.partitionBy(*partition).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(w))


def first_per_key(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key: an aggregate, so that hot keys are reduced before the shuffle."""
    columns = [c for c in rows.columns if c not in keys]
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("row"))
    return first.select(*keys, "row.*").select(*rows.columns)


def longest_per_key(rows: DataFrame, keys: list[str], text: str, *order: Column) -> DataFrame:
    """keys and the longest text, the first of equal length."""
    return rows.groupBy(*keys).agg(F.min_by(text, F.struct((-F.length(text)).alias("n"), *order)).alias(text))


def differing_later(rows: DataFrame, keys: list[str], value: str, *order: Column) -> DataFrame:
    """Rows whose value is not that of their key's first row, with that as first_value."""
    first = rows.groupBy(*keys).agg(F.min_by(value, F.struct(*order)).alias("first_value"))
    return rows.join(first, keys).where(~F.col(value).eqNullSafe(F.col("first_value")))


def carried_base(sections: Column) -> Column:
    """Array of list items where ``(b)`` stands for the base before it: ``2-1(a), (b)`` gives ``2-1(a), 2-1(b)``."""
    start = F.struct(F.lit("").alias("base"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, item: Column) -> Column:
        short = item.rlike(r"^\([^)]+\)$") & (state["base"] != "")
        full = F.when(short, F.concat(state["base"], item)).otherwise(item)
        return F.struct(F.when(short, state["base"]).otherwise(F.regexp_replace(item, r"\([^)]+\)$", "")).alias("base"), F.concat(state["out"], F.array(full)).alias("out"))

    return F.aggregate(sections, start, step, lambda s: s["out"])
