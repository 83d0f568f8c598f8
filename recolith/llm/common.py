"""Shared pieces of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..stages import clean_up, fresh_path, materialise, shared_dir

__all__ = ["ascii_lower", "clean_up", "column", "fresh_path", "in_order", "materialise", "private", "read", "shared_dir", "small_side"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Most rows of a build side that is sent to every executor. Rows are keys and
#: short values, so this is some tens of MB; a larger side is joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Most bytes of a build side whose rows have no bound of their own.
BROADCAST_BYTES = 64 << 20


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if it has at most ``rows``
    rows; else as it is, for a shuffled join whose hot keys AQE splits."""
    return F.broadcast(df) if df.count() <= rows else df


def column(df: DataFrame, name: str) -> Column:
    """The column of that very name, dots and signs included."""
    return df["`" + name.replace("`", "``") + "`"]


def private(df: DataFrame, name: str) -> str:
    """A name that no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. ``lower`` is that too, and faster, where every character is ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def in_order(values: Column, value: Column) -> Column:
    """Whether ``value`` is in the sorted array ``values``, in as many steps as their number has binary digits."""
    n = F.size(values)
    powers = F.transform(F.sequence(F.length(F.bin(n)), F.lit(1), F.lit(-1)), lambda b: F.call_function("shiftleft", F.lit(1), b - 1))
    # how many of them are at most the value: a power of two is added while that holds
    below = F.aggregate(powers, F.lit(0), lambda at, p: F.when((at + p <= n) & (F.get(values, at + p - 1) <= value), at + p).otherwise(at))
    return F.coalesce(F.get(values, below - 1) == value, F.lit(False))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
