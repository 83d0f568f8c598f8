"""Bounded samples of labelled rows, for the operators that learn.

Labels are sampled before they meet the documents, at most ``rows_per_class`` of each class, those of the smallest hashed ids; so few are
broadcast. An id may stand for any number of documents, so what the join finds is bounded again, by rows and by
bytes, in order of the hashes of id and text. The first bound is pushed below the shuffle by Spark (a limit a group).

Defined cases: null ids, null labels and labels other than 0 and 1 are left out; a label that repeats counts each time; null
texts count as empty; texts of more than an eighth of ``bytes_per_class`` are not learnt from; of rows equal in id and text any may be in; empty tables give
no rows. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import column

#: Most bytes of the texts of each class.
BYTES_PER_CLASS = 32 << 20


def sample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    label_col: str,
    rows_per_class: int,
    bytes_per_class: int = BYTES_PER_CLASS,
    among: Callable[[Column], Column] | None = None,
) -> tuple[DataFrame, dict[int, int]]:
    """label, text, h and t (hashes, an order) of the sample; and how many labels of each class there are. ``among``: which ids may be in."""
    known = labels.select(column(labels, id_col).alias("id"), column(labels, label_col).try_cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    if among:
        known = known.where(among(F.col("id")))
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    first = [known.where(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(rows_per_class) for c in (0, 1)]
    rows = docs.select(column(docs, id_col).alias("key"), F.coalesce(column(docs, text_col).cast("string"), F.lit("")).alias("text"))
    found = (
        rows.join(F.broadcast(first[0].unionByName(first[1])), F.col("key") == F.col("id"))
        .select("label", "text", F.xxhash64("id").alias("h"), F.xxhash64("text").alias("t"), F.octet_length("text").alias("bytes"))
        .where(F.col("bytes") <= bytes_per_class // 8)
    )
    order = W.partitionBy("label").orderBy("h", "t")
    few = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= rows_per_class)
    few = few.withColumn("until", F.sum("bytes").over(order.rowsBetween(W.unboundedPreceding, 0))).where(F.col("until") <= bytes_per_class)
    return few.select("label", "text", "h", "t"), totals
