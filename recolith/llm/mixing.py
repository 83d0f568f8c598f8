"""Mixing sources to target weights by systematic sampling.

Each source gets a target size; its documents share one expected number of copies
(target / size of the source). Their running sum along the source, plus one offset
drawn for the source, is emitted once per integer boundary crossed. Documents
run through a source by size class and then by hash, so a sample of any rate takes its share of every
size and its words come near the target. The sum is kept in whole units of 2 ** -``UNIT_BITS`` copies, so that
it is exact at any length and no document is taken more often than its rate rounded up.

The running sum is taken in two levels, so that no source is one group: documents
fall into buckets of (source, size class, first bits of the hash of id and text); windows number the rows inside a
bucket, and the bucket counts alone are summed up. The number of bits follows the number of rows; the order
of documents, and so the result, doesn't depend on it.
Sources are one row each; only that table of sources is sorted as a whole.

Defined cases: null texts have size 0 (taken counts 0 words); a null source is a source of
its own, last; rows that repeat an id are each a document; ties in size class and hash, which are rows equal in id and text, go by a hash of all columns kept,
and of rows equal in these too any may be taken; sources without words have target 0
and take nothing; an empty table gives none. A very long text is a row like others, the first or last of its source. Other columns play no
part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from .common import column, materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the hash by which a size class of a source is dealt into buckets: at least, at most, and the rows that ask for one more.
LEAST_BITS, MOST_BITS, ROWS_LOG2 = 8, 16, 14
#: A copy in the running sum's units, as a power of two.
UNIT_BITS = 30


def size_of(text: Column) -> Column:
    """Words in the text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def drawn(text: Column) -> Column:
    """A number in [0, 2 ** UNIT_BITS) drawn by the md5 of the text."""
    return F.shiftright(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), 32 - UNIT_BITS)


def crossed(start: Column, rate: Column, k: Column) -> Column:
    """Whole copies that the sum ``start + rate * k`` passes on the way from k to k + 1; units of 2 ** -UNIT_BITS.

    Only the sum's remainder matters, and that comes from the remainders of its factors: no product overflows.
    """
    mask = F.lit((1 << UNIT_BITS) - 1)
    rest = (start + rate.bitwiseAND(mask) * k.bitwiseAND(mask)).bitwiseAND(mask)
    return F.shiftright(rest + rate, UNIT_BITS)


def targets(sources: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """``sources`` (source, source_size) with target and rate.

    Filling by weight until ``share`` of all words is given out: a source is full at ``most`` times its
    size, and what it can't take goes to the others by weight. With sources in order of cap / weight the full ones come
    first, so running sums give the level at which the rest stops.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    by_fill = W.orderBy("fill", F.col("source").asc_nulls_last())
    everything = W.partitionBy()
    got = (
        sources.withColumn("weight", weight.cast("long"))
        .withColumn("cap", F.lit(float(most)) * F.col("source_size"))
        .withColumn("fill", F.col("cap") / F.col("weight"))
        .withColumn("total", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("full_before", F.coalesce(F.sum("cap").over(by_fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(by_fill.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("full_before")) / F.col("weight_left"))
        # the first source that the level doesn't fill has the right one; behind it they fall; none if all are full
        .withColumn("stop", F.max(F.when(F.col("level") < F.col("fill"), F.col("level"))).over(everything))
    )
    target = F.when(F.col("stop").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("stop")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return got.withColumn("target", target).withColumn("rate", rate).select("source", "source_size", "target", "rate")


def copies(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target and copies (how often the mix takes the document), and the columns ``keep`` as __keep, a struct of fields c0, c1 and so on."""
    kept = [column(docs, c) for c in keep]
    id_, text = column(docs, id_col), column(docs, text_col).cast("string")
    drawn_by = F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    rows = docs.select(id_.alias("doc_id"), column(docs, source_col).cast("string").alias("source"), size_of(text).alias("size"), drawn_by.alias("__h"), *([F.struct(*[c.alias(f"c{i}") for i, c in enumerate(kept)]).alias("__keep")] if kept else []))
    n = docs.select(F.lit(1)).count()
    bits = min(MOST_BITS, max(LEAST_BITS, (n >> ROWS_LOG2).bit_length()))
    # quarter powers of two
    rows = rows.withColumn("__class", F.floor(F.log2(F.col("size") + 1) * 4).cast("int")).withColumn("__sub", F.shiftright(F.conv(F.substring("__h", 1, 4), 16, 10).cast("int"), 16 - bits))
    buckets = materialise(rows.groupBy("source", "__class", "__sub").agg(F.count("*").alias("n"), F.sum("size").alias("words")), "mix-buckets")
    rates = targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    in_class, in_source = W.partitionBy("source", "__class").orderBy("__sub"), W.partitionBy("source").orderBy("__class")
    before = lambda col, w: F.coalesce(F.sum(col).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    classes = buckets.groupBy("source", "__class").agg(F.sum("n").alias("n")).withColumn("class_before", before("n", in_source)).drop("n")
    starts = buckets.withColumn("sub_before", before("n", in_class)).select("source", "__class", "__sub", "sub_before")
    starts = _null_safe(starts, classes, "source", "__class")
    starts = materialise(_null_safe(starts, materialise(rates, "mix-rates"), "source").withColumn("before", F.col("class_before") + F.col("sub_before")).drop("class_before", "sub_before"), "mix-starts")
    # nulls become an empty key beside a flag, so that the join is on plain equality
    ties = [F.xxhash64(*[F.col(f"__keep.c{i}") for i, c in enumerate(keep) if hashable(docs.schema[c].dataType)])] if keep else []
    place = W.partitionBy("__null", "__source", "__class", "__sub").orderBy("__h", *ties)
    keyed = lambda df: df.withColumn("__null", F.col("source").isNull()).withColumn("__source", F.coalesce("source", F.lit("")))
    numbered = keyed(rows).withColumn("__i", F.row_number().over(place))
    # the windows have dealt and sorted the rows by these keys already, so only the starts move
    joined = numbered.join(keyed(starts).drop("source"), ["__null", "__source", "__class", "__sub"])
    offset = drawn(F.concat(F.lit(f"{seed}:"), F.col("__source"), F.lit(":"), F.col("__null").cast("string")))
    rate = F.floor(F.col("rate") * F.lit(float(1 << UNIT_BITS))).cast("long")
    taken = crossed(offset, rate, F.col("before") + F.col("__i") - 1)
    return joined.select("doc_id", "source", "size", "source_size", "target", taken.alias("copies"), *(["__keep"] if keep else []))


def hashable(kind: DataType) -> bool:
    """Whether Spark hashes values of the type: maps and variants it doesn't."""
    return not any(x in kind.simpleString() for x in ("map<", "variant"))


def _null_safe(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Joins tables of sources and buckets, where nulls are a key like others."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys]
    return left.join(renamed, on).drop(*[f"__r_{k}" for k in keys])


def mix(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; columns as they were."""
    taken = copies(docs, keep=docs.columns, **how).where("copies > 0")
    repeated = taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*[F.col(f"__keep.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return copies(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) :: BIGINT AS size, md5(coalesce(doc_id :: VARCHAR, '') || ':' || coalesce(text, '')) AS h FROM documents
), c AS (
  SELECT *, floor(log2(size + 1) * 4) AS class FROM d
), s AS (
  SELECT source, sum(size) :: BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 2.0 :: DOUBLE * source_size AS cap, 1.5 :: DOUBLE * sum(source_size) OVER () AS total FROM s
), f AS (
  SELECT *, cap / weight AS fill,
    (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
), t AS (
  SELECT *, max(CASE WHEN level < fill THEN level END) OVER () AS stop FROM f
), r AS (
  SELECT source, source_size, coalesce(least(cap, weight * stop), cap) AS target FROM t
), n AS (
  SELECT c.*, r.source_size, target, floor(CASE WHEN r.source_size > 0 THEN target / r.source_size ELSE 0 END * 1073741824) :: BIGINT AS rate,
    row_number() OVER (PARTITION BY c.source ORDER BY class, h) - 1 AS k,
    ('0x' || substr(md5('17:' || coalesce(c.source, '') || ':' || CASE WHEN c.source IS NULL THEN 'true' ELSE 'false' END), 1, 8)) :: BIGINT // 4 AS u
  FROM c JOIN r ON c.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target, ((((u + rate % 1073741824 * (k % 1073741824)) % 1073741824 + rate) // 1073741824) * size) :: BIGINT AS taken FROM n
"""
