"""Importance resampling towards a target distribution, over hashed n-grams of words.

Every feature (a run of 1 to ``n`` consecutive words) falls into one of ``buckets``. The counts of all documents and of all target texts
give each bucket a gain, the logarithm of the ratio of its shares; a document weighs the mean gain of its features, Gumbel noise drawn from its id is added, and
the highest scores are the sample: drawing without replacement by weight.

Plan. Counting reads the texts twice, once for the buckets' totals and once for the weights. Texts beyond ``CHUNK`` bytes are cut at word boundaries into chunks that own the
features that start in them and carry the n - 1 words behind, so each feature is counted once; chunks are dealt over the cluster, and their counts and gains
summed by document. Shorter texts are one chunk, counted where they are read. A task adds up its counts by bucket before anything is shuffled. What
reaches the driver and is sent out are ``buckets`` numbers. Places by score are found without a window over all rows (``places``).

Defined cases: null and empty texts, and those without words, have no features and weigh 0; a row is a document of its own, whatever its id; rows that share an id
draw the same noise; a null id draws that of the empty text, and comes behind others of its score; ties in score go to smaller ids, then to fewer features, and of rows equal in these too any comes first. Long
texts that are equal in id and text are counted together, once a copy. Empty target texts leave gains of the corpus alone; an empty table gives no rows. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, materialise, private
from ..operators.places import placed

N, BUCKETS = 2, 10_000
#: Bytes of a text from which it is cut, and of the part that a chunk owns.
CHUNK = 32 << 10
LEAST_WORDS, PERCENT, SEED = 20, 25, 7
#: Any byte that is no part of a word becomes a blank, and A-Z a-z; bytes beyond ASCII are parts of words.
_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def chunks(text: str, n: int = N, size: int = CHUNK) -> Iterator[tuple[bytes, int]]:
    """Words of the text, parted by blanks, and how many bytes of them are the chunk's own: words that begin there are its features' starts."""
    data = text.encode().translate(_WORDS)
    at = 0
    while True:
        cut = data.find(b" ", at + size)
        if cut < 0:
            yield data[at:], len(data) - at
            return
        end, carried = cut, 0
        while carried < n - 1 and end < len(data):
            while data[end : end + 1] == b" ":
                end += 1
            end, carried = (data.find(b" ", end) if data.find(b" ", end) >= 0 else len(data)), carried + 1
        yield data[at:end], cut - at
        at = cut


def buckets_of(chunk: bytes, own: int, n: int = N, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Words that are the chunk's own, and the buckets of the features that start with them."""
    words = chunk.split()
    mine = len(words) if own == len(chunk) else len(chunk[:own].split())
    sums = [list(map(crc32, words[:mine]))]
    ahead = [b" " + w for w in words[1:]]
    for k in range(1, n):
        # a run's checksum goes on from that of the run without its last word
        sums.append(list(map(crc32, ahead[k - 1 : mine + k - 1], sums[-1])))
    return mine, np.array([s for run in sums for s in run], dtype=np.int64) % buckets


def _pieces(docs: DataFrame, id_col: str | None, text_col: str, n: int, size: int) -> tuple[DataFrame, DataFrame]:
    """id, text of the short texts; id, key, no, chunk and own of the chunks of long ones, dealt over the cluster. ``key`` stands for a long text."""
    id_ = column(docs, id_col).cast("long") if id_col else F.lit(None).cast("long")
    rows = docs.select(id_.alias("id"), F.coalesce(column(docs, text_col).cast("string"), F.lit("")).alias("text"))
    long = F.octet_length("text") > size

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                found = enumerate(chunks(b.column(2)[i].as_py(), n, size))
                while some := list(islice(found, 64)):
                    ids, keys = (b.column(j).take(pa.array([i] * len(some))) for j in (0, 1))
                    yield pa.RecordBatch.from_arrays([ids, keys, pa.array([no for no, _ in some]), pa.array([c for _, (c, _) in some], pa.binary()), pa.array([own for _, (_, own) in some])], names=["id", "key", "no", "chunk", "own"])

    keyed = rows.where(long).select("id", F.unhex(F.sha2("text", 256)).alias("key"), "text")
    dealt = keyed.mapInArrow(cut, "id long, key binary, no long, chunk binary, own long").repartition("id", "key", "no")
    return rows.where(~long), dealt


def totals(docs: DataFrame, text_col: str = "text", n: int = N, buckets: int = BUCKETS, size: int = CHUNK) -> np.ndarray:
    """How many features of all rows fall into each bucket."""
    short, long = _pieces(docs, None, text_col, n, size)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for i in range(b.num_rows):
                chunk = b.column(0)[i].as_py()
                own = b.column(1)[i].as_py() if b.num_columns > 1 else None
                data = chunk.encode().translate(_WORDS) if own is None else chunk
                found += np.bincount(buckets_of(data, len(data) if own is None else own, n, buckets)[1], minlength=buckets)
        at = np.flatnonzero(found)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["bucket", "n"])

    kind = "bucket long, n long"
    each = short.select("text").mapInArrow(add, kind).unionByName(long.select("chunk", "own").mapInArrow(add, kind))
    out = np.zeros(buckets, dtype=np.int64)
    for r in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket, in thousandths, rounded down; each bucket counts once more than it was seen."""
    s, t = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((float(b) + 1) * s / ((float(a) + 1) * t))) for a, b in zip(source, target, strict=True)], dtype=np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", n: int = N, size: int = CHUNK) -> DataFrame:
    """id_col, n_words, n_features and weight of each row."""
    short, long = _pieces(docs, id_col, text_col, n, size)
    kinds = "n_words long, n_features long, gain long"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            whole = b.schema.names[-1] == "text"
            rows = []
            for i in range(b.num_rows):
                data = b.column(b.num_columns - 1)[i].as_py().encode().translate(_WORDS) if whole else b.column(3)[i].as_py()
                mine, found = buckets_of(data, len(data) if whole else b.column(4)[i].as_py(), n, len(gain))
                rows.append((mine, len(found), int(gain[found].sum())))
            made = [pa.array([r[j] for r in rows], pa.int64()) for j in range(3)]
            kept = [] if whole else [b.column(1), b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), *kept, *made], names=["id", *([] if whole else ["key", "no"]), "n_words", "n_features", "gain"])

    one = short.mapInArrow(sums, f"id long, {kinds}")
    by_chunk = long.mapInArrow(sums, f"id long, key binary, no long, {kinds}")
    # rows equal in id and text are worked on together: each has one first chunk, and an equal share of the sums
    copies = F.count_if(F.col("no") == 0)
    summed = by_chunk.groupBy("id", "key").agg(copies.cast("int").alias("copies"), *[F.sum(c).alias(c) for c in ("n_words", "n_features", "gain")])
    each = summed.select("id", F.explode(F.array_repeat("copies", F.col("copies"))).alias("copies"), *[F.expr(f"{c} div copies").alias(c) for c in ("n_words", "n_features", "gain")])
    every = one.unionByName(each.drop("copies"))
    weight = F.expr("(gain - pmod(gain, greatest(n_features, 1))) div greatest(n_features, 1)")
    return every.select(F.col("id").alias(id_col), "n_words", "n_features", weight.alias("weight"))


def noise(id_: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, drawn by the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", n: int = N, buckets: int = BUCKETS, size: int = CHUNK, seed: int = SEED) -> DataFrame:
    """id_col, n_words, n_features, weight, score and rank (null where the row isn't drawn) of each row of ``docs``."""
    gain = gains(totals(docs, text_col, n, buckets, size), totals(target, target_text, n, buckets, size))
    scored = weigh(docs, gain, id_col, text_col, n, size).withColumn("score", F.col("weight") + noise(F.col(id_col), seed))
    scored = materialise(scored, "scores")
    fit = F.col("n_words") >= least_words
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last(), F.col("n_features").asc()]
    ranked = placed(scored.where(fit), order, "by-score")
    most = scored.where(fit).count() * percent // 100
    rank = F.when(F.col("__at") < most, F.col("__at") + 1)
    return ranked.select(*scored.columns, rank.alias("rank")).unionByName(scored.where(~fit).withColumn("rank", F.lit(None).cast("long")))


def digest(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The contract's columns."""
    return resample(docs, bench).select("doc_id", "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that are drawn, in columns as they were; ids must be keys there."""
    name = private(docs, "__drawn")
    chosen = resample(docs, target, id_col=id_col, text_col=text_col, **how).where("rank IS NOT NULL").select(F.col(id_col).alias(name))
    return docs.join(chosen, column(docs, id_col).cast("long") == F.col(name), "left_semi")


ORACLE = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n :: UBIGINT, list_transform(range(8), lambda x: x :: UBIGINT)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384 :: UBIGINT, c >> 1) ELSE c >> 1 END)) AS tbl
), d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), e AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), df AS (
  SELECT r, f, count(*) AS n FROM (SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d) GROUP BY r, f
), ef AS (
  SELECT f, count(*) AS n FROM (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM e) GROUP BY f
), v AS (
  SELECT f, xor(4294967295 :: UBIGINT, list_reduce(list_prepend(4294967295 :: UBIGINT, list_transform(range(octet_length(encode(f))), lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2)) :: UBIGINT)),
    lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) :: BIGINT + 1]))) % 10000 AS bucket FROM (SELECT f FROM df UNION SELECT f FROM ef), crc
), s AS (
  SELECT bucket, sum(n) AS n FROM df JOIN v USING (f) GROUP BY bucket
), t AS (
  SELECT bucket, sum(n) AS n FROM ef JOIN v USING (f) GROUP BY bucket
), g AS (
  SELECT range AS bucket, floor(1000 * ln((coalesce(t.n, 0) :: DOUBLE + 1) * (SELECT coalesce(sum(n), 0) + 10000 FROM s) :: DOUBLE / ((coalesce(s.n, 0) :: DOUBLE + 1) * (SELECT coalesce(sum(n), 0) + 10000 FROM t) :: DOUBLE))) :: BIGINT AS gain
  FROM range(10000) LEFT JOIN s ON s.bucket = range LEFT JOIN t ON t.bucket = range
), k AS (
  SELECT r, sum(n) :: BIGINT AS n_features, sum(n * gain) :: BIGINT AS total FROM df JOIN v USING (f) JOIN g USING (bucket) GROUP BY r
), x AS (
  SELECT doc_id, r, len(w) AS n_words, coalesce(n_features, 0) :: BIGINT AS n_features, coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) :: BIGINT AS weight,
    ('0x' || substr(sha256('7:' || coalesce(doc_id :: VARCHAR, '')), 1, 8)) :: BIGINT AS h FROM d LEFT JOIN k USING (r)
), y AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5 :: DOUBLE) / 4294967296))) :: BIGINT AS score FROM x
), z AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS rank, count(*) OVER () AS n FROM y WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank FROM y LEFT JOIN z USING (r)
"""
