"""Document fingerprints: the ``K`` smallest hashes of a text's shingles (a bottom-k sketch).

A shingle is ``SHINGLE`` code points in a row, as they stand; a shorter text is one shingle, an empty one has none. A fingerprint is its hashes in ascending order, eight
little-endian bytes each, in base64. Fingerprints of parts that overlap by ``SHINGLE`` - 1 code points merge to that of the whole; very long texts are worked on in such parts. Two fingerprints
estimate resemblance (shingles of both among those of either) and containment, one the number of distinct shingles; of texts with at most ``K`` shingles these are exact.

Plan of ``against_next``. A text meets the next one in order of ids, so texts are shuffled once, in ranges of that order. The bounds come from a table of ids and hashes; the
first row of each range goes to the range before it too, so that every pair meets in one task, which reads its sorted rows as a stream and holds two texts. Nothing
but a bound a range reaches the driver.

Defined cases: null texts count as empty; two empty texts are alike (1), an empty and another are not (0); rows that share an id follow each other by a hash of
the text, null ids come last; equal rows are documents each, but those equal in id and text are all in one range; a table of one row has itself as its next; an empty table gives no rows. A very long text is held whole, and its hashes a
part at a time. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, materialise

K, SHINGLE = 128, 8
#: Code points whose hashes are made at once.
PART = 1 << 18
#: Bytes of text in a range, about, the most ranges, and how many of them a task has on average: ranges are dealt by a hash, and many small ones more evenly than few large ones.
RANGE_BYTES, MOST_RANGES, RANGES_A_TASK = 4 << 20, 100_000, 4
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over all places, one to one."""
    for shift, times in ((32, 0xD6E8FEB86659FD93), (29, 0xA0761D6478BD642F)):
        h = (h ^ h >> np.uint64(shift)) * np.uint64(times)
    return h ^ h >> np.uint64(32)


def smallest(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct ones, in order."""
    if len(hashes) > 8 * k:
        few = np.partition(hashes, 4 * k)[: 4 * k]
        found = np.unique(few)
        if len(found) >= k:  # what was left out is larger
            return found[:k]
    return np.unique(hashes)[:k]


def sketch(text: str, k: int = K, shingle: int = SHINGLE, part: int = PART) -> np.ndarray:
    found = np.zeros(0, dtype=np.uint64)
    for at in range(0, max(len(text) - shingle + 1, min(len(text), 1)), part):
        points = np.frombuffer(text[at : at + part + shingle - 1].encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        width = min(shingle, len(points))
        h = np.zeros(len(points) - width + 1, dtype=np.uint64)
        for j in range(width):
            h = h * _BASE + points[j : j + len(h)]
        found = smallest(np.concatenate([found, smallest(mixed(h), k)]), k)
    return found


def merged(sketches: list[np.ndarray], k: int = K) -> np.ndarray:
    return smallest(np.concatenate([np.zeros(0, dtype=np.uint64), *sketches]), k)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated over the smallest hashes of both together, which are a sample of all their shingles."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)
    if len(a) >= k or len(b) >= k:
        union = union[:k]
    return len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), union, assume_unique=True)) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """The share of a's shingles that b has, estimated where both sketches are complete: up to the last hash of a full one."""
    if not len(a):
        return 1.0
    bound = min([s[-1] for s in (a, b) if len(s) >= k], default=np.uint64(2**64 - 1))
    seen = a[a <= bound]
    return len(np.intersect1d(seen, b, assume_unique=True)) / len(seen) if len(seen) else 0.0


def distinct(a: np.ndarray, k: int = K) -> float:
    """Shingles of the text, estimated from how densely the smallest hashes lie."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1]) / 2.0**64)


def packed(s: np.ndarray) -> str:
    return base64.b64encode(s.astype("<u8").tobytes()).decode()


def unpacked(text: str | None) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text or ""), dtype="<u8").astype(np.uint64)


def fingerprint(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text column; null texts count as empty."""

    @F.pandas_udf("string")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series([packed(sketch(t, k, shingle)) for t in texts], dtype="object")

    return made(F.coalesce(text.cast("string"), F.lit("")))


def _of_two(value) -> object:
    def column_of(a: Column, b: Column, k: int = K) -> Column:
        @F.pandas_udf("double")
        def made(x: pd.Series, y: pd.Series) -> pd.Series:
            return pd.Series([value(unpacked(s), unpacked(t), k) for s, t in zip(x, y, strict=True)], dtype="float64")

        return made(a, b)

    return column_of


#: Estimates from two columns of fingerprints: (Column, Column, k) to Column.
likeness, contained = _of_two(resemblance), _of_two(containment)


def distinct_shingles(a: Column, k: int = K) -> Column:
    @F.pandas_udf("double")
    def made(x: pd.Series) -> pd.Series:
        return pd.Series([distinct(unpacked(s), k) for s in x], dtype="float64")

    return made(a)


def merge(parts: DataFrame, key: str, print_col: str = "fingerprint", k: int = K) -> DataFrame:
    """key and fingerprint: those of a key's parts as one. Tasks merge what they have first (at most 10,000 keys at a time), so a key's parts are no more than they are."""
    schema = f"`{key}` {parts.schema[key].dataType.simpleString()}, fingerprint string"
    rows = parts.select(column(parts, key), column(parts, print_col).alias("fingerprint"))

    def ahead(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for f in frames:
            for name, text in zip(f[key], f["fingerprint"], strict=True):
                name = None if pd.isna(name) else name
                held[name] = merged([held[name], unpacked(text)], k) if name in held else unpacked(text)
            if len(held) > 10_000:
                yield pd.DataFrame({key: list(held), "fingerprint": [packed(s) for s in held.values()]})
                held = {}
        yield pd.DataFrame({key: pd.Series(list(held), dtype="object"), "fingerprint": [packed(s) for s in held.values()]})

    def group(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({key: f[key].iloc[:1], "fingerprint": [packed(merged([unpacked(t) for t in f["fingerprint"]], k))]})

    some = rows.mapInPandas(ahead, schema)
    return some.groupBy(column(some, key)).applyInPandas(group, schema)


def against_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, shingle: int = SHINGLE, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of each row: the edited text has the
    start of the next row's, by descending id, in place of its last half."""
    id_ = column(docs, id_col).cast("long")
    rows = docs.select(id_.alias("id"), F.coalesce(column(docs, text_col).cast("string"), F.lit("")).alias("text"))
    # descending ids as ascending numbers
    rows = rows.select(F.col("id").isNull().alias("n"), F.bitwise_not(F.coalesce("id", F.lit(0).cast("long"))).alias("i"), F.xxhash64("text").alias("h"), "id", "text")
    keys = materialise(rows.select("n", "i", "h", F.octet_length("text").alias("bytes")), "fingerprint-keys")
    total = keys.agg(F.sum("bytes").alias("bytes")).first()["bytes"] or 0
    count = max(1, min(MOST_RANGES, -(-total // range_bytes)))
    part = F.spark_partition_id().alias("part")
    found = keys.repartitionByRange(count, "n", "i", "h").select(part, "n", "i", "h").groupBy("part").agg(F.min(F.struct("n", "i", "h")).alias("first")).collect()  # a row a range
    firsts = sorted(tuple(r["first"]) for r in found)

    @F.pandas_udf("array<int>")
    def dealt(n: pd.Series, i: pd.Series, h: pd.Series) -> pd.Series:
        out = []
        for row in zip(n, i, h, strict=True):
            at = bisect_right(firsts, row) - 1
            out.append([at, (at - 1) % len(firsts)] if firsts[at] == row else [at])
        return pd.Series(out, dtype="object")

    order = ["range", "borrowed", "n", "i", "h"]
    ranges = rows.withColumn("to", dealt("n", "i", "h")).select("n", "i", "h", "id", "text", F.posexplode("to").alias("borrowed", "range"))
    stream = ranges.repartition(max(1, len(firsts) // RANGES_A_TASK), "range").sortWithinPartitions(*order).select("range", "borrowed", "id", "text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, out = None, []
        for b in batches:
            for i in range(b.num_rows):
                at, borrowed, id_, text = (b.column(j)[i].as_py() for j in range(4))
                print_ = sketch(text, k, shingle)
                if before and before[0] == at and not before[1]:
                    _, _, own_id, own, own_print = before
                    half = len(own) // 2
                    edited = own[: len(own) - half] + text[:half]
                    edited_print = sketch(edited, k, shingle)
                    sha = hashlib.sha256(edited.encode()).hexdigest()
                    out.append((own_id, len(own), sha, packed(own_print), packed(edited_print), resemblance(own_print, edited_print, k), resemblance(own_print, print_, k)))
                before = (at, borrowed, id_, text, print_)
                if len(out) >= 512:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return stream.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return against_next(docs)
