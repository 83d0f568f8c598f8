"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints (64 bits, over word shingles) are made in Arrow batches and written once;
from there on everything is Spark joins over distinct fingerprints, the classes of equal documents.

Search. The bits are dealt into m partitions, correlated bits together, and every
partition i gets a threshold t_i from -1 (skip it) upwards with sum t_i = distance - m + 1. Two
fingerprints within the distance then agree in some partition to within its t_i. Which
m and which thresholds: a dynamic programme over the estimated number of candidates,
which come from the exact sizes of the partitions' buckets. Probes (the values within t_i of
a fingerprint's own) are joined to the index, candidates verified by the bits in which they differ.

Hot buckets. A bucket of more than ``BUCKET`` fingerprints would give a quadratic
number of candidates. Its fingerprints are linked another way, exact too and linear: two
fingerprints differ in at most 2 bits if and only if one value lies within 1 bit of both, so each
gives out its 65 values within 1 bit, and a value's fingerprints, never more than 65, are
linked to the smallest of them.

Components come from alternating large and small stars, each round a written table.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; rows that
repeat a document id stay rows of their own, and share their component if their fingerprints do; a null id is never a
component's id unless all its ids are null; a bit set in exactly half of the shingles is 0; very long texts are hashed in pieces of ``_CHUNK`` shingles;
an empty table gives none. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import LOWER, UPPER, column, materialise, private, small_side

BITS = 64
SEED = 42
#: Fingerprints in a bucket from which on its links are found through shared neighbours.
BUCKET = 64
_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned; a bit is 1 if it is set in over half of the shingles' XXH64."""
    import xxhash

    words = (text or "").encode().translate(_LOWERED).split()  # bytes.split: blanks are 20 and 09-0D
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, _CHUNK):  # very long texts in pieces
        part = words[at : min(at + _CHUNK, n) + shingle - 1]
        joined = map(b" ".join, zip(*(part[i:] for i in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in joined), dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """id_col and fp, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found)], names=[id_col, "fp"])

    rows = docs.select(column(docs, id_col), column(docs, text_col).cast("string").alias("__text"))
    return rows.mapInArrow(run, StructType([rows.schema[0], StructField("fp", LongType())]))


# --- partitions and thresholds


def bit_agreement(reps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and 64 x 64 counts of those that have both bits; summed up on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for b in batches:
            x = np.unpackbits(np.ascontiguousarray(b.column(0).to_numpy(zero_copy_only=False)).view(np.uint8), bitorder="little").reshape(-1, BITS).astype(np.float32)
            total += x.T @ x
        at = np.arange(BITS * BITS, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel().astype(np.int64))], names=["at", "n"])

    both = np.zeros(BITS * BITS)
    for row in reps.select("fp").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # 4096 rows
        both[row["at"]] = row["n"]
    return reps.count(), both.reshape(BITS, BITS)


def partitions(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """The 64 bits in m groups of nearly equal size, each grown from the most correlated bits left."""
    p = both.diagonal() / max(n, 1)
    sd = np.sqrt(p * (1 - p))
    with np.errstate(divide="ignore", invalid="ignore"):
        corr = np.abs(np.nan_to_num((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd)))
    np.fill_diagonal(corr, 0)
    left, groups = list(range(BITS)), []
    for i in range(m):
        size = BITS * (i + 1) // m - BITS * i // m
        pair = corr[np.ix_(left, left)]
        first = left[int(pair.max(axis=1).argmax())]
        group = [first]
        left.remove(first)
        while len(group) < size:
            best = left[int(corr[np.ix_(left, group)].sum(axis=1).argmax())]
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def bits_of(fp: Column, bits: list[int]) -> Column:
    """The fingerprint with all other bits 0."""
    mask = sum(1 << b for b in bits)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def flips(bits: list[int], t: int) -> list[int]:
    """Signed masks of at most t of the bits."""
    out = [0]
    if t >= 1:
        out += [1 << b for b in bits]
    if t >= 2:
        out += [1 << a | 1 << b for i, a in enumerate(bits) for b in bits[:i]]
    if t >= 3:
        raise ValueError("thresholds go up to 2")
    return [x - (1 << 64) if x >> 63 else x for x in out]


def thresholds(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Dynamic programme: the cheapest thresholds, one of each partition's, whose sum is ``total``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for t, more in cost.items():
                if s + t not in step or c + more < step[s + t][0]:
                    step[s + t] = (c + more, [*ts, t])
        best = step
    return best[total]


def plan(reps: DataFrame, distance: int = 2, choices: tuple[int, ...] = (2, 3, 4)) -> list[tuple[list[int], int]]:
    """Partitions and their thresholds, those of -1 left out.

    Cost of a partition at threshold 0: its rows and the pairs in its buckets, exact from
    the bucket sizes (a hot bucket counts 65 for each fingerprint). At 1 and 2: the rows of its probes,
    and the pairs times how much likelier that many differing bits are than none, bits taken as independent.
    """
    n, both = bit_agreement(reps)
    groups = {m: partitions(n, both, m) for m in choices}
    all_groups = [(m, i, bits) for m in choices for i, bits in enumerate(groups[m])]
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), bits_of(F.col("fp"), bits).alias("value")) for k, (_, _, bits) in enumerate(all_groups)])).alias("p")
    sizes = reps.select(values).groupBy("p.k", "p.value").agg(F.count("*").cast("double").alias("c"))
    pairs = {r["k"]: r["pairs"] for r in sizes.groupBy("k").agg(F.sum(F.least(F.col("c") * (F.col("c") - 1) / 2, 65 * F.col("c"))).alias("pairs")).collect()}  # a row a group of bits
    p = both.diagonal() / max(n, 1)
    differ = 2 * p * (1 - p)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for m in choices:
        costs = []
        for k, (m_, _, bits) in enumerate(all_groups):
            if m_ != m:
                continue
            chance = np.zeros(len(bits) + 1)
            chance[0] = 1.0
            for b in bits:
                chance[1:] = chance[1:] * (1 - differ[b]) + chance[:-1] * differ[b]
                chance[0] *= 1 - differ[b]
            cost = {-1: 0.0}
            for t in range(distance + 1):
                more = chance[: t + 1].sum() / max(chance[0], 1e-300)
                cost[t] = n * len(flips(bits, t)) + pairs.get(k, 0.0) * more
            costs.append(cost)
        found, ts = thresholds(costs, distance - m + 1)
        if best is None or found < best[0]:
            best = found, [(bits, t) for bits, t in zip(groups[m], ts, strict=True) if t >= 0]
    return best[1]


# --- links


def links(reps: DataFrame, chosen: list[tuple[list[int], int]] | None = None, distance: int = 2, bucket: int = BUCKET) -> DataFrame:
    """u < v: pairs of fingerprints within the distance, as many as connect all that are. For distance 2.

    ``reps`` is a written table with distinct fp. Outside hot buckets all pairs are there.
    """
    if distance != 2:
        raise ValueError("hot buckets are linked through shared neighbours, which is for distance 2")
    chosen = chosen or plan(reps, distance)
    index = reps.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), bits_of(F.col("fp"), bits).alias("value")) for k, (bits, _) in enumerate(chosen)])).alias("p")).select("p.k", "p.value", "fp")
    # a fingerprint probes the values within its partition's threshold
    probe = index
    if any(t for _, t in chosen):
        masks = F.element_at(F.array(*[F.array(*[F.lit(x) for x in flips(bits, t)]) for bits, t in chosen]), F.col("k") + 1)
        probe = index.select("k", "value", "fp", F.explode(masks).alias("x")).select("k", F.col("value").bitwiseXOR(F.col("x")).alias("value"), "fp")
    hot = materialise(index.groupBy("k", "value").agg(F.count("*").alias("c")).where(F.col("c") > bucket).drop("c"), "hot-buckets")
    hot_side = small_side(hot)
    cool = index.join(hot_side, ["k", "value"], "left_anti").select("k", "value", F.col("fp").alias("v"))
    pairs = probe.withColumnRenamed("fp", "u").join(cool, ["k", "value"]).where((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance))
    if any(t for _, t in chosen):  # then a pair may be found from its larger side alone
        pairs = pairs.unionByName(probe.withColumnRenamed("fp", "v").join(cool.withColumnRenamed("v", "u"), ["k", "value"]).where((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance)))
    in_hot = probe.join(hot_side, ["k", "value"], "left_semi").select("fp").distinct()
    one = [x - (1 << 64) if x >> 63 else x for x in [0, *(1 << b for b in range(BITS))]]
    near = in_hot.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(x)) for x in one])).alias("value"))
    shared = near.groupBy("value").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1).select(F.array_min("fps").alias("u"), F.explode("fps").alias("v")).where("u < v")
    return pairs.select("u", "v").unionByName(shared).distinct()


# --- components


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and root, the smallest node reachable, for every node of the edges u < v.

    Large star: every node sends its larger neighbours to its smallest neighbour. Small star: its smaller ones
    and itself. It ends when a round changes nothing: all edges lead to roots.
    """
    edges = materialise(edges, "edges")
    before = None
    for _ in range(most_rounds):
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("u"), "v").distinct()
        # here u < v: the neighbours of v that are smaller, and the smallest of them
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(least, "v")
        small = joined.where("u > m").select(F.col("m").alias("u"), F.col("u").alias("v")).unionByName(least.select(F.col("m").alias("u"), "v")).distinct()
        edges = materialise(small, "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
        before = now
    raise RuntimeError("components did not settle")


def linked_classes(fps: DataFrame, distance: int, bucket: int, *least: Column) -> DataFrame:
    """fp, root and the named aggregates ``least`` of the fingerprints with more than one row or with links; a written table."""
    reps = materialise(fps.groupBy("fp").agg(*least, F.count("*").alias("n")), "representatives")
    found = materialise(components(links(reps, distance=distance, bucket=bucket)), "components")
    linked = reps.join(found, reps["fp"] == found["node"], "left").withColumns({"root": F.coalesce("root", "fp"), "linked": F.col("root").isNotNull()}).drop("node").where("linked OR n > 1")
    return materialise(linked, "linked")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 2, shingle: int = 3, bucket: int = BUCKET) -> DataFrame:
    """id_col, fp and component_id, the smallest id reachable over links."""
    fps = materialise(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    linked = linked_classes(fps, distance, bucket, F.min(id_col).alias("least"))
    roots = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = materialise(linked.join(roots, "root").select(F.col("fp").alias("__fp"), "component_id"), "classes")
    joined = fps.join(small_side(classes), fps["fp"] == classes["__fp"], "left")
    return joined.select(id_col, "fp", F.coalesce("component_id", id_col).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 2, shingle: int = 3, bucket: int = BUCKET) -> DataFrame:
    """One row of ``docs`` of each component: that of the smallest id, null last, then of the smallest text hash; columns as they were.

    Rows are told apart by a number that they are written with, so a row goes or stays whatever others of its id do, and of rows that repeat
    in id and text any one stays.
    """
    row = private(docs, "__row")
    docs = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    text = column(docs, text_col)
    known = docs.select(F.struct(column(docs, id_col).isNull().alias("nameless"), column(docs, id_col).alias("id"), F.xxhash64(text.cast("string")).alias("hash"), docs[row].alias("row")).alias("key"), text.alias("text"))
    fps = materialise(fingerprints(known, "key", "text", shingle), "fingerprints")
    linked = linked_classes(fps, distance, bucket, F.min("key").alias("least"))
    roots = linked.groupBy("root").agg(F.min("least")["row"].alias("first"))
    classes = materialise(linked.select("fp", "root").join(roots, "root").select(F.col("fp").alias("class_fp"), "first"), "classes")
    joined = fps.join(small_side(classes), fps["fp"] == classes["class_fp"]).where(F.col("key.row") != F.col("first"))
    gone = materialise(joined.select(F.col("key.row").alias(row)), "duplicates")
    return docs.join(small_side(gone), docs[row] == gone[row], "left_anti").drop(row)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
