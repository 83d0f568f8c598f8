"""Importance resampling, Merkle manifests and fingerprints against brute force, with nulls, ties, repeats, long texts, empty tables and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recolith.llm import fingerprints, importance, merkle
from recolith.llm.common import materialise

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, `group` int, key int, node string, __at long, rank string, `a.b` int, score string"
REST = ("x", 1, 2, "y", 3, "z", 4, "w")


def prose(draw, n):
    return "".join(draw.choice(["one", "Two", "three", "vier", "Fünf", "6", "seven"]) + draw.choice([" ", ", ", "\n", "-"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    out = [(i, prose(draw, draw.randint(0, 60)), draw.choice(["en", "en", "en", "de", None, "é"]), draw.choice(["a", None]), draw.choice([None, 5, 12])) for i in range(120)]
    out += [(None, None, None, None, None), (None, "null id " * 12, "en", "a", 3), (7, out[7][1], out[7][2], out[7][3], out[7][4]), (7, "other text of an id", "en", "b", 1)]
    out += [(500, "", "zz", "", 0), (501, prose(draw, 5000), "en", "a", 1), (501, prose(draw, 5000), "en", "a", 1), (502, "x" * 40_000, "en", "a", 1), (503, " " * 30_000 + "end", "de", "a", 2)]
    return out + [out[-4], out[-4], (-3, "negative, of two words", "en", "q", 9)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return materialise(spark.createDataFrame([(*r, *REST) for r in rows], SCHEMA).repartition(5), "test-docs")


def features(text, n):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return w, [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def resampled(rows, bench, n=2, buckets=10_000, percent=25, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(bucket(f) for r in rows for f in features(r[1], n)[1]), Counter(bucket(f) for x in bench for f in features(x, n)[1])
    S, T = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for r in rows:
        w, fs = features(r[1], n)
        gain = sum(math.floor(1000 * math.log((t[bucket(f)] + 1) * S / ((s[bucket(f)] + 1) * T))) for f in fs)
        weight = gain // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append([r[0], len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    fit = sorted((o for o in out if o[5] >= least), key=lambda o: (-o[3], o[0] is None, o[0] or 0, o[1]))
    for i, o in enumerate(fit[: len(fit) * percent // 100]):
        o[4] = i + 1
    return Counter(map(str, (o[:5] for o in out)))


def test_resampling(spark, docs, rows):
    bench = [prose(random.Random(9), 40), None, "", "unheard words"]
    target = spark.createDataFrame([(i, x) for i, x in enumerate(bench)], "item_id int, text string")
    assert Counter(str(list(r)) for r in importance.digest(docs, target).collect()) == resampled(rows, bench)
    # other runs and numbers of buckets, chunks of a few bytes, and every row drawn
    for n, buckets, size, percent in ((1, 50, 64, 100), (3, 1000, 100, 50), (4, 7, 16, 10)):
        found = importance.resample(docs, target, percent=percent, n=n, buckets=buckets, size=size).select("doc_id", "n_features", "weight", "score", "rank")
        assert Counter(str(list(r)) for r in found.collect()) == resampled(rows, bench, n, buckets, percent)
    drawn = importance.drawn(docs.where("doc_id >= 10 AND doc_id < 400"), target)
    ranked = importance.resample(docs.where("doc_id >= 10 AND doc_id < 400"), target).where("rank IS NOT NULL")
    assert drawn.columns == docs.columns and {r["doc_id"] for r in drawn.collect()} == {r["doc_id"] for r in ranked.collect()}


def test_chunks_own_each_feature_once():
    draw = random.Random(2)
    for text in [prose(draw, 300), "", " ", "a", "x" * 500, " " * 500, "a " * 200, "é" * 100 + " b"]:
        for n in (1, 2, 3, 5):
            whole = Counter(zlib.crc32(f.encode()) % 999 for f in features(text, n)[1])
            for size in (1, 7, 64, 10_000):
                parts = [importance.buckets_of(c, own, n, 999) for c, own in importance.chunks(text, n, size)]
                assert sum((Counter(b.tolist()) for _, b in parts), Counter()) == whole and sum(m for m, _ in parts) == len(features(text, 1)[0])


def test_resampling_of_empty_tables(spark, docs):
    target = spark.createDataFrame([], "text string")
    assert importance.digest(docs.limit(0), target).count() == 0
    assert importance.digest(docs, target).count() == docs.count()


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, more=0):
    written = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(*map(written, (r[0], r[3], r[2], None if r[4] is None else r[4] + more, r[1])))


def tree_of(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def siblings(levels, at, fanout):
    for level in levels[:-1]:
        run = at - at % fanout
        yield level[run:at], level[at + 1 : run + fanout]
        at //= fanout


def manifest(rows, fanout=2):
    groups = {}
    for r in rows:
        groups.setdefault((r[2] is not None, (r[2] or "").encode()), []).append(r)
    ordered = sorted(groups)
    trees = {g: tree_of([leaf_of(r) for r in sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))], fanout) for g in ordered}
    top = tree_of([trees[g][-1][0] for g in ordered], fanout)
    out = Counter()
    for i, g in enumerate(ordered):
        for at, r in enumerate(sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))):
            way = [*siblings(trees[g], at, fanout), *siblings(top, i, fanout)]
            node = leaf_of(r, int(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0))
            for before, after in way:
                node = sha(*before, node, *after)
            out[(r[0], leaf_of(r), trees[g][-1][0], top[-1][0], sha(*[x for b, a in way for x in b + a]), node, node == top[-1][0])] += 1
    return out


def test_manifest(docs, rows):
    found = merkle.digest(docs).collect()
    assert Counter(map(tuple, found)) == manifest(rows)
    assert {r["verified"] for r in found} == {True, False}


@pytest.mark.parametrize(("fanout", "block", "n"), [(2, 4, 17), (3, 9, 82), (4, 4, 1)])
def test_manifest_of_small_blocks(spark, docs, rows, fanout, block, n):
    """Trees of several tables of blocks, of full and broken ones, and of many groups."""
    some = [(i, f"t{i}", f"g{i % 5}" if n > 50 else "g", "s", i) for i in range(n)]
    table = spark.createDataFrame([(*r, *REST) for r in some], SCHEMA)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tree = merkle.build(merkle.leaves(table, changed={"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}), fanout, block)
    got = {r["id"]: r for r in merkle.proofs(tree).withColumn("folded", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))).collect()}
    want = {k[0]: k for k in manifest(some, fanout)}
    assert len(got) == n
    for i, r in got.items():
        seen = sha(*[s["before"] + s["after"] for s in r["path"]])
        assert (r["leaf"], r["subroot"], r["root"], seen, r["folded"]) == want[i][1:6]


def test_manifest_of_an_empty_table(docs):
    assert merkle.digest(docs.limit(0)).count() == 0


def shingles(text, q=8):
    return {text[i : i + q] for i in range(max(len(text) - q + 1, min(len(text), 1)))}


def test_sketches_estimate_sets():
    draw = random.Random(4)
    letters = lambda n: "".join(draw.choices("abcdefg ", k=n))
    common = letters(3000)
    a, b = common + letters(1000), letters(2000) + common
    x, y = fingerprints.sketch(a), fingerprints.sketch(b)
    A, B = shingles(a), shingles(b)
    assert abs(fingerprints.resemblance(x, y) - len(A & B) / len(A | B)) < 0.12
    assert abs(fingerprints.containment(x, y) - len(A & B) / len(A)) < 0.15
    assert abs(fingerprints.distinct(x) / len(A) - 1) < 0.25
    # exact where both are whole
    for s, t in [("short text", "short test"), ("", ""), ("", "a"), ("a", "a"), ("abc", "abcd"), ("aaaaaaaaaaaaaaaa", "aaaaaaaa"), ("é" * 9, "e" * 9)]:
        S, T = shingles(s), shingles(t)
        p, q = fingerprints.sketch(s), fingerprints.sketch(t)
        assert fingerprints.resemblance(p, q) == (len(S & T) / len(S | T) if S | T else 1.0) and fingerprints.distinct(p) == len(S)
        assert fingerprints.containment(p, q) == (len(S & T) / len(S) if S else 1.0)
    # parts of a long text, and the k smallest of very many
    assert (fingerprints.sketch(a, part=100) == x).all() and (fingerprints.merged([fingerprints.sketch(a[:1500]), fingerprints.sketch(a[1493:])]) == x).all()
    h = np.random.default_rng(0).integers(0, 2**63, 100_000, dtype=np.uint64)
    assert (fingerprints.smallest(np.concatenate([h, h])) == np.unique(h)[:128]).all() and len(fingerprints.smallest(np.ones(10_000, dtype=np.uint64))) == 1


@pytest.mark.parametrize("range_bytes", [16 << 20, 2000, 1])
def test_against_next(docs, rows, range_bytes):
    h = {r[1] or "": r["h"] for r in docs.select(F.coalesce("text", F.lit("")).alias("t"), F.coalesce("text", F.lit("")).alias("u"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    ordered = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0), h[r[1]]))
    want = Counter()
    for i, (id_, text) in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        p, q, e = (fingerprints.sketch(t) for t in (text, after, edited))
        want[(id_, len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.packed(p), fingerprints.packed(e), fingerprints.resemblance(p, e), fingerprints.resemblance(p, q))] += 1
    assert Counter(map(tuple, fingerprints.against_next(docs, range_bytes=range_bytes).collect())) == want


def test_against_next_of_one_row_and_none(docs):
    assert fingerprints.digest(docs.limit(0)).count() == 0
    one = fingerprints.digest(docs.where("doc_id = 501").limit(1)).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0 and 0.4 < one[0]["near_edited"] <= 1


def test_columns_of_fingerprints(spark, docs):
    both = docs.where("doc_id < 20").select("doc_id", "text", fingerprints.fingerprint(F.col("text")).alias("p"))
    r = both.select(fingerprints.likeness(F.col("p"), F.col("p")).alias("l"), fingerprints.contained(F.col("p"), F.col("p")).alias("c"), fingerprints.distinct_shingles(F.col("p")).alias("d"), "text").collect()
    assert all(x["l"] == x["c"] == 1.0 and (x["d"] == len(shingles(x["text"])) or x["d"] > 100) for x in r)
    text = prose(random.Random(1), 400)
    parts = spark.createDataFrame([("a", text[:900]), ("a", text[893:1500]), ("a", text[1493:]), (None, text[:50]), (None, text[43:]), ("b", None)], "name string, text string").repartition(3)
    got = dict(tuple(r) for r in fingerprints.merge(parts.select("name", fingerprints.fingerprint(F.col("text")).alias("fingerprint")), "name").collect())
    assert got == {"a": fingerprints.packed(fingerprints.sketch(text)), None: fingerprints.packed(fingerprints.sketch(text)), "b": ""}
