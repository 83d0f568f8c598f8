"""Decontamination, line dedup, mixing and near-duplicates against brute force, with nulls, ties, repeats, empty tables and clashing columns."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recolith.llm import decontaminate, linededup, mixing, simhash
from recolith.llm.common import in_order, materialise

DOCS = "doc_id long, text string, lang string, source string, n_words string"
VOCAB = [f"w{i}" for i in range(40)] + ["é", "Ünï", "the", "The"]


def prose(draw, n):
    return "".join(draw.choice(VOCAB) + draw.choice([" ", " ", "\n", ", ", "  "]) for _ in range(n))


@pytest.fixture(scope="module")
def documents(spark):
    draw = random.Random(3)
    bench = [(i, prose(draw, n)) for i, n in enumerate([30, 5, 13, 1, 14, 30])] + [(6, None), (7, ""), (None, "w1 w2 w3"), (5, "..."), (8, "The The The The The The The The The The The The The The")]
    rows = []
    for i in range(60):
        text = prose(draw, draw.randint(0, 60))
        if i % 3 == 0:
            text += " " + draw.choice(bench[:6])[1].upper() + " " + prose(draw, draw.randint(0, 400 if i % 2 else 10))
        rows.append((i, text, "en", draw.choice(["a", "b", "é", None]), "x"))
    rows += [(60, None, None, None, None), (61, "", "en", "a", "x"), (62, "...", "en", "a", "x"), (63, "the " * 3000, "en", "b", "x"), (64, rows[0][1], "en", "a", "x"), (65, rows[0][1], "en", "a", "x")]
    docs = spark.createDataFrame(rows, DOCS)
    return docs, rows, spark.createDataFrame(bench, "item_id long, text string"), bench


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def test_decontamination(spark, documents):
    docs, rows, bench_df, bench = documents
    windows = {}
    for item, text in bench:
        w = words(text)
        k = min(13, len(w))
        if k and item is not None:
            for s in range(len(w) - k + 1):
                windows.setdefault(tuple(w[s : s + k]), set()).add(str(item))
    expected = {}
    for doc_id, text, *_ in rows:
        w, hit, items = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for s in range(len(w) - k + 1):
                if found := windows.get(tuple(w[s : s + k])):
                    hit |= set(range(s, s + k))
                    items |= found
        expected[doc_id] = (len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    got = {r[0]: tuple(r[1:]) for r in decontaminate.digest(docs, bench_df).collect()}
    assert got == expected and any(v[4] for v in got.values()) and any(v[1] and not v[4] for v in got.values())

    # without broadcasts, the same: every window against the filter, or those at longest words
    for bounds in ({"broadcast_rows": 0}, {"broadcast_bytes": 0}):
        by_join = decontaminate.hits(docs, decontaminate.benchmark_windows(bench_df), **bounds)
        assert {r["doc_id"]: (r["n_words"], len(r["items"])) for r in by_join.collect()} == {k: (v[0], v[2]) for k, v in expected.items()}

    kept = decontaminate.drop_documents(docs, bench_df)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, v in expected.items() if not v[4])

    cut = {r["doc_id"]: r["text"] for r in decontaminate.drop_spans(docs, bench_df).collect()}
    assert all(len(words(cut[k])) == v[0] - v[1] for k, v in expected.items())
    assert all(cut[k] == t for k, t, *_ in rows if not expected[k][1])


def test_decontamination_of_empty_tables(spark, documents):
    docs, rows, bench, _ = documents
    assert decontaminate.digest(docs.limit(0), bench).count() == 0
    none = decontaminate.digest(docs, bench.limit(0))
    assert none.count() == len(rows) and none.where("n_hit > 0 OR contaminated OR n_items > 0").count() == 0


def test_rows_that_share_an_id_stay_apart(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "x y z q"), (1, "x y z q"), (None, "a b c"), (None, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, "a b c")], "item_id long, text string")
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"]) for r in decontaminate.digest(docs, bench).collect())
    assert got == Counter({(1, 3, 3): 1, (1, 4, 0): 2, (None, 3, 3): 2})


def test_rows_are_judged_on_their_own_words(spark):
    copy, clean, near = "a b c", "x " * 100, "y a b c"
    rows = [(None, copy), (None, clean), (None, clean), (None, None), (1, copy), (1, clean), (2, near)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(9, "a b c")], "item_id long, text string")
    got = Counter((r["n_words"], r["n_hit"], r["contaminated"]) for r in decontaminate.digest(docs, bench).where("doc_id IS NULL").collect())
    assert got == Counter([(3, 3, True), (100, 0, False), (100, 0, False), (0, 0, False)])
    kept = Counter(map(tuple, decontaminate.drop_documents(docs, bench).collect()))
    assert kept == Counter([(None, clean), (None, clean), (None, None), (1, clean)])
    cut = Counter(map(tuple, decontaminate.drop_spans(docs, bench).collect()))
    assert cut == Counter([(None, ""), (None, clean), (None, clean), (None, None), (1, ""), (1, clean), (2, "y")])


def test_line_dedup(spark):
    page = lambda body: f"<html><script>x</script><!-- <p>no</p> --><nav><a href='/'>Home</a></nav><p>{body}</p><P class=x>end <b>of</b>  page</P>"
    rows = [(i, "https://u@Host.example:80/a", page(f"text {i}")) for i in range(6)] + [(10 + i, "http://small.example", page("same")) for i in range(4)]
    rows += [(20, None, "<p>x"), (21, "", None), (22, "http://host.example/b", ""), (None, "http://host.example/c", "plain\nHome\nHome"), (0, "https://host.example", page("text 0"))]
    rows += [(30, "http://two.example/", "<p>menu<p>one"), (31, "http://two.example/", "<p>menu<p>two"), (32, "http://single.example", "<p>menu<p>one"), (33, "http://long.example", "<p>line" * 100_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    got = sorted((r["page_id"] if r["page_id"] is not None else -1, r["host"], r["n_lines"], r["n_dropped"], r["text"]) for r in linededup.dedup(pages, ratio=0.5).collect())
    assert (0, "host.example", 3, 2, "text 0") in got and got.count((0, "host.example", 3, 2, "text 0")) == 2
    assert (-1, "host.example", 3, 2, "plain") in got
    assert (10, "small.example", 3, 3, "") in got and (30, "two.example", 2, 1, "one") in got and (32, "single.example", 2, 0, "menu\none") in got
    assert (20, "", 1, 0, "x") in got and (21, "", 0, 0, "") in got and (22, "host.example", 0, 0, "") in got
    assert len(got) == len(rows)
    assert linededup.dedup(pages.limit(0)).count() == 0


def test_pages_of_many_distinct_lines(spark):
    """Two equal pages of 100,000 lines, and one of which half are its own; some seconds, not minutes."""
    lines = [f"line {i} of a page" for i in range(100_000)]
    rows = [(1, "http://h.example/", "\n".join(lines)), (2, "http://h.example/", "\n".join(lines)), (3, "http://h.example/", "\n".join(x if i % 2 else x + " own" for i, x in enumerate(lines)))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    began = time.time()
    got = {r["page_id"]: r for r in linededup.dedup(pages).collect()}
    assert time.time() - began < 60
    assert [(got[i]["n_lines"], got[i]["n_dropped"], got[i]["text"]) for i in (1, 2)] == [(100_000, 100_000, "")] * 2
    assert got[3]["n_dropped"] == 50_000 and got[3]["text"] == "\n".join(x + " own" for x in lines[::2])


def test_values_in_order(spark):
    draw = random.Random(6)
    rows = [(sorted(draw.choices(range(50), k=draw.randint(0, 40))), v) for _ in range(40) for v in (-1, 0, 25, 49, 60)] + [([], None), ([1], None)]
    got = spark.createDataFrame(rows, "a array<long>, v long").select("a", "v", in_order(F.col("a"), F.col("v")).alias("found")).collect()
    assert all(r["found"] == (r["v"] in r["a"]) for r in got)


def test_spans_of_a_long_document(spark):
    text = " ".join(f"w{i}" for i in range(20_000))
    docs, bench = spark.createDataFrame([(1, text + " the rest")], "doc_id long, text string"), spark.createDataFrame([(1, text)], "item_id long, text string")
    began = time.time()
    assert decontaminate.drop_spans(docs, bench).first()["text"] == " the rest"
    assert time.time() - began < 60


def filled(sizes, weights, share, most):
    """Targets by resharing in rounds."""
    left, target, open_ = share * sum(sizes), [0.0] * len(sizes), list(range(len(sizes)))
    while open_ and left > 1e-9:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if target[i] + left * weights[i] / total >= most * sizes[i]]
        if not full:
            for i in open_:
                target[i] += left * weights[i] / total
            break
        for i in full:
            left -= most * sizes[i] - target[i]
            target[i] = most * sizes[i]
        open_ = [i for i in open_ if i not in full]
    return target


def test_mixing(spark):
    draw = random.Random(5)
    rows = [(i, "w " * draw.choice([0, 1, 5, 5, 5, 40, 300]), "en", draw.choice(["a"] * 12 + ["b", "é", "z", None]), "x") for i in range(1500)] + [(1, "a b", "en", "b", "x"), (None, None, "en", None, "x"), (5000, "a  b\tc\x0b\nd", "en", "q", "x"), (5001, "", "en", "empty", "x")]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.digest(docs).collect()
    assert len(got) == len(rows)
    names = sorted({r[3] for r in rows if r[3]}) + [None]
    sizes = [sum(len((t or "").split()) for _, t, _, s, _ in rows if s == name) for name in names]
    weights = [[3, 1, 2][i % 3] for i in range(len(names))]
    target = filled(sizes, weights, 1.5, 2.0)
    taken = mixing.copies(docs).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("n"), F.first("target").alias("t"), F.max("copies").alias("most")).collect()
    for r in taken:
        i = names.index(r["source"])
        assert r["t"] == pytest.approx(target[i]) and abs(r["n"] - target[i]) <= max(0.02 * target[i], 300) and r["most"] <= 2
    assert sum(target) == pytest.approx(1.5 * sum(sizes))
    assert sorted(map(str, got)) == sorted(map(str, mixing.digest(docs.repartition(7)).collect()))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    copies = {(r["doc_id"], r["size"]): r["copies"] for r in mixing.copies(docs).collect() if r["doc_id"] not in (1, None)}
    seen = Counter(r["doc_id"] for r in mixed.collect())
    assert all(seen[d] == n for (d, _), n in copies.items())
    assert mixing.digest(docs.limit(0)).count() == 0


def test_mixing_of_rows_that_share_an_id(spark):
    """Repeated and missing ids, a very long text, and columns of any name; no document is taken more than twice."""
    draw = random.Random(8)
    rows = [(draw.choice([None, 7, 7, i]), "w " * draw.choice([1, 9, 80]) + str(i % 200), draw.choice(["a", "b"]), str(i), {"k": i}) for i in range(600)] + [(1, "long " * 200_000, "b", "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, `a.b` string, __keep map<string,int>")
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    seen = Counter((r["doc_id"], r["text"], r["source"], r["a.b"]) for r in mixed.collect())
    assert set(seen) <= {r[:4] for r in rows} and max(seen.values()) <= 2
    assert seen == Counter((r["doc_id"], r["text"], r["source"], r["a.b"]) for r in mixing.mix(docs.repartition(9)).collect())


def test_copies_of_a_running_sum(spark):
    """Against whole numbers of any size."""
    draw = random.Random(9)
    one = 1 << mixing.UNIT_BITS
    rows = [(draw.randrange(one), draw.choice([draw.randrange(2 * one), 2 * one, one, 0]), draw.choice([draw.randrange(10), draw.randrange(1 << 45)])) for _ in range(500)]
    rows += [(one - 1, 2 * one, 1 << 20), (0, 2 * one - 1, 1 << 40)]
    got = spark.createDataFrame(rows, "u long, r long, k long").select("u", "r", "k", mixing.crossed(F.col("u"), F.col("r"), F.col("k")).alias("n")).collect()
    assert all(x["n"] == (x["u"] + x["r"] * (x["k"] + 1)) // one - (x["u"] + x["r"] * x["k"]) // one <= 2 for x in got)


@pytest.mark.parametrize("name", ["op1_decontaminate", "op2_line_dedup", "op4_mix_sources", "op9_warc"])
def test_sql_on_repeated_and_missing_ids(spark, tmp_path, name):
    """The queries' own SQL, on rows that share ids or have none, nulls and odd texts."""
    import duckdb

    from recolith.llm import queries

    draw = random.Random(12)
    bench = [(i, prose(draw, 20)) for i in range(4)] + [(None, "w1 w2"), (9, "w3 w4 w5")]
    texts = [prose(draw, draw.randint(0, 50)) + draw.choice(["", " ", *(b[1] for b in bench)]) for _ in range(40)] + [None, "", "x " * 30_000]
    docs = [(draw.choice([None, 5, 6, i]), t, draw.choice(["a", "b", None])) for i, t in enumerate(texts)]
    docs += [d for d in docs[:20] if d[0] is not None]
    html = lambda t: None if t is None else f"<p>head<p>{t}<p>foot"
    pages = [(i, draw.choice(["http://a.x/", "http://b.x/1", None, "http://c.x"]), html(t)) for i, (_, t, _) in enumerate(docs)] + [(3, "http://d.x", "<p>other " + "y" * 1000), (90, None, "<p>other " + "y" * 1000), (90, None, "<p>other " + "y" * 1000)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.QUERIES[name](spark, str(tmp_path))
    columns = sorted(got.columns)
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    expected = con.sql(queries.ORACLE_SQL[name]).project(", ".join(columns)).fetchall()
    assert Counter(map(str, expected)) == Counter(str(tuple(r[c] for c in columns)) for r in got.collect())


def components_of(fps, distance=2):
    u = sorted(set(fps))
    parent = {x: x for x in u}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(u):
        for b in u[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in u}


@pytest.mark.parametrize("bucket", [64, 2])
@pytest.mark.parametrize("chosen", [None, [([*range(32)], 0), ([*range(32, 64)], 1)], [([*range(16)], 0), ([*range(16, 32)], 0), ([*range(32, 48)], 0)], [([*range(64)], 2)]])
def test_links_and_components(spark, bucket, chosen):
    """Partitions of any thresholds, with and without hot buckets, link what brute force links."""
    draw = random.Random(11)
    fps = {0}
    for _ in range(15):
        x = draw.getrandbits(64)
        for _ in range(12):  # chains of near values
            fps.add(x)
            for _ in range(draw.randint(1, 3)):
                x ^= 1 << draw.randrange(64)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    reps = materialise(spark.createDataFrame([(x,) for x in signed], "fp long"), "reps")
    edges = simhash.links(reps, chosen, bucket=bucket)
    assert all((a ^ b).bit_count() <= 2 for a, b in ((r["u"] % (1 << 64), r["v"] % (1 << 64)) for r in edges.collect()))
    got = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in simhash.components(edges).collect()}
    expected = components_of(fps)
    groups = lambda m: {frozenset(k for k in fps if m.get(k, k) == root) for root in {m.get(k, k) for k in fps}}
    assert groups(got) == groups(expected)


def test_near_duplicates(spark):
    import xxhash

    draw = random.Random(2)
    base = prose(draw, 400)
    texts = [base, base + " more", base.upper(), "a b", "A  b", None, "", " \n", "x", "w " * 20000, prose(draw, 100)]
    docs = spark.createDataFrame([(10 + i, t, "en", "a", "x") for i, t in enumerate(texts)] + [(None, base, "en", "a", "x"), (10, base, "en", "a", "x")], DOCS)

    def slow(text):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        if not w:
            return 0
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    got = simhash.digest(docs).collect()
    rows = {(r["doc_id"]): r for r in got}
    expected = [slow(t) for t in texts]
    assert [int(rows[10 + i]["fingerprint"], 16) for i in range(len(texts))] == expected
    roots = components_of(expected)
    for i, x in enumerate(expected):
        assert rows[10 + i]["component_id"] == min(10 + j for j, y in enumerate(expected) if roots[y] == roots[x])
    assert rows[None]["component_id"] == 10 and len(got) == len(texts) + 2
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted({r["component_id"] for r in got})
    assert simhash.digest(docs.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark):
    draw = random.Random(4)
    a, b, c, d = (prose(draw, 80) for _ in range(4))
    rows = [(5, a), (5, b), (3, a), (3, a), (7, c), (7, c), (None, c), (None, c), (None, d), (None, d), (9, "x y"), (8, "X  y")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert Counter(map(tuple, kept.collect())) == Counter([(5, b), (3, a), (7, c), (None, d), (8, "X  y")])
    # components go as a whole to one row, and rows of other components stay whatever their ids
    rows = [(1, a), (2, a), (2, b), (3, b), (None, a)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert Counter(map(tuple, kept.collect())) == Counter([(1, a), (2, b)])


def test_thresholds_are_the_cheapest():
    draw = np.random.default_rng(1)
    for m in (2, 3, 4):
        costs = [{t: float(draw.random()) for t in (-1, 0, 1, 2)} for _ in range(m)]
        best, ts = simhash.thresholds(costs, 3 - m)
        import itertools

        every = [(sum(c[t] for c, t in zip(costs, pick, strict=True)), list(pick)) for pick in itertools.product((-1, 0, 1, 2), repeat=m) if sum(pick) == 3 - m]
        assert best == pytest.approx(min(every)[0]) and sum(ts) == 3 - m


def test_clean_up(spark, tmp_path):
    from recolith.llm.common import clean_up, fresh_path

    made = materialise(spark.range(3).toDF("x"), "t")
    assert made.count() == 3
    folder = fresh_path(spark, "t").rsplit("/", 1)[0]
    assert spark.read.option("recursiveFileLookup", True).parquet(folder + "/t-*").count() == 3
    clean_up(spark)
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(folder).count()
