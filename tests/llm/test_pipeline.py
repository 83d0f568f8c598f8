"""The corpus pipeline's stages one after the other against brute force, on odd rows and on the smallest tables."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from test_text_operators import components_of, words

import corpus_pipeline
from recolith.llm import quality, simhash, tokencounts
from recolith.llm.common import materialise, private, shared_dir

COLUMNS = "doc_id long, text string, lang string, source string, n_chars int"
CLASHES = ", label int, __id int, __row long, __bad string, `a.b` string, doc_ID_ string"


def prose(draw, n):
    return " ".join("".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 7))) for _ in range(n))


def tables(spark, folder, docs, labels, bench, schema):
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def stages(spark, folder):
    """The input, what each stage but the last makes of it, and the last one's rows."""
    out = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], str(folder)), name))
    return out


def bag(df):
    return Counter(tuple(str(v) for v in r) for r in df.collect())


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "benchmark_decontamination", "mixing_sources", "token_ids"]


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Null, empty, very long, repeated and tied rows, rows that share an id or have none, and columns of any name."""
    draw = random.Random(31)
    bench = [(i, prose(draw, 30)) for i in range(3)] + [(None, prose(draw, 15)), (7, None), (8, "")]
    texts = [prose(draw, draw.randint(10, 120)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100 + i, texts[i]) for i in range(10)] + [(i, texts[20 + i]) for i in range(5)]  # copies, and ids that stand for two texts
    rows += [(None, prose(draw, 40)), (None, prose(draw, 50)), (None, texts[0]), (None, None), (None, ""), (200, None), (201, ""), (202, "  \n")]
    rows += [(300 + i, bench[i][1] + " " + prose(draw, 20)) for i in range(3)] + [(None, bench[0][1]), (400, bench[1][1] + " " + prose(draw, 3000))]
    rows += [(500, prose(draw, 60_000)), (501, "same " * 5000), (7, texts[7]), (7, texts[7])]
    extra = (1, 2, 3, "b", "dotted", "x")
    docs = [(d, t, "en", draw.choice(["a", "b", None]), len(t or ""), *extra) for d, t in rows]
    labels = [(i, int(i % 4 > 0), i % 2) for i in range(0, 60, 2)] + [(1, None, None), (None, 1, 0)]
    tables(spark, tmp_path, docs, labels, bench, COLUMNS + CLASHES)
    given, good, one, clean, mixed, files = stages(spark, tmp_path)
    for df in (good, one, clean, mixed):
        assert df.columns == given.columns

    # quality: rows that fail a base rule go, others by the model's verdict, each row on its own
    verdict = quality.scorer(quality.train(given, spark.read.parquet(f"{tmp_path}/labels.parquet")))
    keep = given.withColumn("verdict", verdict(given["text"])).where("verdict.kept").drop("verdict")
    assert bag(good) == bag(keep) and good.count() > 20
    assert all(len((r["text"] or "").split()) >= 10 for r in good.collect())

    # near-duplicates: one row of each component
    def slow(text):
        w = (text or "").lower().encode().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))

    before = [(r["doc_id"], r["text"]) for r in good.collect()]
    fps = {t: slow(t) for _, t in before}
    roots = components_of(fps.values())
    groups = {}
    for d, t in before:
        groups.setdefault(roots[fps[t]], []).append((d is None, d, t))
    after = [(r["doc_id"], r["text"]) for r in one.collect()]
    assert Counter(roots[fps[t]] for _, t in after) == Counter({k: 1 for k in groups})
    for d, t in after:
        members = groups[roots[fps[t]]]
        assert d == min(members, key=lambda m: (m[0], m[1] or 0))[1] and any(m[1:] == (d, t) for m in members)

    # decontamination: each row on its own words
    windows = {tuple(w[s : s + min(13, len(w))]) for i, b in bench if i is not None for w in [words(b)] for s in range(max(1, len(w) - 12)) if w}

    def contaminated(text):
        w = words(text)
        hit = {p for k in {len(x) for x in windows} for s in range(len(w) - k + 1) if tuple(w[s : s + k]) in windows for p in range(s, s + k)}
        return bool(hit) and 20 * len(hit) >= len(w)

    assert Counter(r["text"] for r in clean.collect()) == Counter(t for _, t in after if not contaminated(t))
    assert any(contaminated(t) for _, t in after)

    # mixing: whole rows, none more than twice, each source near its target
    kept = bag(clean)
    taken = bag(mixed)
    assert set(taken) <= set(kept) and all(n <= 2 * kept[k] for k, n in taken.items())

    # token files: every row's ids, in order
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokencounts.vocabulary())
    expected = Counter()
    for r in mixed.collect():
        ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        expected[(r["doc_id"], len(ids), zlib.crc32(ids.tobytes()))] += 1
    got = files.orderBy("start").collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == expected
    assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:i]) for i in range(len(got))]
    ids = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
    assert ids == sorted(ids)
    assert Counter(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == Counter(map(tuple, got))


def test_pipeline_loses_no_unique_text(spark, tmp_path):
    """Clean documents of unlike texts all reach the mix, whatever their ids."""
    draw = random.Random(32)
    rows = [(draw.choice([None, 1, 2, i]), prose(draw, 80), "en", "a", 1) for i in range(50)]
    tables(spark, tmp_path, rows, [], [(1, prose(draw, 20))], COLUMNS)
    given, good, one, clean, *_ = stages(spark, tmp_path)
    assert bag(given) == bag(good) == bag(one) == bag(clean)


@pytest.mark.parametrize("empty", ["documents", "labels", "benchmark", "all"])
def test_pipeline_on_empty_tables(spark, tmp_path, empty):
    draw = random.Random(33)
    pick = lambda name, rows: [] if empty in (name, "all") else rows
    rows = pick("documents", [(i, prose(draw, 30), "en", "a", 1) for i in range(8)])
    tables(spark, tmp_path, rows, pick("labels", [(1, 1, 0), (2, 0, 1)]), pick("benchmark", [(1, prose(draw, 20))]), COLUMNS)
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and (got.count() > 0) == bool(rows) or empty == "labels"


def test_shared_folder_on_a_cluster_must_be_named():
    class Conf:
        def get(self, *_):
            return None

    class Spark:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError):
        shared_dir(Spark())


def test_private_names(spark):
    assert private(spark.createDataFrame([(1, 2)], "__ROW int, __row_ int"), "__row") == "__row__"
    assert simhash.keep_one(spark.createDataFrame([(1, "a", 5), (2, "a", 6)], "doc_id long, text string, __row int")).collect()[0]["__row"] == 5


def test_workers_keep_few_pre_tokens_and_write_the_same_ids(spark):
    from recolith.llm import tokenfiles
    from recolith.llm.tokencounts import Pieces, vocabulary

    assert corpus_pipeline.TOKEN_CACHE <= 100_000
    small, large = (Pieces.of_worker(vocabulary(), "test", len, most) for most in (3, 1000))
    texts = ["a b c d e f", "d e f g, a", "zebras a b"]
    assert small is not large and list(map(sum, small.of_texts(texts))) == list(map(sum, large.of_texts(texts)))
    assert len(small.known) <= 3 < len(large.known)
    docs = spark.createDataFrame([(i, f"word{i} and {'again ' * i}") for i in range(40)], "doc_id long, text string")
    assert sorted(tokenfiles.digest(docs, 3).collect()) == sorted(tokenfiles.digest(docs).collect())
