"""Revisions replayed on executors against the loop; components and chains of any length."""

import json
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from serial_fold import fold_revisions, ref_key

from recolith import model
from recolith.operators import links, replay
from recolith.stages import materialise


def cited(source, record="1"):
    return {"source": source, "source_record_id": record, "locator": None, "url": None, "uncited": None, "reason": None}


def random_revisions(draw, n, ids):
    name = lambda: draw.choice([*ids, *ids, "nowhere", "old1", "old2", "old3"])
    out = []
    for i in range(n):
        patch = {}
        kind = draw.choice(["entry"] * 9 + ["relation"])
        roll = draw.random()
        if roll < 0.25:
            patch = {"suppress": True} | ({"review": {"decision": draw.choice(["source_shadow", "alias"]), "canonicalEntryId": name()}} if draw.random() < 0.8 else {})
        else:
            if draw.random() < 0.3:
                patch |= {draw.choice(["kind", "name", "family"]): draw.choice(["k1", "k2", "", 5])}
            if draw.random() < 0.6:
                patch["attributes"] = {draw.choice("abc"): draw.choice([1, "é", [1, {"z": 1, "y": 2}], None]) for _ in range(2)} | ({"revisionReviews": "own"} if draw.random() < 0.1 else {})
            if draw.random() < 0.3:
                patch["citations"] = [cited("p", str(i))]
            if draw.random() < 0.4:
                patch["review"] = {"decision": "preserve_distinct", "relatedEntryIds": [name()]}
            if draw.random() < 0.4 or (kind == "relation" and draw.random() < 0.8):
                patch["relations"] = draw.choice([{"x": [{"kind": "r", "to": name()}, {"kind": "r", "to": name(), "citations": [cited("q")]}, {"to": "?"}], "y": "no list"}, {}, {"z": [{"kind": "s", "to": name()}]}])
        selector = None
        if draw.random() < 0.4:
            selector = {"canonical_id": draw.choice([None, name()]), "previous_ids": draw.choice([None, [], [name()]]), "source_refs": draw.choice([None, [cited("s", draw.choice("123"))]]), "kind": draw.choice([None, None, "board", "k1"]), "name": None}
        out.append({"id": f"r{draw.randint(0, 9)}-{i:04d}", "source": "q", "target_kind": kind, "target_id": name(), "target": selector, "rationale": "why", "evidence": None, "patch": json.dumps(patch)})
    return out


@pytest.mark.parametrize(("seed", "n", "entries"), [(1, 150, 12), (2, 150, 150)])
def test_replay_equals_the_loop(spark, seed, n, entries):
    draw = random.Random(seed)
    ids = [f"e{i}" for i in range(entries)]
    revisions = random_revisions(draw, n, ids)
    aliases = [(str(i), draw.choice(ids), [draw.choice(["old1", "old2", draw.choice(ids)])], [cited("s", draw.choice("123"))]) for i in range(6)] + [("x", "e1", ["old3"], None), ("y", "e2", ["old3"], None)]
    table = spark.createDataFrame([{"id": i, "family": "f", "kind": "board", "name": "N", "attributes": {"a": "0", "z": "1"}, "citations": [cited("g")]} for i in ids], model.ENTRY)
    edges = [{"from_id": draw.choice(ids), "kind": draw.choice("rs"), "to_id": draw.choice(ids), "citations": [cited("g")]} for _ in range(3 * entries)]
    relations = spark.createDataFrame([dict(t) for t in {tuple((k, v) for k, v in e.items() if k != "citations") for e in edges}], "from_id string, kind string, to_id string").withColumn("citations", F.from_json(F.lit(json.dumps([cited("g")])), table.schema["citations"].dataType))
    given = spark.createDataFrame(revisions, model.REVISION)
    known = spark.createDataFrame([{"id": a, "canonical_id": c, "previous_ids": p, "source_refs": s, "kind": None, "name": None, "rationale": None, "evidence": None} for a, c, p, s in aliases], model.ALIAS)
    index = {}
    for _, c, p, s in aliases:
        for key in [("id", x) for x in p] + [("ref", ref_key(x)) for x in s or []]:
            index.setdefault(key, set()).add(c)
    rows = sorted(given.collect(), key=lambda r: r["id"])
    fold = fold_revisions(rows, {i: ("board", "N") for i in ids}, index)
    done = replay.replay(given, table, known)
    assert Counter(map(tuple, done.findings.collect())) == Counter(fold.findings)
    assert {r["id"]: r["replacement"] for r in done.suppressed.collect()} == {i: fold.final_target.get(i) for i in fold.suppressed}
    after, links_ = replay.apply(table, materialise(relations, "r"), done)
    got = {r["id"]: r for r in after.collect()}
    assert set(got) == set(ids) - set(fold.suppressed)
    for i, r in got.items():
        p = fold.patches.get(i, {"attributes": {}})
        assert (r["kind"], r["name"], r["family"]) == (p.get("kind", "board"), p.get("name", "N"), p.get("family", "f"))
        assert r["attributes"] == {"a": "0", "z": "1"} | p["attributes"]
        assert [c["source_record_id"] for c in r["citations"]] == [c["source_record_id"] for c in p.get("citations", [cited("g")])]
    end = lambda a, b: b if b not in fold.suppressed else (fold.final_target.get(b) if fold.final_target.get(b) != a else None)
    want = {(f, k, end(f, t)) for f, k, t in [(r["from_id"], r["kind"], r["to_id"]) for r in relations.collect() if r["from_id"] not in fold.relations] + [(f, k, t) for f, v in fold.relations.items() for k, t, _ in v] if f not in fold.suppressed}
    assert {(r["from_id"], r["kind"], r["to_id"]) for r in links_.collect()} == {w for w in want if w[2] is not None}


def test_order_matters_only_within_a_component(spark):
    """A third of all revisions patch one entry, and none changes kinds or names: no component is read as a stream."""
    table = spark.createDataFrame([{"id": f"e{i}", "family": "f", "kind": "k", "name": "n", "attributes": {}, "citations": []} for i in range(50)], model.ENTRY)
    rows = [{"id": f"{i:06d}", "source": "q", "target_kind": "entry", "target_id": "e0" if i % 3 == 0 else f"e{i % 50}", "target": None, "rationale": "r", "evidence": None, "patch": json.dumps({"attributes": {"n": i}})} for i in range(3000)]
    given = spark.createDataFrame(rows, model.REVISION)
    assert replay.grouped(given, table, None).groupBy("group").count().agg(F.max("count")).first()[0] == 1
    done = replay.replay(given, table)
    got = {r["id"]: r["attributes"]["n"] for r in replay.patches(done.effects, table.schema["citations"].dataType.simpleString()).collect()}
    assert got == {f"e{k}": str(max(i for i in range(3000) if (0 if i % 3 == 0 else i % 50) == k)) for k in range(50) if any((0 if i % 3 == 0 else i % 50) == k for i in range(3000))}
    none = replay.replay(given.limit(0), table)
    assert none.findings.count() == none.suppressed.count() == 0 and replay.apply(table, spark.createDataFrame([], model.RELATION), none)[0].count() == 50


def test_odd_patches(spark):
    table = spark.createDataFrame([{"id": "a", "family": "f", "kind": "k", "name": "n", "attributes": {}, "citations": []}], model.ENTRY)
    row = lambda i, patch: {"id": i, "source": "q", "target_kind": "entry", "target_id": "a", "target": None, "rationale": None, "evidence": None, "patch": patch}
    done = replay.replay(spark.createDataFrame([row("1", None), row("2", "[1]"), row("3", "{"), row("4", '{"relations": 5, "review": "x"}'), row("5", '{"relations": {"a": [1, {"to": "b"}], "b": {"to": "c"}}}')], model.REVISION), table)
    assert sorted((f["code"], f["message"][:1]) for f in done.findings.collect()) == [("compiler.conflict.revision_invalid_state", x) for x in "123"]
    assert [r["n"] for r in done.effects.groupBy("effect").agg(F.count("*").alias("n")).orderBy("effect").collect()] == [3, 2, 1]


def test_components(spark):
    draw = random.Random(3)
    edges = [(f"n{draw.randint(0, 300)}", f"n{draw.randint(0, 300)}") for _ in range(200)] + [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(200)] + [("hub", f"h{i}") for i in range(300)] + [("x", None), ("y", "y")]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            lo, hi = sorted((root(a), root(b)))
            up[hi] = lo
        else:
            root(a or b)
    got = {r["id"]: r["component"] for r in links.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {x: root(x) for x in up}


def test_chains_of_replacements(spark):
    """A chain of 100,000 in ascending order, one against the order, a cycle through ids that are gone, and dead ends."""
    n = 100_000
    chain = spark.range(n).select(F.format_string("c%06d", "id").alias("id"), F.format_string("c%06d", F.col("id") + 1).alias("to"), F.col("id").alias("at"))
    rest = [(f"d{i}", f"d{i + 1}", 100 - i) for i in range(50)] + [("x", "y", 1), ("y", "x", 2), ("z", None, 3), ("w", "z", 1), ("v", "z", 4)]
    found = {r["id"]: r["end"] for r in links.ends(chain.unionByName(spark.createDataFrame(rest, "id string, to string, at long"))).collect()}
    assert all(found[f"c{i:06d}"] == f"c{n:06d}" for i in range(0, n, 997))
    assert all(found[f"d{i}"] == f"d{i + 1}" for i in range(50))
    # each step holds for what stood when it was taken: x led to y before y went, y to x after x was gone
    assert (found["x"], found["y"], found["z"], found["w"], found["v"]) == ("x", "x", None, None, "z")


def test_rows_of_a_batch_by_columns():
    pairs = pa.list_(pa.struct([("key", pa.string()), ("ids", pa.list_(pa.string()))]))
    b = pa.RecordBatch.from_pydict({"id": pa.array(["a", None, "c", "d"]), "none": pa.nulls(4, pairs), "known": pa.array([[{"key": "x", "ids": ["1", "2"]}, {"key": None, "ids": None}], None, [], [{"key": "y", "ids": []}]], pairs)})
    assert list(replay._rows(b)) == b.to_pylist() and list(replay._rows(b.slice(2, 2))) == b.slice(2, 2).to_pylist() and list(replay._rows(b.slice(0, 0))) == []
