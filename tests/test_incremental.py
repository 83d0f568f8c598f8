"""Updates of a ledger against a full compile, after random edits, losses and deletions."""

import random

import pytest
from pyspark.sql import functions as F

from recolith import buckets, model
from recolith.operators import candidates as ca
from recolith.operators import fragments as fr
from recolith.plans import incremental as inc
from recolith.plans.compile import baseline

POLICY = [(s, k, a) for s in "ab" for k, a in (("board", "promote"), ("agency", "promote_with_warning"), ("area", "drop"))]


def cited(source, record):
    return {"source": source, "source_record_id": record, "locator": None, "url": None, "uncited": None, "reason": None}


def fragments(draw, source, n):
    entries = [{
        "source": source, "source_record_id": str(i), "provisional_id": f"e{draw.randint(0, 25)}", "family": "f", "kind": draw.choice(["board", "board", "agency", "area"]), "name": draw.choice(["Food", "food!", "Farms", "Zoo"]),
        "attributes": {"u_url": f'"https://x/{draw.randint(0, 4)}"', source: str(i)}, "citations": [cited(source, str(i))], "ord": {"binding": ord(source), "record": i, "emit": 0},
    } for i in range(n)]
    edges = [{"source": source, "source_record_id": str(i), "from_id": f"e{draw.randint(0, 27)}", "relation_kind": draw.choice(["governs", "old_governs"]), "to_id": f"e{draw.randint(0, 27)}", "citations": [cited(source, str(i))], "ord": {"binding": ord(source), "record": i, "emit": 1}} for i in range(n // 2)]
    return entries, edges


def plain(df):
    return sorted(str(r.asDict(recursive=True) | {"attributes": sorted((r["attributes"] or {}).items()) if "attributes" in df.columns else None}) for r in df.collect())


def assert_same(spark, ledger, held):
    entries = spark.createDataFrame([e for es, _ in held.values() for e in es], model.ENTRY_FRAGMENT)
    edges = spark.createDataFrame([r for _, rs in held.values() for r in rs], model.RELATION_FRAGMENT)
    merged, kept, _ = baseline(entries, edges, ledger.policy, ledger.kinds)
    assert plain(ledger.entries()) == plain(merged)
    assert plain(ledger.relations()) == plain(kept)
    packets, members = ca.find_candidates(merged, kept)
    assert plain(ledger.packets()) == plain(packets) and plain(ledger.members()) == plain(members)


def test_updates_equal_a_full_compile(spark, tmp_path, monkeypatch):
    draw, held = random.Random(4), {}
    ledger = inc.Ledger(spark, str(tmp_path), spark.createDataFrame(POLICY, "source string, kind string, action string"), {"old_governs": "governs"}, buckets=4)
    frames = lambda es, rs: (spark.createDataFrame(es, model.ENTRY_FRAGMENT), spark.createDataFrame(rs, model.RELATION_FRAGMENT))
    for source, n in (("a", 20), ("b", 14)):
        held[source] = fragments(draw, source, n)
        ledger.update(source, *frames(*held[source]))
    assert_same(spark, ledger, held)
    # some fragments of a source change, some go, some come
    es, rs = held["b"]
    for e in draw.sample(es, 4):
        e |= {"name": "Changed", "kind": draw.choice(["board", "area"])}
    held["b"] = (es[2:] + [fragments(draw, "b", 1)[0][0] | {"source_record_id": "new", "provisional_id": "e26"}], rs[3:])
    # lost between two tables, and run again
    real, calls = buckets.upsert, []

    def lost(*args, **how):
        calls.append(args[1])
        if len(calls) == 3:
            raise RuntimeError("lost")
        return real(*args, **how)

    monkeypatch.setattr(buckets, "upsert", lost)
    with pytest.raises(RuntimeError):
        ledger.update("b", *frames(*held["b"]))
    monkeypatch.setattr(buckets, "upsert", real)
    ledger.update("b", *frames(*held["b"]))
    assert_same(spark, ledger, held)
    held["a"] = ([], [])
    ledger.update("a", *frames(*held["a"]))
    assert_same(spark, ledger, held)


def test_an_update_reads_and_writes_what_it_touches(spark, tmp_path):
    row = lambda i, name: {"source": "a", "source_record_id": str(i), "provisional_id": f"e{i}", "family": "f", "kind": "board", "name": name, "attributes": {}, "citations": [cited("a", str(i))], "ord": {"binding": 0, "record": i, "emit": 0}}
    ledger = inc.Ledger(spark, str(tmp_path), spark.createDataFrame(POLICY, "source string, kind string, action string"), buckets=16)
    none = spark.createDataFrame([], model.RELATION_FRAGMENT)
    rows = [row(i, f"name {i}") for i in range(300)]
    ledger.update("a", spark.createDataFrame(rows, model.ENTRY_FRAGMENT), none)
    files = lambda: {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
    before = files()
    rows[7]["name"] = "other"
    ledger.update("a", spark.createDataFrame(rows, model.ENTRY_FRAGMENT), none)
    changed = {f.relative_to(tmp_path).parts[0] for f, t in files().items() if before.get(f) != t}
    count = sum(before.get(f) != t for f, t in files().items())
    assert changed == {"entry_fragments", "entries", "known", "block_keys"} and count <= 5
    found = buckets.lookup(spark, str(tmp_path / "entries"), spark.createDataFrame([("e7",)], "id string"), ["id"], ledger.entries().schema)
    assert found.count() == 1 and "bucket#" in found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    after = files()
    ledger.update("a", spark.createDataFrame(rows, model.ENTRY_FRAGMENT), none)
    assert files() == after and ledger.entries().where(F.col("name") == "other").count() == 1


def test_a_hot_id_is_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inc, "FILE_ROWS", 40, raising=False)
    draw = random.Random(7)
    hot, few = fragments(draw, "a", 400), fragments(draw, "b", 30)
    for e in hot[0][:350]:
        e["provisional_id"] = "e3"
    ledger = inc.Ledger(spark, str(tmp_path), spark.createDataFrame(POLICY, "source string, kind string, action string"), {"old_governs": "governs"}, buckets=4)
    for source, (es, rs) in (("a", hot), ("b", few)):
        ledger.update(source, spark.createDataFrame(es, model.ENTRY_FRAGMENT), spark.createDataFrame(rs, model.RELATION_FRAGMENT))
    stored = spark.read.parquet(str(tmp_path / "entry_fragments")).withColumn("file", F.input_file_name())
    sizes = {r["file"]: r["count"] for r in stored.groupBy("file").count().collect()}
    assert sum(sizes.values()) == 430 and max(sizes.values()) <= 80
    assert stored.where("provisional_id = 'e3' AND source = 'a'").select("file").distinct().count() >= 8
    # a bucket that is no larger than a file is one
    assert stored.where("source = 'b'").groupBy("part").agg(F.count_distinct("file").alias("n")).where("n > 1").isEmpty()
    assert_same(spark, ledger, {"a": hot, "b": few})
