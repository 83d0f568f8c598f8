"""Tables that are written by parts: what a batch rewrites, maps, nulls, lost writers, streams."""

import json
import random

import pytest
from pyspark.sql import functions as F

from recolith import buckets, model, sinks
from recolith.streaming.collect import collect_stream


def files_of(path):
    return {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def entries(spark, rows):
    cite = {"source": "s", "source_record_id": "1", "locator": None, "url": None, "uncited": None, "reason": None}
    return spark.createDataFrame([{"id": i, "family": "f", "kind": "k", "name": n, "attributes": {"b": n, "a": "1"}, "citations": [cite]} for i, n in rows], model.ENTRY)


def test_upserts_of_maps_against_a_dict(spark, tmp_path):
    draw, table, held = random.Random(1), str(tmp_path / "t"), {}
    for _ in range(4):
        rows = [(draw.choice([None, *(f"e{i}" for i in range(40))]), draw.choice("pqrs")) for _ in range(30)]
        sinks.upsert(entries(spark, rows), table, ["id"], buckets=8)
        batch = {}
        for i, n in rows:
            batch[i] = max(batch.get(i, n), n)
        held |= batch
        got = sinks.read_table(spark, table)
        assert {r["id"]: (r["name"], r["attributes"]["b"]) for r in got.collect()} == {i: (n, n) for i, n in held.items()} and got.count() == len(held)
    assert got.columns == entries(spark, []).columns
    same = sinks.content_fingerprint(got).first()
    assert same == sinks.content_fingerprint(got.repartition(3)).first() != sinks.content_fingerprint(got.withColumn("attributes", F.create_map(F.lit("a"), F.lit("2")))).first()
    nested = spark.createDataFrame([(1, [{"x": {"p": 1, "q": 2}}])], "k int, v array<struct<x:map<string,int>>>")
    swapped = spark.createDataFrame([(1, [{"x": {"q": 2, "p": 1}}])], nested.schema)
    assert sinks.content_fingerprint(nested).first() == sinks.content_fingerprint(swapped).first()
    sinks.upsert(nested.unionByName(swapped), str(tmp_path / "n"), ["k"])
    assert sinks.read_table(spark, str(tmp_path / "n")).count() == 1
    with pytest.raises(ValueError):
        sinks.upsert(nested.withColumn("bucket", F.lit(1)), table, ["k"])


def test_batches_rewrite_what_they_touch(spark, tmp_path):
    path = tmp_path / "t"
    first = spark.range(5000).select(F.col("id").cast("string").alias("key"), F.lit("old").alias("v"))
    assert len(sinks.upsert(first, str(path), ["key"], buckets=64)) == 64
    before = files_of(path)
    touched = sinks.upsert(spark.createDataFrame([("7", "new"), ("new", "new")], first.schema), str(path), ["key"])
    after = files_of(path)
    assert 1 <= len(touched) <= 2
    assert {f.parent.name for f in set(before.items()) ^ set(after.items()) for f in [f[0]]} == set(touched)
    got = {r["key"]: r["v"] for r in sinks.read_table(spark, str(path)).collect()}
    assert got == {str(i): "old" for i in range(5000)} | {"7": "new", "new": "new"}
    assert sinks.upsert(first.limit(0), str(path), ["key"]) == [] and files_of(path) == after
    # outgrown buckets are cut into four
    sinks.upsert(first, str(path), ["key"], bucket_bytes=100)
    assert {p.name.rsplit("of")[-1] for p in path.iterdir() if p.name.startswith("bucket=")} == {"00256"}
    assert sinks.read_table(spark, str(path)).where("v = 'old'").count() == 5000


def test_a_stream_of_small_batches_writes_little(spark, tmp_path):
    """A dozen batches of one record: the bytes written follow the batches."""
    path, inbox = tmp_path / "t", tmp_path / "in"
    spark.range(20_000).select(F.lit("s").alias("source"), F.lit("k").alias("snapshot_key"), F.col("id").cast("string").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("payload")).createOrReplaceTempView("many_records")
    sinks.upsert(spark.table("many_records"), str(path), ["source", "key"], buckets=128)
    whole = sum(f.stat().st_size for f in path.rglob("*.parquet"))
    inbox.mkdir()
    for i in range(12):
        (inbox / f"{i}.json").write_text(json.dumps({"source": "s", "snapshot_key": "k", "key": str(i), "payload": "new"}) + "\n")
    stream = spark.readStream.schema(model.RECORD).option("maxFilesPerTrigger", 1).json(str(inbox))
    before = files_of(path)
    query = collect_stream(stream, str(path), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert query.exception() is None
    written = sum(f.stat().st_size for f, t in files_of(path).items() if before.get(f) != t)
    assert 0 < written <= whole * 12 / 128 * 2
    got = sinks.read_table(spark, str(path))
    assert got.count() == 20_000 and got.where("payload = 'new'").count() == 12


@pytest.mark.parametrize("moved", [0, 1, 2])
def test_a_writer_lost_between_two_parts(spark, tmp_path, monkeypatch, moved):
    """Complete parts move in, whichever of them had; incomplete ones never count."""
    path = tmp_path / "t"
    first = spark.createDataFrame([(s, str(i), "old") for s in "abc" for i in range(3)], "source string, key string, v string")
    sinks.replace_source(first, str(path), ["a", "b", "c"])
    recover = buckets.recover
    monkeypatch.setattr(buckets, "recover", lambda spark, path: None)
    sinks.replace_source(spark.createDataFrame([("a", "1", "new"), ("b", "2", "new")], first.schema), str(path), ["a", "b", "c"])
    monkeypatch.setattr(buckets, "recover", recover)
    parts = tmp_path / "t.next"
    assert parts.exists() and spark.read.parquet(str(path)).where("v = 'old'").count() == 9
    for name in ["source=a", "source=b"][:moved]:
        for f in (path / name).iterdir():
            f.unlink()
        (path / name).rmdir()
        if name == "source=a":
            (parts / name).rename(path / name)
    sinks.recover(spark, str(path))
    assert {tuple(r) for r in spark.read.parquet(str(path)).select("source", "key", "v").collect()} == {("a", "1", "new"), ("b", "2", "new")} and not parts.exists()
    (tmp_path / "t.abandoned").mkdir()
    sinks.recover(spark, str(path))
    assert spark.read.parquet(str(path)).count() == 2
