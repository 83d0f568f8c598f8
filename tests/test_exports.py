"""Exports as ordered parts of one file, file digests of any size, and lost jobs."""

import csv
import hashlib
import io
import json

import pytest
from pyspark.sql import functions as F

from recolith import model, sinks
from recolith.sources import state as st


@pytest.fixture(autouse=True)
def many_parts(spark):
    """Small outputs in several parts, as large ones are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def joined(path, spark):
    return b"".join((path / p["name"]).read_bytes()[: p["bytes"]] for p in sinks.parts(spark, str(path)))


def test_parts_make_one_file(spark, tmp_path):
    rows = [(f"k{i:04d}", None if i % 7 == 0 else f'v "{i}", \n é', i) for i in range(2000)]
    table = spark.createDataFrame(rows, "k string, `a,b` string, n int").repartition(7)
    sinks.write_csv(table, str(tmp_path / "t.csv"), ["k"])
    whole = io.StringIO()
    csv.writer(whole, lineterminator="\n").writerows([["k", "a,b", "n"], *[[k, v or "", n] for k, v, n in rows]])
    text = joined(tmp_path / "t.csv", spark)
    assert list(csv.reader(io.StringIO(text.decode()))) == list(csv.reader(io.StringIO(whole.getvalue())))
    listed = sinks.parts(spark, str(tmp_path / "t.csv"))
    assert len(listed) > 2 and [p["offset"] for p in listed] == [sum(p["bytes"] for p in listed[:i]) for i in range(len(listed))]
    sinks.concatenate(spark, str(tmp_path / "t.csv"), str(tmp_path / "one.csv"))
    assert (tmp_path / "one.csv").read_bytes() == text
    back = st.read_csv(spark, str(tmp_path / "t.csv"))
    assert back.columns == ["k", "a,b", "n"] and back.count() == 2000
    sinks.write_json_array(table, str(tmp_path / "t.json"), [F.col("k").desc()])
    assert [(r["k"], r["a,b"], r["n"]) for r in json.loads(joined(tmp_path / "t.json", spark))] == rows[::-1]
    sinks.write_summary(table, str(tmp_path / "s.json"), ["k"])
    sinks.write_summary(table.limit(0), str(tmp_path / "none.json"), ["k"])
    assert len(json.loads((tmp_path / "s.json").read_text())) == 2000 and json.loads((tmp_path / "none.json").read_text()) == []
    sinks.write_csv(table.limit(0), str(tmp_path / "none.csv"), ["k"])
    assert joined(tmp_path / "none.csv", spark) == b'k,"a,b",n\n' and st.read_csv(spark, str(tmp_path / "none.csv")).count() == 0


def test_a_failed_export_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "t")
    good = spark.createDataFrame([("a", "1")], "k string, v string")
    for write in (sinks.write_csv, sinks.write_json_lines, sinks.write_json_array):
        write(good, path, ["k"])
        before = joined(tmp_path / "t", spark)
        bad = spark.range(100).repartition(4).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise("x").alias("v"))
        with pytest.raises(Exception, match="lost"):
            write(bad, path, ["k"])
        assert joined(tmp_path / "t", spark) == before


def test_exports_stay_below_their_path(spark, tmp_path):
    table = spark.createDataFrame([("b",), ("a",)], "k string")
    sinks.write_export({"in/t": (table, ["k"])}, str(tmp_path), "jsonl")
    assert joined(tmp_path / "in" / "t.jsonl", spark) == b'{"k":"a"}\n{"k":"b"}\n'
    with pytest.raises(ValueError):
        sinks.write_export({"fine": (table, ["k"]), "../t": (table, ["k"])}, str(tmp_path))
    assert not (tmp_path / "fine.csv").exists()


def test_findings_in_order(spark, tmp_path):
    cite = lambda s: {"source": s, "source_record_id": "1", "locator": None, "url": None, "uncited": None, "reason": None}
    rows = [("warn", "b", "m", cite("z")), ("warn", "b", "m", cite("a")), ("warn", "b", "m", None), ("conflict", "z", "q", None), ("warn", "a", "m", None)]
    sinks.write_findings(spark.createDataFrame(rows, model.FINDING).repartition(3), str(tmp_path / "f"))
    got = [json.loads(x) for x in joined(tmp_path / "f", spark).decode().splitlines()]
    assert [(r["kind"], r["code"], (r.get("citation") or {}).get("source")) for r in got] == [("conflict", "z", None), ("warn", "a", None), ("warn", "b", None), ("warn", "b", "a"), ("warn", "b", "z")]


def test_digests_of_files(spark, tmp_path):
    """Equal names in two folders, odd names, an empty file and one of 3 GB, beyond what one value can hold."""
    for name, data in [("a/x.csv", b"1"), ("b/x.csv", b"2"), ("b/with space+é%.txt", b"3"), ("empty", b"")]:
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    with open(tmp_path / "large", "wb") as f:
        f.truncate(3 << 30)
        f.seek(2 << 30)
        f.write(b"here")
    digest = hashlib.sha256()
    with open(tmp_path / "large", "rb") as f:
        while block := f.read(1 << 24):
            digest.update(block)
    got = {r["name"]: (r["bytes"], r["sha256"]) for r in sinks.manifest(spark, str(tmp_path)).collect()}
    assert got["large"] == (3 << 30, digest.hexdigest()) and got["a/x.csv"][1] == hashlib.sha256(b"1").hexdigest() and got["b/x.csv"][1] == hashlib.sha256(b"2").hexdigest()
    assert got["empty"] == (0, hashlib.sha256().hexdigest()) and got["b/with space+é%.txt"][1] == hashlib.sha256(b"3").hexdigest() and len(got) == 5
    small = str(tmp_path / "small")
    (tmp_path / "small").mkdir()
    (tmp_path / "small" / "f").write_bytes(bytes(range(250)))
    before = spark.createDataFrame(sinks.ranges(spark, small, 100).collect())
    assert [(r["at"], r["size"]) for r in before.orderBy("at").collect()] == [(0, 100), (100, 100), (200, 50)]
    tree = sinks.range_tree(before).first()["tree"]
    (tmp_path / "small" / "f").write_bytes(bytes(range(100)) + b"\0" + bytes(range(101, 250)))
    assert [tuple(r) for r in sinks.changed_ranges(sinks.ranges(spark, small, 100), before).collect()] == [("f", 100, "changed")]
    assert sinks.range_tree(sinks.ranges(spark, small, 100)).first()["tree"] != tree
