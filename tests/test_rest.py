"""A paged service, played by SQLite: what is asked of it, and what comes."""

import json
import sqlite3

import pytest

from recolith.sources import rest

@pytest.fixture
def service(spark, tmp_path):
    con = sqlite3.connect(tmp_path / "service.db")
    con.execute("CREATE TABLE t (ID INTEGER PRIMARY KEY, NAME TEXT, N REAL, AT INTEGER, WIDE TEXT)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?)", [(i, None if i % 10 == 0 else f"name'{i % 4}", i / 2, 1_700_000_000_000 + i * 1000, "w" * 50) for i in range(1, 101)])
    con.commit()
    rest.register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield {"url": str(tmp_path), "id_field": "ID", "fetch": "tests.fake_service:fetch", "page_size": "15"}, tmp_path, con
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def requests(folder):
    path = folder / "requests"
    found = [json.loads(x) for x in path.read_text().splitlines()] if path.exists() else []
    path.write_text("")
    return found


def test_filters_columns_and_ranges_are_asked_for(spark, service):
    options, folder, _ = service
    table = spark.read.format("paged_json").options(**options, ranges="4").schema("ID long, NAME string, N double").load()
    got = table.where("NAME = \"name'1\" AND N > 10 AND ID IN (21, 25, 26, 29)").collect()
    assert sorted((r["ID"], r["NAME"], r["N"]) for r in got) == [(21, "name'1", 10.5), (25, "name'1", 12.5), (29, "name'1", 14.5)]
    asked = requests(folder)
    pages = [p for p in asked if "resultOffset" in p]
    assert pages and all(p["outFields"] == "ID,NAME,N" and "NAME = 'name''1'" in p["where"] and "N > 10.0" in p["where"] and "ID IN (21, 25, 26, 29)" in p["where"] for p in pages)
    assert len({p["where"] for p in pages}) == 3 and sum("outStatistics" in p for p in asked) >= 1  # ranges of [21, 29]
    whole = spark.read.format("paged_json").options(**options, ranges="3").load()
    assert whole.count() == 100 and sorted(int(r["key"]) for r in whole.select("key").collect()) == list(range(1, 101))
    assert json.loads(whole.where("key = '7'").first()["payload"])["WIDE"] == "w" * 50


def test_limit_and_counts(spark, service):
    options, folder, _ = service
    limited = spark.read.format("paged_json").options(**options, limit="20", where="ID > 30").load()
    assert sorted(int(r["key"]) for r in limited.collect()) == list(range(31, 51))
    pages = [p for p in requests(folder) if "resultOffset" in p]
    assert sorted((p["resultOffset"], p["resultRecordCount"], p["where"]) for p in pages) == [(0, 15, "ID > 30"), (15, 5, "ID > 30")]


def test_a_stream_of_new_ids(spark, service, tmp_path):
    options, folder, con = service
    out = str(tmp_path / "out")
    for more in (0, 7, 0):
        con.executemany("INSERT INTO t (NAME) VALUES (?)", [("new",)] * more)
        con.commit()
        stream = spark.readStream.format("paged_json").options(**options, ranges="2").schema("ID long, NAME string").load()
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
        assert query.exception() is None
    rows = spark.read.parquet(out)
    assert rows.count() == 107 and rows.select("ID").distinct().count() == 107
    pages = [p for p in requests(folder) if "resultOffset" in p]
    assert any("ID >= 101" in p["where"] for p in pages) and all(p["outFields"] == "ID,NAME" for p in pages)


def test_clauses():
    from pyspark.sql import datasource as ds

    columns = {"A"}
    one = lambda f: rest.clause(f, columns)
    assert one(ds.EqualTo(("A",), "it's")) == "A = 'it''s'" and one(ds.EqualTo(("B",), 1)) is None and one(ds.EqualTo(("A", "x"), 1)) is None
    assert one(ds.Not(ds.In(("A",), (1, 2)))) == "NOT (A IN (1, 2))" and one(ds.In(("A",), (1, None))) is None
    assert one(ds.StringStartsWith(("A",), "x")) == "A LIKE 'x%'" and one(ds.StringContains(("A",), "50%")) is None
    assert one(ds.IsNotNull(("A",))) == "A IS NOT NULL" and one(ds.EqualTo(("A",), True)) is None and one(ds.LessThan(("A",), float("nan"))) is None
    assert [(r.low, r.high) for r in rest.cut(1, 10, 3)] == [(1, 5), (5, 9), (9, 11)] and [(r.low, r.high) for r in rest.cut(5, 5, 9)] == [(5, 6)]
    assert rest.typed("x", rest.IntegralType()) is None and rest.typed(0, rest.DateType()).year == 1970
