"""Seeds, committee pages, public bodies, offices, bundles."""

import pytest
from pyspark.sql import functions as F

from recolith import sinks
from recolith.functions import text as tx
from recolith.functions import values as va
from recolith.operators import interpret as it
from recolith.operators import review
from recolith.sources import html as ht
from recolith.sources import seeds as sd


def test_seeds(spark):
    seed = spark.createDataFrame([("Code", "https://www.code.example/a#x")], "name string, url string")

    def refused():
        raise sd.Forbidden

    def broken():
        raise RuntimeError

    assert [r["from_seed"] for r in sd.live_or_seed(refused, seed).collect()] == [True] and [r["from_seed"] for r in sd.live_or_seed(lambda: seed, seed).collect()] == [False]
    with pytest.raises(RuntimeError):
        sd.live_or_seed(broken, seed)
    links = spark.createDataFrame([("Other", "https://code.example/a", 0), ("CODE!", "https://x", 1), ("New", "https://n", 2), ("New", "https://m", 3), ("Newer", "https://n", 4)], "name string, url string, pos int")
    assert {(r["name"], r["url"], r["from_seed"]) for r in sd.seeded(seed, links).collect()} == {("Code", "https://www.code.example/a#x", True), ("New", "https://n", False)}
    pages = spark.createDataFrame([(1, "https://www.code.example/a#x", "<h1>Head</h1><p>Text</p>")], "id int, url string, html string")
    assert sd.on_pages(seed, pages, ht.page_facts(pages, "id"), "id").first()["heading"] == "Head"


def test_committee_pages(spark):
    html = '<h1>Subcommittee on X</h1><a href="/councilmembers/a">Ann</a><h2>Chairperson</h2><a href="/councilmembers/b">Bob</a><a href="/councilmembers/a">Ann</a><a href="/x">no</a>'
    row = ht.committee_pages(spark.createDataFrame([(1, html), (2, "")], "id int, html string"), "id").orderBy("id").collect()
    assert row[0]["type"] == "subcommittee" and row[0]["chair"] == "/councilmembers/b" and [tuple(m) for m in row[0]["members"]] == [("Ann", "/councilmembers/a"), ("Bob", "/councilmembers/b")] and row[1]["members"] == []
    wards = spark.createDataFrame([("1A", "2"), ("1A", "1"), ("1A", "2")], "key string, value string")
    assert ht.grouped_values(wards, "key").first()["values"] == ["1", "2"]


def test_public_bodies_and_offices(spark):
    rows = spark.createDataFrame([("food-board", "Food Board", True), ("food-board-2", "Food  Board", False), ("zoning", "Zoning Commission", False), ("x", "Left out", True)], "slug string, name string, substantive boolean")
    trusted = spark.createDataFrame([("commission", "zoning commission", "commission:z2", 2), ("commission", "Zoning Commission", "commission:z1", 1)], "kind string, name string, id string, seq int")
    got = {r["slug"]: (r["kind"], r["id"], r["shadow"], r["stale"]) for r in it.public_bodies(rows, trusted, tx.BODY_RULES, {"food-board": "council"}, ("x",)).collect()}
    assert got == {"food-board": ("council", "council:food-board", False, False), "food-board-2": ("board", "board:food-board-2", False, True), "zoning": ("commission", "commission:z1", True, False)}
    plain, waiting = it.deferred_ids(spark.createDataFrame([("1A",), ("3/4G",)], "ref string"), "ref")
    assert plain.count() == waiting.count() == 1
    offices = spark.createDataFrame([("o1", "k0", None, None), ("o2", None, None, "Dept of X"), ("o3", "k3", "part_of", None)], "id string, parent_key string, relation_kind string, agency string")
    by_key = spark.createDataFrame([("k0", "o0"), ("k3", "o3")], "key string, id string")
    by_name = spark.createDataFrame([("department of x", "agency:x")], "key string, id string")
    assert {tuple(r) for r in it.office_edges(offices, by_key, by_name).collect()} == {("o1", "reports_to", "o0"), ("o2", "part_of", "agency:x")}


def test_small_values(spark):
    row = spark.range(1).select(
        tx.seat_sort_code(F.lit("Ward 7 Councilmember")).alias("a"), tx.seat_type(F.lit("Clerk")).alias("b"), tx.seat_description(F.lit("1A01"), F.lit(None).cast("string")).alias("c"),
        va.first_attribute(F.create_map(F.lit("x"), F.lit("null"), F.lit("y"), F.lit("12")), "x", "y").alias("d"),
    ).first()
    assert tuple(row) == ("2-007", None, "Seat for 1A01", "12")


def test_item_records_and_bundle(spark, tmp_path):
    items = spark.createDataFrame([("i", [{"source": "s", "source_record_id": "1"}, {"source": "s", "source_record_id": "2"}, {"source": None, "source_record_id": None}])], "item_id string, citations array<struct<source:string,source_record_id:string>>")
    records = spark.createDataFrame([("s", "1", "{}")], "source string, key string, payload string")
    assert {(r["key"], r["found"]) for r in review.item_records(items, records).collect()} == {("1", True), ("2", False)}
    table = spark.createDataFrame([("a", None), ("b", "x")], "k string, v string")
    made = sinks.write_bundle({"bundle_t": table}, str(tmp_path / "b"), {"bundle_t": ["k"]}, {"bundle_alias": "bundle_t"})
    assert {tuple(r) for r in made["bundle_alias"].collect()} == {("a", ""), ("b", "x")} and set(made) == {"bundle_t", "bundle_alias"}
    assert not spark.catalog.tableExists("bundle_alias")
    with pytest.raises(ValueError):
        sinks.write_bundle({"bundle_t": table.unionByName(table)}, str(tmp_path / "b"), {"bundle_t": ["k"]})
