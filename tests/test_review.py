"""Review items: status after revisions, stale duplicates, boundaries, drafts."""

import json

import pytest
from pyspark.sql import functions as F

from recolith import model
from recolith.operators import candidates as ca
from recolith.operators import drafts, review
from recolith.sources.state import load_revisions


def items(spark, *rows):
    base = {"category": "source_shadow", "classification": "curation_conflict", "severity": "high", "confidence": "high", "status": "open", "source_type": "reconciliation_candidate", "reason": "shared_url", "title": "t", "source_families": ["s"], "finding_code": None, "n_entries": 2, "blocks_state": False, "blocks_release": True}
    return spark.createDataFrame([base | r for r in rows], review.ITEM)


def test_status_after_revisions(spark):
    rows = items(spark, {"id": "a"}, {"id": "b"}, {"id": "c"}, {"id": "d"})
    pairs = lambda *x: spark.createDataFrame(list(x), "item_id string, revision_id string")
    got = review.revised(rows, pairs(("a", "1"), ("a", "2"), ("d", "1")), pairs(("a", "3"), ("b", "3")), spark.createDataFrame([("d",)], "item_id string"))
    assert {r["id"]: (r["status"], r["blocks_release"], r["queue"]) for r in got.withColumn("queue", review.queue()).collect()} == {"a": ("applied", False, "applied"), "b": ("drafted", True, "drafted"), "c": ("open", True, "blocking"), "d": ("open", False, "actionable")}
    assert [r["id"] for r in review.inbox(got).orderBy("id").collect()] == ["c", "d"] and review.next_item(got).first()["id"] == "c"
    assert {r["queue"]: r["n"] for r in review.queue_counts(got).collect()} == {"blocking": 1, "actionable": 1, "drafted": 1, "applied": 1, "deferred": 0}


def test_stale_packets(spark):
    cite = {"source": "open_dc.public_bodies", "source_record_id": "1", "locator": None, "url": None, "uncited": None, "reason": None}
    entry = lambda id_, **a: {"id": id_, "family": "o", "kind": "board", "name": "Same", "attributes": {k: json.dumps(v) for k, v in a.items()}, "citations": [cite]}
    none = spark.createDataFrame([], model.RELATION)
    weak, strong = entry("a", shortName="x", description="Report website problems to: x"), entry("b", officialUrl="https://x")
    found = lambda *rows: review.stale_packets(ca.members(spark.createDataFrame(list(rows), model.ENTRY), none), "open_dc.public_bodies").count()
    assert found(weak, strong) == 1 and found(weak, entry("c", shortName="y")) == 0 and found(strong, entry("d", officialUrl="https://y")) == 0


def test_boundaries_and_superseded(spark):
    entries = spark.createDataFrame([("x", "3/4G"), ("y", "4g"), ("z", "1A")], "id string, sid string")
    assert [tuple(r) for r in review.boundary_items(entries, F.col("sid")).collect()] == [("x", "y", "4G")]
    rows = spark.createDataFrame([("i", ["a", "b"]), ("j", ["c"])], "item_id string, ids array<string>")
    assert [tuple(r) for r in review.superseded(rows, spark.createDataFrame([("r", "b")], "revision_id string, target_id string")).collect()] == [("i", "r")]
    assert set(review.RESOLUTIONS) >= {"kind_conflict", "incomplete_entry"}
    assert spark.range(1).select(review.resolutions(F.lit("out_of_scope_candidate")).alias("r")).first()["r"] == ["suppress"]


def test_drafts(spark, tmp_path):
    item = {"id": "shared_url:x", "ids": ["b", "a"], "citations": []}
    assert json.loads(drafts.draft(item, "source-shadow", "a")["patch"]) == {"suppress": True, "review": {"decision": "source_shadow", "canonicalEntryId": "a"}}
    assert drafts.draft(item, "source-shadow", "a")["target_id"] == "b" and drafts.draft(item, "preserve-distinct")["related_ids"] == ["b"]
    assert json.loads(drafts.draft(item, "alias", "a", names={"a": "A", "b": "B"})["patch"])["review"]["aliasNames"] == ["B"]
    for bad in (("source-shadow", None, None), ("alias", "a", None), ("override-kind", None, None), ("suppress", "z", None), ("unknown", None, None)):
        with pytest.raises(ValueError):
            drafts.draft(item, *bad)
    made = drafts.draft(item, "override-kind", kind="agency")
    drafts.apply_draft(made, tmp_path)
    with pytest.raises(FileExistsError):
        drafts.apply_draft(made, tmp_path)
    (got,) = load_revisions(spark, str(tmp_path)).collect()
    assert got["target_id"] == "a" and json.loads(got["patch"]) == {"kind": "agency"}
