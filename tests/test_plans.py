"""Interpreters, review generation and public tables end to end, on small sources."""

import json

import pytest
from pyspark.sql import functions as F

from recolith import model, sinks
from recolith.operators import fragments as fr
from recolith.operators import graph, review
from recolith.operators.validate import Kind, Registry
from recolith.plans import interpreters as ip
from recolith.plans import public as pu
from recolith.plans.compile import compile_state
from recolith.plans.release import verify_release
from recolith.plans.review import generate, posture
from recolith.stages import materialise, shared_dir, spread


def records(spark, source, *payloads):
    rows = [(source, "all", str(i), p if p is None or isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, model.RECORD)


def got(made):
    entries = {r["provisional_id"]: r for r in made.entries.collect()}
    edges = {(r["from_id"], r["relation_kind"], r["to_id"]) for r in made.relations.collect()}
    return entries, edges, sorted(r["code"] for r in made.findings.collect())


def test_agencies_and_what_looks_them_up(spark):
    made, lookups = ip.agencies(records(spark, "gis", {"AGENCY_ID": 1, "NAME": "Dept of Food", "SHORT_NAME": "DF", "STATUTE": "D.C. Code § 1-2, D.C. Code § 0-1"}, {"AGENCY_ID": "2", "NAME": "Farms", "PARENT_AGENCY": 1}, {"AGENCY_ID": "3", "NAME": "Farms"}, {"NAME": "x"}, "[]", None, {"AGENCY_ID": 4, "NAME": "Own", "PARENT_AGENCY_ID": 4}))
    entries, edges, codes = got(made)
    assert set(entries) == {"agency:dept-of-food", "agency:farms", "agency:own", "legal_authority:d-c-code-1-2"} and entries["agency:dept-of-food"]["attributes"]["shortName"] == '"DF"'
    assert edges == {("agency:farms", "reports_to", "agency:dept-of-food"), ("agency:dept-of-food", "authorized_by", "legal_authority:d-c-code-1-2")}
    assert codes == ["identity.canonical_id_collision", "interpreter.agency_id_missing", "interpreter.invalid_payload", "interpreter.invalid_record"]
    # a rejected section is no citation
    assert [c["locator"] for c in entries["agency:dept-of-food"]["citations"]] == [None, "D.C. Code § 1-2"]

    offices, links, codes = got(ip.executive(records(spark, "mayor", {"key": "m", "name": "Mayor", "sourceUrl": "u", "entryKind": "office"}, {"key": "c", "name": "Clerk", "sourceUrl": "u", "entryKind": "office", "parentKey": "m", "relationKind": "part_of"}, {"key": "f", "name": "Department of Food", "sourceUrl": "u", "entryKind": "agency_ref", "parentKey": "m", "relationKind": "reports_to"}, {"key": "z", "name": "Nobody", "sourceUrl": "u", "entryKind": "agency_ref", "parentKey": "m"}, {"key": "l", "name": "Lost", "sourceUrl": "u", "entryKind": "office", "parentKey": "q", "relationKind": "part_of"}, {"key": "k", "name": "K", "sourceUrl": "u", "entryKind": "other"}), lookups))
    assert set(offices) == {"office:m", "office:c", "office:l"} and links == {("office:c", "part_of", "office:m"), ("agency:dept-of-food", "reports_to", "office:m")}
    assert codes == ["interpreter.executive_agency_unresolved", "interpreter.executive_parent_missing", "interpreter.executive_structure_missing_fields"]

    urls, none, codes = got(ip.directory(records(spark, "dir", {"name": "Department of Food (main)", "url": "https://f"}, {"name": "DF", "url": "https://g"}, {"name": "No", "url": "https://n"}, {"name": "x"}), lookups))
    assert urls["agency:dept-of-food"]["attributes"] == {"officialUrl": '"https://f"'} and not none and codes == ["interpreter.agency_directory_conflicting_url", "interpreter.agency_directory_missing_fields", "interpreter.agency_directory_unmatched"]

    bodies, links, codes = got(ip.public_bodies(records(spark, "open", {"name": "Food Board", "slug": "fb", "detailUrl": "u", "governingAgency": "Dept of Food", "administeringAgency": "Farms", "enablingStatuteUrl": "https://code.dccouncil.gov/us/dc/council/code/sections/3-4.html"}, {"name": "Food  board", "slug": "fb2", "detailUrl": "u"}, {"name": "Trusted Council", "slug": "tc", "detailUrl": "u", "governingAgency": "Unknown"}, {"name": "Thing", "slug": "t", "detailUrl": "u"}, {"name": "left", "slug": "x", "detailUrl": "u"}, {"name": "n"}), spark.createDataFrame([("council", "Trusted council", "council:9", 1)], "kind string, name string, id string, seq int"), lookups, excluded=("x",)))
    assert set(bodies) == {"board:fb", "council:9", "public_body:t", "legal_authority:d-c-code-3-4"} and bodies["public_body:t"]["kind"] == "agency"
    assert links == {("board:fb", "governs", "agency:dept-of-food"), ("board:fb", "affiliated_with", "agency:farms"), ("board:fb", "authorized_by", "legal_authority:d-c-code-3-4")}
    assert codes == ["interpreter.governing_agency_unresolved", "interpreter.public_body_missing_fields", "interpreter.public_body_source_shadow_merged", "interpreter.public_body_unclassified", "interpreter.stale_or_failed_duplicate"]


def test_profiles_and_entrypoints(spark):
    people = [{"smdId": "1A01", "name": "Ann", "officerRole": "Chair"}, {"smdId": "1A/02", "name": "Bob"}, {"name": "nobody"}]
    entries, edges, codes = got(ip.profiles(records(spark, "oanc", {"ancId": "1A", "name": "ANC 1A", "profileUrl": "https://p", "wardNumbers": ["2", "1", "1"], "commissioners": people}, {"ancId": "3/4G", "name": "ANC 3/4G", "profileUrl": "https://q", "commissioners": people[:1]}, {"ancId": "x"})))
    assert set(entries) == {"anc:1A", "anc:3~2F4G", "anc_commissioner_seat:1A01", "ward:1", "ward:2"} and json.loads(entries["anc:1A"]["attributes"]["sourceWardNumbers"]) == ["1", "2"]
    assert edges == {("ward:1", "contains", "anc:1A"), ("ward:2", "contains", "anc:1A")} and entries["anc_commissioner_seat:1A01"]["attributes"]["officerRole"] == '"Chair"'
    assert codes == ["interpreter.commissioner_slash_smd_deferred"] * 2 + ["interpreter.profile_missing_fields"]
    entries, _, codes = got(ip.entrypoints(records(spark, "law", {"name": "The Code", "url": "https://c", "fromSeed": True}, {"name": "x"})))
    assert entries["legal_entrypoint:the-code"]["attributes"] == {"officialUrl": '"https://c"', "sourceSeeded": "true"} and codes == ["interpreter.legal_entrypoint_missing_fields"]
    none = spark.createDataFrame([], model.RECORD)
    assert all(f.count() == 0 for f in (ip.members(none).entries, ip.smds(none).relations, ip.profiles(none).findings))


def test_areas_and_committees(spark):
    """Two records of areas give four entries and four relations, and no contacts."""
    entries, edges, codes = got(ip.smds(records(spark, "gis.smds", {"SMD_ID": "1A01", "ANC_ID": "1A", "NAME": "SMD 1A01", "REP_NAME": "Ann B", "FIRST_NAME": "Ann", "EMAIL": "a@b.org"}, {"SMD_ID": "3/4G01", "ANC_ID": "3/4G", "NAME": "SMD 3/4G01", "REP_NAME": "vacant"})))
    assert len(entries) == 4 and len(edges) == 4 and codes == ["interpreter.smd_representative_vacant"] and "a@b.org" not in str(entries)
    assert ("anc:3~2F4G", "contains", "smd:3~2F4G01") in edges and entries["anc_commissioner_seat:1A01"]["attributes"]["sourceFirstName"] == '"Ann"'
    roster = spark.createDataFrame([("councilmember:ann",), ("councilmember:bob",)], "member_id string")
    whole = {"committeeName": "Committee of the Whole", "committeeSlug": "whole", "committeeUrl": "https://w", "councilmembers": [{"name": "Ann", "url": "https://c/ann/"}]}
    health = {"committeeName": "Health", "committeeSlug": "health", "committeeUrl": "https://h", "committeeType": "standing", "chairpersonName": "Ann", "chairpersonUrl": "https://c/ann", "councilmembers": [{"name": "Cy", "url": "https://c/cy"}]}
    entries, edges, codes = got(ip.committees(records(spark, "council", whole, health, {"committeeName": "x"}), roster))
    assert set(entries) == {"committee:whole", "committee:health", "councilmember:cy"} and codes == ["interpreter.council_committee_chair_missing", "interpreter.council_committee_missing_fields"]
    assert edges == {("councilmember:ann", "member_of", "committee:whole"), ("councilmember:bob", "member_of", "committee:whole"), ("councilmember:ann", "chairs", "committee:health"), ("councilmember:ann", "member_of", "committee:health"), ("councilmember:cy", "member_of", "committee:health")}


CIVIC = Registry({k: Kind(f) for k, f in (("agency", "organization"), ("board", "organization"), ("councilmember", "person"), ("committee", "organization"), ("legal_authority", "authority"), ("ward", "area"), ("elected_office", "position"))}, {"governs", "reports_to", "authorized_by", "holds", "represents", "member_of", "chairs"})


def civic(spark):
    """Agencies, a board and members compiled to a state, with a committee beside."""
    made, lookups = ip.agencies(records(spark, "gis.agencies", {"AGENCY_ID": 1, "NAME": "Food"}, {"AGENCY_ID": 2, "NAME": "Farms", "PARENT_AGENCY": 1}))
    board = ip.bodies(records(spark, "gis.boards", {"BOARD_ID": 7, "NAME": "Food", "AGENCY_ID": 1, "LAW": "D.C. Law 1-2"}, {"BOARD_ID": 8, "NAME": "Zoning", "AGENCY_ID": 99}), lookups, "board")
    people = ip.members(records(spark, "council.members", {"memberName": "Ward 3 Councilmember Ann", "profileSlug": "ann", "profileUrl": "https://a"}, {"memberName": "Chairman Bob", "profileSlug": "bob", "profileUrl": "https://b"}, {"memberName": "At-Large Councilmember Cy", "profileSlug": "cy", "profileUrl": "https://c"}))
    return ip.together(made, board, people)


def test_compile_to_review(spark):
    """A relation to an agency that is nowhere stops the compile, and becomes a review item for its ending; so does a name that two kinds share."""
    made = civic(spark)
    policy = spark.createDataFrame([(s, k, "promote") for s in ("gis.agencies", "gis.boards", "council.members") for k in CIVIC.kinds if k != "ward"] + [("council.members", "ward", "drop")], "source string, kind string, action string")
    done = compile_state(materialise(made.entries, "entries"), materialise(made.relations, "relations"), policy, CIVIC)
    assert done.state is None and [r["code"] for r in done.conflicts.collect()] == ["compiler.conflict.relation_target_missing"]
    findings = materialise(made.findings.unionByName(done.findings), "findings")
    tracked = spark.createDataFrame([{"id": "r1", "source": "q", "target_kind": "entry", "target_id": "board:7", "target": None, "rationale": "r", "evidence": None, "patch": json.dumps({"review": {"decision": "preserve_distinct", "relatedEntryIds": ["agency:food"]}})}, {"id": "r2", "source": "q", "target_kind": "entry", "target_id": "agency:food", "target": None, "rationale": "r", "evidence": None, "patch": json.dumps({"suppress": True})}], model.REVISION)
    rows = {r["id"]: r for r in generate(*done.baseline, findings).items.withColumn("queue", review.queue()).collect()}
    missing = [r for r in rows.values() if r["category"] == "relation_endpoint_missing"]
    assert [(r["classification"], r["severity"], r["queue"]) for r in missing] == [("compiler_rule_bug", "high", "blocking")]
    assert (rows["same_normalized_name:food"]["category"], rows["same_normalized_name:food"]["queue"]) == ("kind_conflict", "blocking")
    assert {r["category"] for r in rows.values()} == {"relation_endpoint_missing", "kind_conflict", "out_of_scope_candidate"}
    after = generate(*done.baseline, findings, tracked)
    after.items = materialise(after.items, "items")
    rows = {r["id"]: r for r in after.items.collect()}
    assert rows["same_normalized_name:food"]["status"] == "applied" and not rows["same_normalized_name:food"]["blocks_release"]
    assert rows["tracked_revision:r1"]["category"] == "preserve_distinct_candidate" and rows["tracked_revision:r2"]["category"] == "source_shadow"
    # what r1 keeps apart r2 suppresses
    assert {tuple(r) for r in after.superseded.collect()} == {("tracked_revision:r1", "r2")}
    counts = {(r["section"], r["label"]): r["n"] for r in posture(after).collect()}
    # the law's locator is shared by its entry and the board: a conflict of kinds too
    assert counts[("queue", "applied")] == 4 and counts[("queue", "drafted")] == 0 and counts[("category", "kind_conflict")] == 2
    order = [(r["kind"], r["code"], r["message"]) for r in findings.orderBy(*fr.findings_order()).collect()]
    assert order == sorted(order)


def test_drafts_and_broad_directories(spark):
    cite = {"source": "dir", "source_record_id": "1", "locator": None, "url": "https://list", "uncited": None, "reason": None}
    entry = lambda i, s: {"id": f"agency:{i}", "family": "o", "kind": "agency", "name": f"N{i}", "attributes": {}, "citations": [{**cite, "source": s}]}
    entries = spark.createDataFrame([entry(i, "dir.a" if i % 2 else "gis.b") for i in range(10)], model.ENTRY)
    none, no_findings = spark.createDataFrame([], model.RELATION), spark.createDataFrame([], model.FINDING)
    item = "shared_url:https-list"
    drafts = spark.createDataFrame([{"id": "d1", "source": "q", "target_kind": "entry", "target_id": "x", "target": None, "rationale": "r", "evidence": None, "patch": "{}", "source_review_item_id": item}], model.REVISION + ", source_review_item_id string")
    made = generate(entries, none, no_findings, drafts=drafts)
    assert [(r["id"], r["status"]) for r in made.items.collect()] == [(item, "drafted")]
    tracked = drafts.drop("source_review_item_id").withColumn("target_id", F.lit("agency:1")).withColumn("patch", F.lit('{"name": "n"}'))
    assert generate(entries, none, no_findings, tracked).items.first()["status"] == "applied"
    assert generate(entries, none, no_findings, tracked, directory_url="https://list").items.first()["status"] == "open"


def test_boundary_items(spark):
    cite = {"source": "oanc.p", "source_record_id": "1", "locator": None, "url": None, "uncited": None, "reason": None}
    entry = lambda i, sid, **a: {"id": i, "family": "o", "kind": "anc", "name": i, "attributes": {"sourceAncId": json.dumps(sid), **{k: json.dumps(v) for k, v in a.items()}}, "citations": [cite]}
    entries = spark.createDataFrame([entry("anc:x", "3/4G", sourceOancProfileUrl="https://p"), entry("anc:y", "4g"), entry("anc:z", "5/4G")], model.ENTRY)
    made = generate(entries, spark.createDataFrame([], model.RELATION), spark.createDataFrame([], model.FINDING))
    assert [(r["id"], r["category"], r["source_families"]) for r in made.items.where("id LIKE 'profile%'").collect()] == [("profile_boundary:3-4g:4g", "identity_conflict", ["oanc"])]
    assert {r["key"] for r in made.keys.where("item_id LIKE 'profile%' AND type = 'id'").collect()} == {"anc:x", "anc:y"}


def test_public_tables_and_bundle(spark, tmp_path):
    made = civic(spark)
    cite = {"source": "council.committees", "source_record_id": "h", "locator": None, "url": "https://h", "uncited": None, "reason": None}
    committee = {"id": "committee:h", "family": "organization", "kind": "committee", "name": "Health", "attributes": {"committeeType": '"standing"'}, "citations": [cite]}
    seats = [{"from_id": f"councilmember:{m}", "kind": k, "to_id": "committee:h", "citations": [cite]} for m, k in (("ann", "member_of"), ("bob", "member_of"), ("cy", "member_of"), ("cy", "chairs"))]
    entries = materialise(fr.merge_entries(made.entries), "entries").unionByName(spark.createDataFrame([committee], model.ENTRY))
    relations = materialise(fr.dedupe_relations(made.relations), "relations").unionByName(spark.createDataFrame(seats, model.RELATION))
    coverage = spark.createDataFrame([("gis.agencies", "https://g", "gis", 2, 1, 2, "collected", "exported")], "source string, source_url string, family string, records long, snapshots long, citations long, collection_status string, release_status string")
    tables = pu.public_tables(entries, relations, coverage, {"authorized_by": graph.Verb("created_by", ("board",))}, pu.Names(preferred=(("board", ("gis.boards",)),)))
    assert len(tables) == 14 and all(tuple(t in df.columns for t in pu.ORDER[name]) for name, df in tables.items())
    row = tables["council_committees"].first()
    assert (row["member_count"], row["members"], row["chair_name"], row["committee_type"], row["source_url"], row["source_id"]) == (3, "Bob; Cy; Ann", "Cy", "standing", "https://h", "council.committees:h")
    people = {r["name"]: (r["sort_order"], r["seat_type"], r["is_at_large"]) for r in tables["councilmembers"].collect()}
    assert people == {"Ann": ("203", "ward", "false"), "Bob": ("00", "chairman", "true"), "Cy": ("1Cy", "at_large", "true")}
    bodies = {r["public_body_id"]: r for r in tables["public_bodies"].collect()}
    assert (bodies["board:7"]["enabling_authority"], bodies["board:7"]["agency_names"], bodies["board:8"]["agency_ids"], bodies["board:8"]["agency_names"]) == ("D.C. Law 1-2", "Food", "agency:99", "")
    assert [(r["parent_id"], r["parent_name"]) for r in tables["agencies"].where("agency_id = 'agency:farms'").collect()] == [("agency:food", "Food")]
    assert [(r["used_by_count"], r["used_by_ids"]) for r in tables["legal_authorities"].collect()] == [(1, "board:7")]
    labels = {(r["from_id"], r["relation_type"], r["to_type"]) for r in tables["relationships"].collect()}
    assert ("board:7", "created_by", "legal_authority") in labels and ("board:8", "governs", "") in labels
    assert tables["wards"].count() == 1 and tables["sources"].columns == list(pu.SOURCES) and tables["smds"].count() == tables["ancs"].count() == tables["courts"].count() == tables["offices"].count() == 0
    audit = pu.audit_tables(entries, relations)
    assert {(r["councilmember_name"], r["membership_role"]) for r in audit["committee_memberships"].collect()} == {("Ann", "member"), ("Bob", "member"), ("Cy", "chair")}
    assert audit["board_affiliations"].count() == 2 and {r["source"] for r in audit["source_counts"].collect()} >= {"gis.agencies", "council.committees"}
    written = pu.bundle(tables, {**audit, "entries": audit["entries"]}, str(tmp_path / "release"))
    assert written["council"].count() == 3 and (tmp_path / "release" / "relationships").is_dir()
    checks = {r["check"]: r["ok"] for r in verify_release({**tables, "entries": entries, "relations": relations, "source_counts": audit["source_counts"]}, sinks.catalogue({"entries": entries}), {}, {}, coverage=coverage).collect()}
    assert checks["rows:entries"] and checks["coverage:collection_status"] and checks["coverage:release_status"] and not checks["coverage:citations"] and not checks["relations:dangling"]


def test_related_lists_of_hubs(spark):
    entries = spark.createDataFrame([(f"e{i}", f"n{9 - i}") for i in range(5)] + [("hub", "h")], "id string, name string")
    relations = spark.createDataFrame([(f"e{i}", "k", "hub") for i in range(5)] + [("e0", "k", "hub"), ("e0", "k", "e1")], "from_id string, kind string, to_id string")
    full = {r["id"]: r for r in graph.related_list(relations, entries, "k", incoming=True).collect()}
    assert (full["hub"]["n"], full["hub"]["names"], full["hub"]["ids"]) == (6, "n5; n6; n7; n8; n9", "e4; e3; e2; e1; e0") and full["e1"]["names"] == "n9"
    short = {r["id"]: r for r in graph.related_list(relations, entries, "k", incoming=True, most=3).collect()}
    assert short == full


def test_lists_of_a_large_hub(spark):
    """100,000 members of one key in chunks: no row holds more than a chunk's members before the text is put together."""
    n = 100_000
    rows = spark.range(n).select(F.when(F.col("id") % 1000 == 0, "small").otherwise("hub").alias("key"), F.sha2(F.col("id").cast("string"), 256).substr(1, 12).alias("name"))
    chunks = graph.list_chunks(rows, "key", ["name"], ["name"], 1000)
    assert chunks.agg(F.max("n")).first()[0] == 1000 and chunks.where("key = 'hub'").count() == 100
    got = {r["key"]: r for r in graph.listed(rows, "key", ["name"], ["name"], most=5000).collect()}
    whole = {r["key"]: r["l"] for r in rows.groupBy("key").agg(F.array_sort(F.collect_list("name")).alias("l")).collect()}
    assert {k: (r["n"], r["name"]) for k, r in got.items()} == {k: (len(v), "; ".join(v)) for k, v in whole.items()}
    assert graph.listed(rows.limit(0), "key", ["name"], ["name"]).count() == 0


def test_shared_folder_on_a_cluster_must_be_named():
    class Spark:
        conf = type("Conf", (), {"get": lambda self, *_: None})()
        sparkContext = type("Context", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError):
        shared_dir(Spark())


def test_payloads_of_one_file_are_parsed_once_by_all_cores(spark):
    one = records(spark, "council", {"memberName": "Ward 1 Councilmember Ann", "profileSlug": "ann", "profileUrl": "https://a"}, {"memberName": "x"}, None, "[1]").coalesce(1)
    assert spread(one).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    rows, bad = ip.parsed(one, title="memberName", slug="profileSlug")
    assert sorted(r["code"] for r in bad.collect()) == ["interpreter.invalid_payload", "interpreter.invalid_record"]
    assert "parse_json" not in rows.where("slug IS NOT NULL").select("title", "slug")._jdf.queryExecution().optimizedPlan().toString()
    made = ip.members(one)
    assert all("parse_json" not in df._jdf.queryExecution().optimizedPlan().toString() for df in (made.entries, made.relations))
    assert {r["provisional_id"] for r in made.entries.collect()} == {"councilmember:ann", "elected_office:ward-1-councilmember", "ward:1"}


def test_public_tables_need_leading_citations_alone(spark):
    made = ip.members(records(spark, "b.council", *[{"memberName": f"Chairman M{i}", "profileSlug": f"m{i}", "profileUrl": "https://a"} for i in range(5)]))
    more = made.entries.withColumns({"source": F.lit("a.other"), "citations": F.transform("citations", lambda c: c.withField("source", F.lit("a.other")))})
    fragments = made.entries.unionByName(more)
    names = pu.Names(preferred=(("councilmember", ("b.council",)),))
    coverage = spark.createDataFrame([("a.other", "https://o"), ("b.council", "https://b")], "source string, source_url string")
    whole, lean = fr.merge_entries(fragments), fr.merge_entries(fragments, names.leading())
    # five records cite the office, and two citations stand for them
    assert {r["id"]: [(c["source"], c["source_record_id"]) for c in r["citations"]] for r in lean.collect()}["elected_office:council-chairman"] == [("a.other", "0"), ("b.council", "0")]
    assert whole.where("size(citations) = 10").count() == 1 and lean.where("size(citations) > 2").count() == 0
    for name in ("councilmembers", "relationships"):
        every = pu.public_tables(whole, fr.dedupe_relations(made.relations), coverage, names=names)[name]
        few = pu.public_tables(lean, fr.dedupe_relations(made.relations, names.leading()), coverage, names=names)[name]
        assert sorted(map(str, every.collect())) == sorted(map(str, few.collect())) and few.count() == 5


def test_payloads_without_titles_are_not_read_for_citations(spark):
    from recolith.functions import citations as ci

    payloads = [None, "no object", '{"NAME": "x"}', '{"LAW": "D.C. Law 1-2; 5 U.S.C. 7"}', '{"LAW": "D.C.\\nCode \u00a7 1-2"}', '{"legal basis": "\\u0044.C. Law 3-4"}', '{"NAME": "D.C. Law 5-6"}']
    rows = spark.createDataFrame([(p,) for p in payloads], "payload string").select(ci.payload_locators(F.col("payload")).alias("new"), ci.locators_of(ci.payload_text(F.col("payload"))).alias("old")).collect()
    assert [r["new"] for r in rows] == [r["old"] for r in rows] and sum(bool(r["new"]) for r in rows) == 3


def test_commissions_read_written_areas(spark):
    made = civic(spark)
    tables = pu.public_tables(materialise(fr.merge_entries(made.entries), "entries"), materialise(fr.dedupe_relations(made.relations), "relations"), spark.createDataFrame([("gis.ancs", "https://a")], "source string, source_url string"))
    assert not any("public-relations" in f for f in tables["ancs"].inputFiles())
