"""Operators and plans on small fixtures: order independence, overlays, candidates, validation, sources, sinks."""

import json
import random

import pytest
from pyspark.sql import functions as F

from recolith import model, sinks
from recolith.functions.citations import authority, is_rejected
from recolith.operators import candidates as ca
from recolith.operators import fragments as fr
from recolith.operators import graph as gr
from recolith.operators import interpret as it
from recolith.operators import replay as rp
from recolith.operators import revisions as rv
from recolith.operators import windows as wi
from recolith.operators.validate import Kind, Registry, entry_issues, relation_issues
from recolith.plans.compile import compile_state
from recolith.plans.release import release_tables, verify_export, verify_release
from recolith.stages import materialise
from recolith.sources import html as ht
from recolith.sources import state as st
from recolith.streaming.collect import collect_stream


def cited(source, record="r", locator=None, url=None):
    return {"source": source, "source_record_id": record, "locator": locator, "url": url, "uncited": None, "reason": None}


def frag(id_, record="r", binding=0, n=0, source="s", kind="board", family="organization", name="N", attributes=None, citations=None):
    return {"source": source, "source_record_id": record, "provisional_id": id_, "family": family, "kind": kind, "name": name, "attributes": attributes or {}, "citations": [cited(source, record)] if citations is None else citations, "ord": {"binding": binding, "record": n, "emit": 0}}


def edge(from_id, kind, to_id, n=0, citations=None):
    return {"source": "s", "source_record_id": "r", "from_id": from_id, "relation_kind": kind, "to_id": to_id, "citations": citations or [], "ord": {"binding": 0, "record": n, "emit": 0}}


def entry(id_, kind="board", name="N", family="organization", attributes=None, citations=None):
    return {"id": id_, "family": family, "kind": kind, "name": name, "attributes": attributes or {}, "citations": citations or []}


def frames(spark, rows, edges):
    return spark.createDataFrame(rows, model.ENTRY_FRAGMENT), spark.createDataFrame(edges, model.RELATION_FRAGMENT)


def policy(spark, *rows):
    return spark.createDataFrame(rows or [("s", "board", "promote")], "source string, kind string, action string")


REGISTRY = Registry({"board": Kind("organization", {"n": ("number", False)}), "agency": Kind("organization")}, {"governs", "part_of"})


def test_merge_does_not_depend_on_order(spark):
    draw = random.Random(1)
    rows = [frag("a", f"r{draw.randint(0, 3)}", binding=draw.randint(0, 2), n=i, source=f"s{i % 3}", kind=draw.choice(["board", "agency"]), family=f"f{i}", name="x" * draw.randint(1, 4) + str(i % 10), attributes={draw.choice("pqr"): str(i)}) for i in range(40)]
    one = fr.merge_entries(frames(spark, rows, [])[0]).first()
    draw.shuffle(rows)
    two = fr.merge_entries(frames(spark, rows, [])[0].repartition(5)).first()
    assert one == two
    ordered = sorted(rows, key=lambda r: (r["source_record_id"], r["ord"]["binding"], r["ord"]["record"]))
    longest = max(len(r["name"]) for r in rows)
    attributes = {}
    for r in ordered:
        attributes |= r["attributes"]
    assert one["kind"] == ordered[0]["kind"] and one["family"] == ordered[-1]["family"] and one["attributes"] == attributes
    assert one["name"] == next(r["name"] for r in ordered if len(r["name"]) == longest)


def test_merge_keeps_entries_without_attributes_and_drops_invalid_citations(spark):
    got = fr.merge_entries(frames(spark, [frag("a", citations=[cited(None), {**cited(None), "uncited": True, "reason": "x"}])], [])[0]).first()
    assert got["attributes"] == {} and [c["reason"] for c in got["citations"]] == ["x"]


def test_compile(spark):
    rows = [frag("board:a", n=1), frag("agency:b", n=2, kind="agency"), frag("board:c", n=3, source="t"), frag("board:d", n=4, source="u")]
    edges = [edge("board:a", "affiliated_with", "agency:b", 1, [cited("s", "1")]), edge("board:a", "governs", "agency:b", 2, [cited("s", "2")]), edge("board:a", "governs", "board:c", 3), edge("board:d", "governs", "board:a", 4)]
    rules = policy(spark, ("s", "board", "promote"), ("s", "agency", "promote_with_warning"), ("t", "board", "drop"), ("u", "board", "review_required"))
    made = compile_state(*frames(spark, rows, edges), rules, REGISTRY, {"affiliated_with": "governs"})
    assert made.state is not None and made.conflicts.isEmpty()
    assert {r["id"] for r in made.state[0].collect()} == {"board:a", "agency:b"}
    (kept,) = made.state[1].collect()
    assert (kept["from_id"], kept["kind"], kept["to_id"]) == ("board:a", "governs", "agency:b") and [c["source_record_id"] for c in kept["citations"]] == ["1", "2"]
    codes = sorted(r["code"] for r in made.findings.collect())
    assert codes == ["compiler.relation_kind_canonicalized", "compiler.relation_source_not_promoted", "compiler.relation_target_not_promoted", "promotion.drop", "promotion.promote_with_warning", "promotion.review_required"]


@pytest.mark.parametrize(
    ("rows", "edges", "code"),
    [
        ([frag("a"), frag("a", "r2", kind="agency")], [], "compiler.conflict.entry_kind_mismatch"),
        ([frag("a")], [edge("a", "governs", "nowhere")], "compiler.conflict.relation_target_missing"),
        ([frag("a")], [edge("nowhere", "governs", "nowhere")], "compiler.conflict.relation_source_missing"),
        ([frag("a"), frag("b", source="unknown")], [], "promotion.conflict"),
        ([frag("a", attributes={"n": '"text"'})], [], "entry.attribute_type"),
        ([frag("a"), frag("b")], [edge("a", "elects", "b")], "entry.relation_kind_unknown"),
    ],
)
def test_conflicts_stop_the_compile(spark, rows, edges, code):
    made = compile_state(*frames(spark, rows, edges), policy(spark, ("s", "board", "promote"), ("s", "agency", "promote")), REGISTRY)
    assert made.state is None and code in {r["code"] for r in made.conflicts.collect()}


def revision(id_, target, patch, kind="entry", selector=None):
    return {"id": id_, "source": "curator", "target_kind": kind, "target_id": target, "target": selector, "rationale": "because", "evidence": None, "patch": json.dumps(patch)}


def shadow(of):
    return {"suppress": True, "review": {"decision": "source_shadow", "canonicalEntryId": of}}


def test_revisions(spark):
    rows = [frag(f"board:{x}", n=i) for i, x in enumerate("abcd")]
    edges = [edge("board:a", "governs", "board:b"), edge("board:c", "governs", "board:b"), edge("board:a", "part_of", "board:d")]
    revisions = [
        revision("3", "board:a", {"name": "New", "attributes": {"n": 1}, "citations": [cited("x")], "review": {"decision": "preserve_distinct", "relatedEntryIds": ["board:c"]}}),
        revision("1", "old-b", shadow("board:c")),
        revision("2", "board:d", {"suppress": True}),
    ]
    aliases = spark.createDataFrame([{"id": "al", "canonical_id": "board:b", "previous_ids": ["old-b"], "source_refs": [], "kind": None, "name": None, "rationale": "", "evidence": []}], model.ALIAS)
    made = compile_state(*frames(spark, rows, edges), policy(spark), REGISTRY, revisions=spark.createDataFrame(revisions, model.REVISION), aliases=aliases)
    assert made.state is not None
    entries = {r["id"]: r for r in made.state[0].collect()}
    assert set(entries) == {"board:a", "board:c"} and entries["board:a"]["name"] == "New" and entries["board:a"]["attributes"]["n"] == "1"
    assert json.loads(entries["board:a"]["attributes"]["revisionReviews"])[0]["revisionId"] == "3" and entries["board:a"]["citations"][0]["source"] == "x"
    # the edge to the shadow leads to what it shadows, but not from that to itself
    assert [(r["from_id"], r["to_id"]) for r in made.state[1].collect()] == [("board:a", "board:c")]
    assert {r["id"] for r in made.baseline[0].collect()} == {f"board:{x}" for x in "abcd"} and made.baseline[1].count() == 3


def replayed(spark, revisions, ids, aliases=()):
    """Codes of findings by revision, and where edges to suppressed ids go."""
    alias = [{"id": str(i), "canonical_id": c, "previous_ids": [k] if t == "id" else None, "source_refs": [cited("s", k)] if t == "ref" else None, "kind": None, "name": None, "rationale": None, "evidence": None} for i, (t, k, c) in enumerate(aliases)]
    done = rp.replay(spark.createDataFrame(revisions, model.REVISION), spark.createDataFrame([entry(i) for i in ids], model.ENTRY), spark.createDataFrame(alias, model.ALIAS))
    return {(f["message"].split(":")[0], f["code"].rsplit(".", 1)[1]) for f in done.findings.collect()}, {r["id"]: r["replacement"] for r in done.suppressed.collect()}


def test_retargeting_follows_the_order_of_revisions(spark):
    rows = [revision("1", "x", shadow("y")), revision("2", "y", shadow("z")), revision("3", "q", shadow("r")), revision("4", "p", shadow("q")), revision("5", "o", {"suppress": True}), revision("6", "o", {"name": "n"})]
    said, ends = replayed(spark, rows, "xyzpqro")
    assert ends == {"x": "z", "y": "z", "q": "r", "p": "q", "o": None}
    assert ("6", "revision_target_missing") in said and len(said) == 6


def test_revision_targets(spark):
    select = lambda **k: {"canonical_id": None, "previous_ids": None, "source_refs": None, "kind": None, "name": None} | k
    rows = [
        revision("1", "a", {"name": "x"}, selector=select(canonical_id="b")), revision("2", "c", {"name": "x"}, selector=select(kind="agency")), revision("3", "old", {"name": "x"}),
        revision("4", "gone", {"name": "x"}, selector=select(source_refs=[cited("s", "9")])), revision("5", "d", {}, kind="relation"), revision("6", "e", shadow("old")),
    ]
    said, ends = replayed(spark, rows, "abcdefg", [("id", "old", "f"), ("id", "old", "g"), ("ref", "9", "f")])
    assert said == {("1", "revision_target_ambiguous"), ("2", "revision_target_guard_mismatch"), ("3", "revision_target_ambiguous"), ("5", "revision_invalid_state"), ("6", "revision_invalid_state")} and not ends


def test_relation_patches_replace_all_relations(spark):
    rows = [frag("a"), frag("b"), frag("c")]
    made = compile_state(*frames(spark, rows, [edge("a", "governs", "b"), edge("a", "part_of", "c")]), policy(spark), REGISTRY, revisions=spark.createDataFrame([revision("1", "a", {"relations": {"governs": [{"kind": "governs", "to": "c"}]}}, kind="relation")], model.REVISION))
    assert [(r["kind"], r["to_id"]) for r in made.state[1].collect()] == [("governs", "c")]


def test_revision_rules(spark):
    bad = [revision("1", "", {"x": 1}), revision("2", "a", {"suppress": True}, kind="relation"), {**revision("3", "a", {"suppress": True}), "rationale": " "}, revision("4", "a", {"review": {"decision": "alias"}}), {**revision("5", "a", {}), "patch": "[]"}, revision("6", "a", {"name": "fine"})]
    got = {(r["id"], r["rule"]) for r in rv.revision_issues(spark.createDataFrame(bad, model.REVISION)).collect()}
    assert got == {("1", "target_id"), ("2", "suppress"), ("3", "suppress"), ("4", "alias"), ("5", "patch")}


def candidates(spark, entries, edges=(), prefix=""):
    found, members = ca.find_candidates(spark.createDataFrame(entries, model.ENTRY), spark.createDataFrame(list(edges), model.RELATION), prefix)
    return {r["id"]: r for r in found.collect()}, members


def test_candidates_by_name(spark):
    found, members = candidates(spark, [entry("a", "council", "Food Policy Council", citations=[cited("gis.c")]), entry("b", "council", "Food  policy COUNCIL!", citations=[cited("open.b")]), entry("c", "council", "Other")])
    (packet,) = found.values()
    assert packet["id"] == "same_normalized_name:food-policy-council" and (packet["severity"], packet["confidence"], packet["review_category"], packet["risks"]) == ("medium", "high", "source_shadow", ["cross_source_shadow"])
    assert packet["source_families"] == ["gis", "open"] and {r["entry_id"] for r in members.collect()} == {"a", "b"}


def test_candidates_by_url_and_locator(spark):
    rows = [entry("a", "board", "A", attributes={"webUrl": '"https://x.example/path/?utm=1"'}, citations=[cited("s", locator="D.C.  Code § 1-1")]), entry("b", "agency", "B", attributes={"home_url": '"HTTPS://x.example/path#s"'}, citations=[cited("s", locator="D.C. Code § 1-1 ")])]
    found, _ = candidates(spark, rows)
    assert {(p["reason"], p["match_key"]) for p in found.values()} == {("shared_url", "https://x.example/path"), ("shared_legal_locator", "D.C. Code § 1-1")}
    assert all(p["risks"] == ["kind_conflict", "same_source_duplicate"] and p["severity"] == "high" for p in found.values())


def test_candidates_by_other_keys(spark):
    """A jurisdiction's own blocks beside the usual ones."""
    rows = [entry("a", "board", "A", attributes={"phone": '"1"'}), entry("b", "board", "B", attributes={"phone": '"1"'}), entry("c", "board", "a", attributes={"phone": '"2"'})]
    own = {**ca.KEYERS, "shared_phone": lambda: F.array(F.try_element_at("attributes", F.lit("phone")))}
    found, listed = ca.find_candidates(spark.createDataFrame(rows, model.ENTRY), spark.createDataFrame([], model.RELATION), keyers=own)
    assert {(r["reason"], r["match_key"], r["n"]) for r in found.collect()} == {("shared_phone", '"1"', 2), (ca.NAME, "a", 2)}
    assert {r["entry_id"] for r in listed.where("packet_id LIKE 'shared_phone%'").collect()} == {"a", "b"}


def test_noise_among_shared_urls(spark):
    at = lambda **k: {a: json.dumps(v) for a, v in k.items()}
    url = "https://x.example/p"
    groups = {
        "laws": ([entry("l1", "legal_authority", "1", "authority", at(u_url=url)), entry("l2", "legal_authority", "2", "authority", at(u_url=url))], []),
        "authorised": ([entry("l1", "legal_authority", "1", "authority", at(u_url=url)), entry("b", "board", "B", attributes=at(u_url=url))], [{"from_id": "b", "kind": "relation:authorized_by", "to_id": "l1", "citations": []}]),
        "courts": ([entry("c", "court", "C", attributes=at(officialUrl=url)), entry("d", "court_division", "D", attributes=at(sourceDiscoveryPageUrl=url))], [{"from_id": "d", "kind": "relation:part_of", "to_id": "c", "citations": []}]),
        "ancs": ([entry("a", "anc", "A", attributes=at(webUrl=url, sourceAncId="1A")), entry("s", "smd", "S", "area", at(webUrl=url, sourceAncId="1A"))], []),
        "many": ([entry(f"b{i}", "board", f"B{i}", attributes=at(webUrl=url), citations=[cited("s")]) for i in range(3)], []),
        "areas": ([entry(f"w{i}", "ward", f"W{i}", "area", at(webUrl=url), citations=[cited("s")]) for i in range(2)], []),
    }
    for name, (rows, edges) in groups.items():
        assert not candidates(spark, rows, edges)[0], name
    assert candidates(spark, groups["authorised"][0])[0] and candidates(spark, groups["courts"][0])[0] and candidates(spark, groups["many"][0][:2])[0]
    other = [groups["ancs"][0][0], entry("s", "smd", "S", "area", at(webUrl=url, sourceAncId="1B"))]
    assert candidates(spark, other)[0]


def test_validation_codes(spark):
    rows = [entry(""), entry("a", ""), entry("b", name=""), entry("c", family=""), {**entry("d"), "attributes": None}, {**entry("e"), "citations": None}, entry("f", "strange"), entry("g", attributes={"n": "1", "extra": '"x"'})]
    got = {(r["id"], r["code"]) for r in entry_issues(spark.createDataFrame(rows, model.ENTRY), REGISTRY).collect()}
    assert got == {("", "entry.id_missing"), ("a", "entry.kind_missing"), ("a", "entry.kind_unknown"), ("b", "entry.name_missing"), ("c", "entry.family_missing"), ("c", "entry.family_mismatch"), ("d", "entry.attributes_missing"), ("e", "entry.citations_missing"), ("f", "entry.kind_unknown")}
    edges = spark.createDataFrame([{"from_id": "a", "kind": "", "to_id": "b", "citations": []}, {"from_id": "a", "kind": "x", "to_id": "", "citations": [cited(None)]}], model.RELATION)
    assert sorted(r["code"] for r in relation_issues(edges, REGISTRY).collect()) == ["entry.relation_citation_invalid", "entry.relation_kind", "entry.relation_kind_unknown", "entry.relation_to"]


def test_interpreters(spark):
    records = spark.createDataFrame([("s", "k", "1", '{"BOARDID": 7, "NAME": " B "}'), ("s", "k", "2", "[]"), ("s", "k", "3", None)], model.RECORD)
    good, bad = it.split_valid(records)
    assert [(r["source_id"], r["name"]) for r in it.keyed(good, ("BOARD_ID", "BOARDID"), ("NAME",)).collect()] == [("7", "B")]
    assert sorted(r["code"] for r in bad.collect()) == ["interpreter.invalid_payload", "interpreter.invalid_record"]
    agencies = spark.createDataFrame([("agency:x", "Dept of X", "DX", "1", 1), ("agency:y", "Department of X", "Y", "1", 2)], "id string, name string, short_name string, source_id string, seq int")
    rows = spark.createDataFrame([("b1", "1", None), ("b2", "9", None), ("b3", None, "dx"), ("b4", None, "ID-1"), ("b5", None, "no such")], "id string, ref string, label string")
    got = {r["id"]: r["resolved"] for r in it.resolve(rows, it.id_lookup(agencies), it.name_lookup(agencies), "ref", "label", "agency:").collect()}
    assert got == {"b1": "agency:y", "b2": "agency:9", "b3": "agency:x", "b4": "agency:ID-1", "b5": None}
    directory = spark.createDataFrame([("Department of X (new)", "u1", 1), ("Y", "u2", 2), ("Dept of X", "u3", 3), ("Z", "u4", 4)], "name string, url string, pos int")
    urls, problems = it.enrich_directory(directory, it.name_lookup(agencies))
    assert {(r["id"], r["url"]) for r in urls.collect()} == {("agency:x", "u1"), ("agency:y", "u2")} and {(r["name"], r["problem"]) for r in problems.collect()} == {("Z", "unmatched"), ("Dept of X", "conflicting_url")}
    up, lost = it.parents(spark.createDataFrame([("a", "A", "B"), ("b", "B", "B"), ("c", "C", "?")], "id string, name string, parent string"), "name", "parent")
    assert [tuple(r) for r in up.collect()] == [("a", "b")] and [r["id"] for r in lost.collect()] == ["c"]
    smds = spark.createDataFrame([("s", "1A01", "SMD 1A01", "Vacant", "1A"), ("s", "1A02", "SMD 1A02", "Ann", "1A")], "source string, source_id string, name string, holder string, anc_id string")
    seats = {r["provisional_id"]: r["attributes"] for r in it.area_and_seat(smds).collect()}
    assert len(seats) == 4 and "currentHolderName" not in seats["anc_commissioner_seat:1A01"] and seats["anc_commissioner_seat:1A02"]["currentHolderName"] == '"Ann"' and it.area_edges(smds).count() == 4
    committees = spark.createDataFrame([("w", "Committee of the Whole", "m1", ["m2"]), ("h", "Health", "m2", ["m3"])], "id string, name string, chair string, members array<string>")
    roster = spark.createDataFrame([(f"m{i}",) for i in range(1, 5)], "member_id string")
    assert {tuple(r) for r in it.committee_edges(committees, roster).collect()} == {("m1", "chairs", "w"), ("m2", "chairs", "h"), *((f"m{i}", "member_of", "w") for i in range(1, 5)), ("m2", "member_of", "h"), ("m3", "member_of", "h")}
    legal = spark.createDataFrame([("a", "D.C. Code § 1-1(a)"), ("a", "D.C. Code § 1-1"), ("b", "D.C. Code § 0-1"), ("b", "5 CFR 1")], "id string, locator string")
    made, links, rest = it.legal_artifacts(legal, authority(F.col("locator")), is_rejected(F.col("locator")))
    assert made.count() == 1 and links.count() == 2 and [r["locator"] for r in rest.collect()] == ["5 CFR 1"]


def test_carried_base_and_ranks(spark):
    got = spark.range(1).select(wi.carried_base(F.array(*map(F.lit, ["(z)", "2-1(a)", "(b)", "2-2"]))).alias("v")).first()["v"]
    assert got == ["(z)", "2-1(a)", "2-1(b)", "2-2"]


PAGE = """<html><h1>Body</h1><h3>Statute</h3> <p><b>D.C.</b> Code</p><strong>Statute:</strong> other</p><dl><dt>Phone</dt><dd>1</dd></dl>
<h2>Ward 1</h2><a href="/public-bodies/x">ANC 1A</a><h2>About</h2><a href="/y">ANC 1B</a><h2>Ward 2</h2><a href="/z">ANC 2A</a><a href="/public-bodies/meetings">meetings</a>
<h3>Commissioners</h3><table><tr><th>SMD</th><th>Name</th></tr><tr><td>1A01</td><td>Ann <em>Chair</em><em>Chair</em></td></tr></table>
<table><tr><td>Agency</td><td><a href="https://a.example">go</a></td></tr><tr><td>Agency</td><td><a href="https://a.example">go</a></td></tr></table></html>"""


def test_html(spark):
    pages = spark.createDataFrame([(1, "u", PAGE)], "id int, url string, html string")
    assert {(r["field"], r["value"]) for r in ht.fields(pages, "id", {"phone": "telephone"}).collect()} >= {("statute", "D.C. Code"), ("telephone", "1")}
    assert [(r["text"], r["value"]) for r in ht.headed_links(pages, "id", r"^Ward (\d+)$", "^ANC").orderBy("pos").collect()] == [("ANC 1A", "1"), ("ANC 1B", "1"), ("ANC 2A", "2")]
    assert [(r["seat"], r["name"], r["roles"]) for r in ht.officers(pages, "id", "Commissioners").where("seat = '1A01'").collect()] == [("1A01", "Ann", "Chair")]
    assert [r["url"] for r in ht.directory_rows(pages, "id").collect()] == ["https://a.example"]
    more = spark.createDataFrame([(2, "u", '<a href="https://h/public-bodies/x">again</a><a href="https://h/public-bodies/new">New</a>')], pages.schema)
    full = pages.withColumn("html", F.replace("html", F.lit('"/'), F.lit('"https://h/')))
    wanted = F.contains("href", F.lit("/public-bodies/")) & (F.col("text") != "meetings")
    assert {(r["slug"], r["from_supplement"]) for r in ht.crawl_index(full, more, "id", wanted).collect()} == {("x", False), ("new", True)}
    texts = spark.createDataFrame([("Office of Planning plans", "p1"), ("Office of Planning plans much", "p2"), ("Office of X", "p3")], "text string, url string")
    labels = ["Office", "office of planning"]
    assert [(r["label"], r["text"], r["n"]) for r in ht.evidence(texts, labels).where("label <> 'Office'").collect()] == [("office of planning", "Office of Planning plans much", 2)]
    assert {tuple(r) for r in ht.evidence_pages(texts, labels).collect()} == {("office of planning", "p1"), ("office of planning", "p2"), ("Office", "p3")}
    assert ht.page_facts(pages, "id").first()["heading"] == "Body"


def test_state_files_and_sinks(spark, tmp_path):
    entries = spark.createDataFrame([entry("b:1", attributes={"z": '"é"', "a": "[1,2]"}, citations=[cited("s")]), entry("a:1")], model.ENTRY)
    relations = spark.createDataFrame([{"from_id": "b:1", "kind": "governs", "to_id": "a:1", "citations": [cited("s")]}], model.RELATION)
    path = str(tmp_path / "state")
    for _ in range(2):  # the second replaces the first
        sinks.write_state(entries, relations, path)
    lines = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    assert [x["id"] for x in sorted(lines, key=lambda x: x["id"])] == ["a:1", "b:1"]
    files = tmp_path / "files"
    files.mkdir()
    (files / "skip.txt").write_text("no")
    for x in lines:
        (files / f"{x['id'].replace(':', '_')}.json").write_text(json.dumps(x, indent=1))
    back, edges = st.load_state(spark, str(files))
    assert {r["id"]: r["attributes"] for r in back.collect()} == {"b:1": {"z": '"é"', "a": "[1,2]"}, "a:1": {}} or {r["id"]: r["attributes"]["a"] for r in back.collect() if r["attributes"]} == {"b:1": "[1,2]"}
    assert [(r["from_id"], r["to_id"]) for r in edges.collect()] == [("b:1", "a:1")]
    assert st.load_findings(spark, str(tmp_path / "none")).count() == 0
    (files / "bad.json").write_text("{")
    with pytest.raises(Exception):  # noqa: B017
        st.load_state(spark, str(files))[0].collect()

    table = str(tmp_path / "t")
    first = spark.createDataFrame([("s", "1", "a"), ("s", "2", "b")], "source string, key string, payload string")
    sinks.upsert(first, table, ["source", "key"])
    sinks.upsert(spark.createDataFrame([("s", "2", "c"), ("t", "1", "d")], first.schema), table, ["source", "key"])
    assert {tuple(r) for r in sinks.read_table(spark, table).collect()} == {("s", "1", "a"), ("s", "2", "c"), ("t", "1", "d")}
    by_source = str(tmp_path / "by_source")
    sinks.replace_source(first, by_source, ["s"])
    sinks.replace_source(spark.createDataFrame([("t", "9", "x")], first.schema), by_source, ["t"])
    sinks.replace_source(spark.createDataFrame([("s", "3", "y")], first.schema), by_source, ["s"])
    assert {(r["source"], r["key"]) for r in spark.read.parquet(by_source).collect()} == {("s", "3"), ("t", "9")}
    sinks.replace_source(first.limit(0), by_source, ["s", "never"])
    assert {(r["source"], r["key"]) for r in spark.read.parquet(by_source).collect()} == {("t", "9")}
    with pytest.raises(ValueError):
        sinks.replace_source(first, by_source, ["t"])
    # null keys are keys, and of rows that share one in a batch one counts
    sinks.upsert(spark.createDataFrame([(None, "1", "e"), (None, "1", "f"), ("t", "1", "g"), ("t", "1", "h")], first.schema), table, ["source", "key"])
    sinks.upsert(spark.createDataFrame([(None, "1", "k")], first.schema), table, ["source", "key"])
    assert {tuple(r) for r in sinks.read_table(spark, table).collect()} == {("s", "1", "a"), ("s", "2", "c"), ("t", "1", "h"), (None, "1", "k")}
    # a job lost within a swap: the old table comes back
    (tmp_path / "t").rename(tmp_path / "t.old")
    sinks.recover(spark, table)
    assert spark.read.parquet(table).count() == 4 and not (tmp_path / "t.old").exists()
    for bad in ("", "/x", "../x", "a/../b", "a//b", "file:x", "a\\b"):
        with pytest.raises(ValueError):
            sinks.safe_path(bad)
    assert sinks.safe_path("a/b.csv") == "a/b.csv"

    csv = spark.createDataFrame([("b", 'say "x", y\nz'), ("a", None)], "k string, v string")
    sinks.write_csv(csv, str(tmp_path / "csv"), ["k"])
    assert {(r["k"], r["v"]) for r in sinks.blank_nulls(st.read_csv(spark, str(tmp_path / "csv"))).collect()} == {("a", ""), ("b", 'say "x", y\nz')}
    listed = sinks.manifest(spark, str(tmp_path / "csv"))
    assert sinks.verify_manifest(listed, listed).count() == 0
    changed = listed.withColumn("sha256", F.lit("0"))
    assert {r["problem"] for r in sinks.verify_manifest(listed, changed).collect()} == {"changed"}
    assert sinks.content_fingerprint(first).first() == sinks.content_fingerprint(first.repartition(3)).first() != sinks.content_fingerprint(first.limit(1)).first()


def test_records_of_known_snapshots(spark):
    records = spark.createDataFrame([("s", "k", "1", "{}"), ("s", "gone", "2", "{}"), ("t", "k", "3", "[1]")], model.RECORD)
    snapshots = spark.createDataFrame([("s", "k", "{}"), ("t", "k", "{}")], model.SNAPSHOT)
    assert {(r["key"], r["object"]) for r in st.load_records(records, snapshots).collect()} == {("1", True), ("3", False)}
    assert st.load_records(records, snapshots, "t").count() == 1


def test_release_and_tampering(spark):
    entries = spark.createDataFrame([entry("b:1"), entry("a:1", "agency")], model.ENTRY)
    relations = spark.createDataFrame([{"from_id": "b:1", "kind": "governs", "to_id": "a:1", "citations": []}, {"from_id": "a:1", "kind": "governs", "to_id": "b:1", "citations": []}], model.RELATION)
    verbs = {"governs": gr.Verb("administered_by", ("board",), ("agency",))}
    tables = release_tables(entries, relations, {"board": "body", "agency": "body"}, verbs, spark.createDataFrame([], "id string"))
    assert [(r["from_id"], r["verb"]) for r in tables["edges"].collect()] == [("b:1", "administered_by")]
    counts = sinks.catalogue(tables)
    keys, headers = {"entries": ["id"]}, {"entries": ["id", "slug", "family", "kind", "name"]}
    assert verify_release(tables, counts, keys, headers).where("NOT ok").count() == 0
    twice = tables | {"entries": tables["entries"].unionByName(tables["entries"])}
    assert {r["check"] for r in verify_release(twice, counts, keys, headers).where("NOT ok").collect()} == {"rows:entries", "content:entries", "unique:entries", "rollup:kind_counts"}
    lost = tables | {"nodes": tables["nodes"].where("id <> 'a:1'"), "entries": tables["entries"].drop("slug")}
    assert {r["check"] for r in verify_release(lost, counts, keys, headers).where("NOT ok").collect()} == {"rows:nodes", "content:nodes", "edges:ends", "header:entries", "content:entries", "rollup:graph_summary:nodes"}
    written = {k: materialise(df, k) for k, df in tables.items()}
    plan = verify_release(written, counts, keys, headers)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == len({"entries", "relations", "nodes", "edges", "graph_summary", "kind_counts", "relation_kind_counts", "attributes", "entry_citations", "relation_citations"})


def test_posture_coverage_and_files(spark, tmp_path):
    """Items against a posture, coverage against a catalog, and an export against its manifest, headers and counts."""
    empty = {"entries": spark.createDataFrame([entry("a:1")], model.ENTRY)}
    items = spark.createDataFrame([("blocking", "c1", "open", True), ("deferred", "c2", "open", False)], "queue string, category string, status string, blocking boolean")
    said = [("queue", "blocking", 1), ("queue", "deferred", 1), ("queue", "actionable", 0), ("category", "c1", 1), ("category", "c2", 1), ("status", "open", 2)]
    coverage = spark.createDataFrame([("s", 1, 1, 1, "collected", "exported"), ("t", 0, 0, 0, "collected", "not_collected")], "source string, snapshots long, records long, citations long, collection_status string, release_status string")
    check = lambda posture, catalog: {r["check"]: r["actual"] for r in verify_release(empty, sinks.catalogue(empty), {}, {}, coverage=coverage, catalog=spark.createDataFrame(catalog, "source string"), items=items, posture=spark.createDataFrame(posture, "section string, label string, n long")).where("NOT ok").collect()}
    assert check(said, [("s",), ("t",)]) == {"blockers": "1", "coverage:collection_status": "1"}
    assert check([*said[:-1], ("status", "open", 3), ("status", "drafted", 1)], [("s",), ("u",)]) == {"blockers": "1", "coverage:collection_status": "1", "posture": "2", "coverage:sources": "2"}

    table = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    sinks.write_export({"t": (table, ["k"])}, str(tmp_path / "out"))
    files = spark.createDataFrame(sinks.manifest(spark, str(tmp_path / "out")).collect())
    want = {"t.csv": (["k", "v"], 2)}
    assert verify_export(spark, str(tmp_path / "out"), files, want).where("NOT ok").count() == 0
    sinks.write_csv(table.limit(1).select("k", F.lit("x").alias("w")), str(tmp_path / "out" / "t.csv"), ["k"])
    bad = {r["check"].split(":")[0] for r in verify_export(spark, str(tmp_path / "out"), files, want | {"gone.csv": (["k"], 0)}).where("NOT ok").collect()}
    assert bad == {"file", "header", "rows"}


def test_paged_json(spark, tmp_path, monkeypatch):
    from recolith.sources import rest

    pages = {0: {"features": [{"attributes": {"ID": 1, "n": "é"}}, {"attributes": {"ID": 2}}], "exceededTransferLimit": True, "objectIdFieldName": "ID"}, 2: {"features": [{"attributes": {"ID": 3}}], "objectIdFieldName": "ID"}}
    (tmp_path / "fake_rest.py").write_text(f"import json\nPAGES = {pages!r}\ndef fetch(url, p):\n    if 'returnCountOnly' in p:\n        return json.dumps({{'count': 3}}) if url == 'u' else 'no count'\n    return json.dumps(PAGES.get(p['resultOffset'], {{'features': []}}))\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    reader = rest.PagedReader({"url": "u", "page_size": "2", "fetch": "fake_rest:fetch"})
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert [(p.first, p.pages) for p in reader.partitions()] == [(0, 1), (1, 0)]
    assert [(p.first, p.pages) for p in rest.PagedReader({"url": "other", "fetch": "fake_rest:fetch"}).partitions()] == [(0, 0)]
    assert [(r[0], r[1]) for r in rows] == [("page:0", "1"), ("page:0", "2"), ("page:2", "3")] and json.loads(rows[0][2])["n"] == "é"
    split = rest.PagedReader({"url": "u", "page_size": "2", "pages": "3", "fetch": "fake_rest:fetch"})
    assert sorted(r[1] for p in split.partitions() for r in split.read(p)) == ["1", "2", "3"]
    limited = rest.PagedReader({"url": "u", "page_size": "2", "limit": "1", "fetch": "fake_rest:fetch"})
    assert len(limited.partitions()) == 1 and next(limited.read(limited.partitions()[0]))[1] == "1"
    for text in ("no json", '{"error": {"message": "m"}}', "{}"):
        with pytest.raises(ValueError):
            rest.parse_page(text, "u")


def test_stream_of_collections(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("s", "k", "1", "{}")], model.RECORD).write.parquet(source)
    out = str(tmp_path / "out")
    for _ in range(2):
        query = collect_stream(spark.readStream.schema(model.RECORD).parquet(source), out, str(tmp_path / "cp"))
        query.awaitTermination()
        spark.createDataFrame([("s", "k", "2", "{}"), ("t", "k", "1", "{}")], model.RECORD).write.mode("append").parquet(source)
    # a source may be spread over micro-batches: by key, not by source, are rows replaced
    assert {(r["source"], r["key"]) for r in spark.read.parquet(out).collect()} == {("s", "1"), ("s", "2"), ("t", "1")}


def test_excluded_edges_are_judged_row_by_row(spark):
    relations = spark.createDataFrame([("a", "k", "b"), ("a", "k", "x"), ("a", "k", "x"), ("a", "k", None), ("x", "k", "a"), ("x", "k", "a"), ("y", "k", "a"), (None, "k", "a")], "from_id string, kind string, to_id string")
    nodes, blocked = spark.createDataFrame([("a",), ("b",), ("b",)], "id string"), spark.createDataFrame([("x",), ("x",)], "id string")
    out = gr.excluded_edges(relations, nodes, blocked)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("a", "k", "x"), ("a", "k", "x"), ("a", "k", None), ("x", "k", "a"), ("x", "k", "a")], key=str)
    # copies of rows are not gathered to be subtracted
    assert "ReplicateRows" not in out._jdf.queryExecution().optimizedPlan().toString() and "replicaterows" not in out._jdf.queryExecution().optimizedPlan().toString()
