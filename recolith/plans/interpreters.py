"""Interpreters: records of a source to entry fragments, relation fragments and findings.

Each is a plan over RECORD rows (source, snapshot_key, key, payload): payloads are parsed once, records without what they need become findings,
one record gives any number of fragments by one explode, and references to other records are joins against tables of distinct keys
(``operators.interpret``). Nothing is kept from one interpreter to the next but tables: the ``Lookups`` that agencies give.

Defined cases: payloads that are no objects, and records without an id or name, are findings and give no fragments; records that repeat give fragments that
the merge unites; an empty table gives none. Contact fields are never read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import citations as ci
from ..functions.text import BODY_RULES, clean_description, clean_statute, entity_slug, lookup_key, member_title, percent_id
from ..functions.values import attribute_map, cite, is_variant_object, quoted, variant_string
from ..model import CITATION
from ..operators import interpret as it
from ..stages import materialise, spread


@dataclass
class Interpreted:
    """ENTRY_FRAGMENT, RELATION_FRAGMENT and FINDING rows."""

    entries: DataFrame
    relations: DataFrame
    findings: DataFrame


@dataclass
class Lookups:
    """Agencies by source id (source_id, id) and by normalised name (key, id)."""

    by_id: DataFrame
    by_name: DataFrame


def together(*parts: Interpreted) -> Interpreted:
    """The sources' fragments in binding order, and all findings."""
    union = lambda frames: reduce(lambda a, b: a.unionByName(b), frames)
    placed = [p.entries.withColumn("ord", F.struct(F.lit(i).alias("binding"), F.col("ord.record").alias("record"), F.col("ord.emit").alias("emit"))) for i, p in enumerate(parts)]
    return Interpreted(union(placed), union([p.relations for p in parts]), union([p.findings for p in parts]))


# --- pieces


def parsed(records: DataFrame, **fields: tuple[str, ...] | str) -> tuple[DataFrame, DataFrame]:
    """Records with a column for each field, the first of the payload's keys that is there; and findings for the others. Payloads are parsed once, by
    all cores, and what was read is written: conditions on a field would otherwise parse them again, for every output."""
    rows = spread(records).withColumn("__v", F.try_parse_json("payload"))
    found = {name: variant_string(F.col("__v"), *((keys,) if isinstance(keys, str) else keys)) for name, keys in fields.items()}
    rows = materialise(rows.withColumns({"__object": is_variant_object(F.col("__v")), **found}).drop("__v"), "parsed")
    good = rows.where("__object").drop("__object")
    return good.withColumns({"__v": F.parse_json("payload"), "cited": cite(F.col("source"), F.col("key"))}), it.invalid(rows.where("NOT __object"))


def written(rows: DataFrame) -> DataFrame:
    """Rows that fragments, edges and findings read, without the parsed payload."""
    return materialise(rows.drop("__v"), "interpreted")


def finding(rows: DataFrame, kind: str, code: str, message: Column | None = None) -> DataFrame:
    return rows.select(F.lit(kind).alias("kind"), F.lit(f"interpreter.{code}").alias("code"), (F.concat_ws(":", "source", "key") if message is None else message).alias("message"), F.col("cited").alias("citation"))


def required(rows: DataFrame, **codes: str) -> tuple[DataFrame, list[DataFrame]]:
    """Rows that have every column named; one finding for the first that a row lacks."""
    lost, left = [], rows
    for name, code in codes.items():
        lost.append(finding(left.where(F.col(name).isNull()), "warn", code))
        left = left.where(F.col(name).isNotNull())
    return left, lost


def entry(emit: int, id_: Column, kind: str | Column, family: str, name: Column, attributes: Column, citations: Column, when: Column | None = None) -> Column:
    made = F.struct(F.lit(emit).alias("emit"), id_.alias("provisional_id"), (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), F.lit(family).alias("family"), name.alias("name"), attributes.alias("attributes"), citations.alias("citations"))
    return made if when is None else F.when(when, made)


def edge(emit: int, from_id: Column, kind: str, to_id: Column, citations: Column, when: Column | None = None) -> Column:
    made = F.struct(F.lit(emit).alias("emit"), from_id.alias("from_id"), F.lit(kind).alias("relation_kind"), to_id.alias("to_id"), citations.alias("citations"))
    return F.when(to_id.isNotNull() if when is None else when, made)


def _flat(rows: DataFrame, made: list[Column] | Column, columns: list[str]) -> DataFrame:
    every = F.array_compact(F.array(*made)) if isinstance(made, list) else made
    ord_ = F.struct(F.lit(0).alias("binding"), F.lit(0).cast("bigint").alias("record"), F.col("f.emit").alias("emit")).alias("ord")
    return rows.select("source", F.col("key").alias("source_record_id"), F.explode(every).alias("f")).select("source", "source_record_id", *[f"f.{c}" for c in columns], ord_)


def entries_of(rows: DataFrame, made: list[Column] | Column) -> DataFrame:
    return _flat(rows, made, ["provisional_id", "family", "kind", "name", "attributes", "citations"])


def edges_of(rows: DataFrame, made: list[Column] | Column) -> DataFrame:
    return _flat(rows, made, ["from_id", "relation_kind", "to_id", "citations"])


def text(name: str) -> Column:
    """A column as an attribute's JSON text; null leaves the attribute out."""
    return quoted(F.col(name))


def made_id(kind: str, key: Column) -> Column:
    return F.concat(F.lit(f"{kind}:"), key)


def cited_once() -> Column:
    return F.array("cited")


def with_law(rows: DataFrame, urls: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with authorities (distinct by type and address, those of texts before those of urls) and law_citations; a written table, as
    fragments, edges and findings read it."""
    from_urls = [ci.url_locators(F.col(u)) for u in urls]
    found = F.array_distinct(F.concat(ci.payload_locators(F.col("payload")), *from_urls))
    pairs = F.transform(found, lambda x: F.struct(x.alias("locator"), ci.authority(x).alias("a")))
    rows = rows.withColumn("__pairs", pairs).withColumn("__a", F.array_compact("__pairs.a"))
    same = lambda x, y: (x["authority_type"] == y["authority_type"]) & (x["canonical_url"] == y["canonical_url"])
    first = F.filter("__a", lambda x, i: ~F.exists(F.slice("__a", 1, i), lambda y: same(x, y)))
    said = F.filter("__pairs", lambda x: x["a"].isNotNull() | ~ci.is_section(x["locator"]))["locator"]
    rows = rows.withColumn("authorities", first).withColumn("law_citations", ci.record_citations(F.col("source"), F.col("key"), said))
    return materialise(rows.drop("__a", "__pairs", "__v"), "interpreted")


def law_entries(rows: DataFrame) -> DataFrame:
    made = F.transform("authorities", lambda a, i: F.struct((F.lit(100) + i).alias("emit"), a["id"].alias("provisional_id"), F.lit("legal_authority").alias("kind"), F.lit("authority").alias("family"), a["locator"].alias("name"), attribute_map(authorityType=quoted(a["authority_type"]), locator=quoted(a["locator"]), canonicalUrl=quoted(a["canonical_url"])).alias("attributes"), F.array(cite(F.col("source"), F.col("key"), a["locator"])).alias("citations")))
    return entries_of(rows, made)


def law_edges(rows: DataFrame, id_: str = "id") -> DataFrame:
    made = F.transform("authorities", lambda a, i: F.struct((F.lit(100) + i).alias("emit"), F.col(id_).alias("from_id"), F.lit("authorized_by").alias("relation_kind"), a["id"].alias("to_id"), F.array(cite(F.col("source"), F.col("key"), a["locator"])).alias("citations")))
    return edges_of(rows, made)


def union(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# --- sources


def agencies(records: DataFrame) -> tuple[Interpreted, Lookups]:
    """Agencies by the slug of their name; reports_to their parent by source id. Several source ids of one slug are a conflict."""
    rows, bad = parsed(records, source_id=("AGENCY_ID", "AGENCYID", "OBJECTID"), name=("AGENCY_NAME", "NAME"), short=("SHORT_NAME", "SHORTNAME"), parent=("PARENT_AGENCY", "PARENT_AGENCY_ID", "parent_agency_id"))
    rows, lost = required(rows, source_id="agency_id_missing", name="agency_name_missing")
    rows = with_law(rows.withColumn("id", made_id("agency", entity_slug(F.col("name")))))
    by_id = materialise(rows.groupBy("source_id").agg(F.max_by("id", "key").alias("id")), "agency-ids")
    shared = rows.groupBy("id").agg(F.count_distinct("source_id").alias("n"), F.min("source_id").alias("first"), F.max("source_id").alias("last"), F.min_by("cited", "source_id").alias("cited")).where("n > 1")
    collisions = shared.select(F.lit("conflict").alias("kind"), F.lit("identity.canonical_id_collision").alias("code"), F.concat_ws(" ", F.col("id"), F.lit("is shared by"), "n", F.lit("source ids, from"), "first", F.lit("to"), "last").alias("message"), F.col("cited").alias("citation"))
    up = rows.where("parent IS NOT NULL AND parent <> source_id").join(by_id.select(F.col("source_id").alias("parent"), F.col("id").alias("parent_entry")), "parent", "left")
    made = entry(0, F.col("id"), "agency", "organization", F.col("name"), attribute_map(shortName=F.coalesce(text("short"), text("name")), sourceAgencyId=text("source_id")), F.col("law_citations"))
    named = rows.select("id", "name", F.col("short").alias("short_name"), F.col("key").alias("seq"))
    return (
        Interpreted(
            union(entries_of(rows, [made]), law_entries(rows)),
            union(edges_of(up, [edge(1, F.col("id"), "reports_to", F.col("parent_entry"), cited_once())]), law_edges(rows)),
            union(bad, *lost, collisions, finding(up.where("parent_entry IS NULL"), "warn", "parent_agency_missing", F.concat_ws(" ", "key", F.lit("has parent"), "parent"))),
        ),
        Lookups(by_id, materialise(it.name_lookup(named), "agency-names")),
    )


def bodies(records: DataFrame, lookups: Lookups, kind: str) -> Interpreted:
    """Boards, commissions, councils or authorities: they govern the agency of their record, by its id or its name."""
    upper = kind.upper()
    rows, bad = parsed(records, source_id=(f"{upper}_ID", f"{upper}ID", "ENTITY_ID", "OBJECTID"), name=(f"{upper}_NAME", "NAME"), short=("SHORT_NAME", "SHORTNAME"), ref=("AGENCY_ID", "AGENCYID"), label=("GOVERNING_AGENCY", "AGENCY_NAME", "AGENCY"))
    rows, lost = required(rows, source_id=f"{kind}_id_missing", name=f"{kind}_name_missing")
    rows = with_law(it.resolve(rows.withColumn("id", made_id(kind, F.col("source_id"))), lookups.by_id, lookups.by_name, "ref", "label", "agency:"))
    made = entry(0, F.col("id"), kind, "organization", F.col("name"), attribute_map(**{"shortName": F.coalesce(text("short"), text("name")), f"source{kind.capitalize()}Id": text("source_id")}), F.col("law_citations"))
    return Interpreted(union(entries_of(rows, [made]), law_entries(rows)), union(edges_of(rows, [edge(1, F.col("id"), "governs", F.col("resolved"), cited_once())]), law_edges(rows)), union(bad, *lost))


def ancs(records: DataFrame) -> Interpreted:
    rows, bad = parsed(records, source_id="ANC_ID", name="NAME", web="WEB_URL", gis="GIS_ID")
    rows, lost = required(rows, source_id="anc_id_missing")
    rows = it.with_fallback_name(rows, "ANC ")
    made = entry(0, made_id("anc", percent_id(F.col("source_id"))), "anc", "organization", F.col("name"), attribute_map(sourceAncId=text("source_id"), webUrl=text("web"), gisId=text("gis")), cited_once())
    return Interpreted(entries_of(rows, [made]), edges_of(rows.limit(0), [edge(0, F.col("source_id"), "contains", F.col("source_id"), cited_once())]), union(bad, *lost, finding(rows.where("NOT named"), "warn", "anc_name_missing")))


def smds(records: DataFrame) -> Interpreted:
    """An area and its seat a record; the commission contains the area, the seat represents it. A vacant seat has no holder."""
    rows, bad = parsed(records, source_id="SMD_ID", name="NAME", anc="ANC_ID", holder=("REP_NAME", "REPRESENTATIVE"), first="FIRST_NAME", last="LAST_NAME", web="WEB_URL")
    rows, lost = required(rows, source_id="smd_id_missing")
    rows = it.with_fallback_name(rows, "SMD ").withColumn("vacant", F.upper("holder") == "VACANT")
    rows = written(rows.withColumns({"area": made_id("smd", percent_id(F.col("source_id"))), "seat": made_id("anc_commissioner_seat", percent_id(F.col("source_id"))), "top": made_id("anc", percent_id(F.col("anc")))}))
    area, seat = F.col("area"), F.col("seat")
    held = lambda c: F.when(~F.col("vacant"), text(c))
    made = [
        entry(0, area, "smd", "area", F.col("name"), attribute_map(sourceSmdId=text("source_id"), sourceAncId=text("anc"), webUrl=text("web")), cited_once()),
        entry(1, seat, "anc_commissioner_seat", "position", F.concat(F.lit("Commissioner Seat for "), F.col("name")), attribute_map(sourceSmdId=text("source_id"), sourceAncId=text("anc"), sourceRepresentativeName=held("holder"), sourceFirstName=held("first"), sourceLastName=held("last")), cited_once()),
    ]
    edges = [edge(2, F.col("top"), "contains", area, cited_once(), F.col("anc").isNotNull()), edge(3, seat, "represents", area, cited_once())]
    problems = [finding(rows.where("NOT named"), "warn", "smd_name_missing"), finding(rows.where("vacant"), "warn", "smd_representative_vacant"), finding(rows.where("holder IS NULL"), "warn", "smd_representative_missing"), finding(rows.where("anc IS NULL"), "warn", "smd_anc_id_missing")]
    return Interpreted(entries_of(rows, made), edges_of(rows, edges), union(bad, *lost, *problems))


def members(records: DataFrame) -> Interpreted:
    """Members by the slug of their profile, the office that their title names, and its ward: the member holds the office, both represent the ward."""
    rows, bad = parsed(records, title="memberName", slug="profileSlug", profile="profileUrl")
    rows, lost = required(rows, title="councilmember_missing_fields", slug="councilmember_missing_fields", profile="councilmember_missing_fields")
    clean = F.trim(F.regexp_replace("title", r"\s+", " "))
    # a title counts where a name follows it
    name = F.regexp_extract(clean, r"(?i)^(?:ward \d+ |at-large )?(?:councilmember|chairman) (.+)$", 1)
    title = member_title(F.when(name != "", F.substr(clean, F.lit(1), F.length(clean) - F.length(name))))
    held = lambda office: F.when(title["office"] == office, F.lit(office))
    rows = rows.withColumns({"ward": title["ward_number"], "at_large": held("at_large"), "chairman": held("chair"), "plain": F.when(title["office"].isNotNull(), name).otherwise(clean)})
    choose = lambda ward, at_large, chairman: F.when(F.col("ward").isNotNull(), ward).when(F.col("at_large").isNotNull(), at_large).when(F.col("chairman").isNotNull(), chairman)
    label = choose(F.concat(F.lit("Ward "), F.col("ward"), F.lit(" Councilmember")), F.lit("At-Large Councilmember"), F.lit("Chairman"))
    office = made_id("elected_office", choose(F.concat(F.lit("ward-"), F.col("ward"), F.lit("-councilmember")), F.lit("at-large-councilmember"), F.lit("council-chairman")))
    kind = choose(F.lit("ward_councilmember"), F.lit("at_large_councilmember"), F.lit("council_chairman"))
    rows = rows.withColumns({"label": label, "office": office, "office_type": kind, "id": made_id("councilmember", percent_id(F.col("slug"))), "ward_id": made_id("ward", F.col("ward"))})
    rows = written(rows)
    has_office, has_ward = F.col("office").isNotNull(), F.col("ward").isNotNull()
    made = [
        entry(0, F.col("id"), "councilmember", "person", F.col("plain"), attribute_map(sourceProfileSlug=text("slug"), sourceProfileUrl=text("profile"), officeLabel=text("label"), wardNumber=text("ward")), cited_once()),
        entry(1, F.col("office"), "elected_office", "position", F.col("label"), attribute_map(officeType=text("office_type"), sourceLabel=text("label"), wardNumber=text("ward")), cited_once(), has_office),
        entry(2, F.col("ward_id"), "ward", "area", F.concat(F.lit("Ward "), F.col("ward")), attribute_map(wardNumber=text("ward")), cited_once(), has_ward),
    ]
    edges = [edge(3, F.col("id"), "holds", F.col("office"), cited_once()), edge(4, F.col("id"), "represents", F.col("ward_id"), cited_once()), edge(5, F.col("office"), "represents", F.col("ward_id"), cited_once(), has_office & has_ward)]
    return Interpreted(entries_of(rows, made), edges_of(rows, edges), union(bad, *lost))


def committees(records: DataFrame, roster: DataFrame) -> Interpreted:
    """Committees with their members, who are known by the last part of their profile's address: a chair is a member too, and the committee of the whole has
    everyone of ``roster`` (member_id). Members that the roster lacks become entries of their own."""
    rows, bad = parsed(records, name="committeeName", slug="committeeSlug", type="committeeType", url="committeeUrl", chair_name="chairpersonName", chair_url="chairpersonUrl")
    missing = "council_committee_missing_fields"
    rows, lost = required(rows, name=missing, slug=missing, url=missing)
    member = lambda url: made_id("councilmember", percent_id(F.substring_index(F.regexp_replace(url, "[?#].*$|/+$", ""), "/", -1)))
    listed = F.coalesce(F.try_variant_get("__v", "$.councilmembers", "array<struct<name:string,url:string>>"), F.array().cast("array<struct<name:string,url:string>>"))
    people = F.filter(listed, lambda p: p["name"].isNotNull() & p["url"].isNotNull())
    rows = written(rows.withColumns({"id": made_id("committee", percent_id(F.col("slug"))), "people": people, "chair": F.when(F.col("chair_url").isNotNull(), member(F.col("chair_url")))}).withColumn("members", F.transform("people", lambda p: member(p["url"]))))
    cited = F.array(cite(F.col("source"), F.col("key"), url=F.col("url")))
    made = entry(0, F.col("id"), "committee", "organization", F.col("name"), attribute_map(committeeType=text("type"), sourceUrl=text("url"), sourceCommitteeSlug=text("slug")), cited)
    named = F.transform("people", lambda p: F.struct(member(p["url"]).alias("id"), p["name"].alias("name"), p["url"].alias("url")))
    chair = F.when(F.col("chair").isNotNull() & F.col("chair_name").isNotNull(), F.array(F.struct(F.col("chair").alias("id"), F.col("chair_name").alias("name"), F.col("chair_url").alias("url")))).otherwise(F.array().cast("array<struct<id:string,name:string,url:string>>"))
    own = rows.select("*", F.explode(F.array_distinct(F.concat(named, chair))).alias("p")).join(roster.select(F.col("member_id").alias("__known")), F.col("p.id") == F.col("__known"), "left_anti")
    person = entry(1, F.col("p.id"), "councilmember", "person", F.col("p.name"), attribute_map(sourceProfileUrl=quoted(F.col("p.url"))), cited)
    # edges know their committee, whose record they cite
    edges = it.committee_edges(rows.select("id", "name", "chair", "members"), roster).withColumnRenamed("to_id", "id").join(rows.select("id", "source", "key", "url"), "id")
    links = [edge(2, F.col("from_id"), kind, F.col("id"), cited, F.col("kind") == kind) for kind in ("member_of", "chairs")]
    return Interpreted(union(entries_of(rows, [made]), entries_of(own, [person])), edges_of(edges, links), union(bad, *lost, finding(rows.where("chair IS NULL"), "warn", "council_committee_chair_missing")))


def structure(records: DataFrame, kinds: dict[str, str], prefix: str, id_of: Callable[[Column, Column], Column] | None = None) -> Interpreted:
    """Pages of a hierarchy (ethics board, courts): entries of the payload's kind, ``part_of`` the page of the parent's exact name."""
    rows, bad = parsed(records, name="name", ref="key", url="url", source_kind="entryKind", parent="parentName", discovery="discoveryPageUrl", page_title="pageTitle", heading="heading", summary="summary")
    of = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
    rows = rows.withColumn("kind", of[F.col("source_kind")])
    missing = f"{prefix}_missing_fields"
    rows, lost = required(rows, name=missing, ref=missing, url=missing, kind=missing)
    make = id_of or (lambda kind, name: F.concat(kind, F.lit(":"), entity_slug(name)))
    rows = written(rows.withColumn("id", make(F.col("kind"), F.col("name"))))
    cited = F.array(cite(F.col("source"), F.col("key"), url=F.col("url")))
    # of pages of one name the last is the parent
    by_name = rows.groupBy(F.col("name").alias("parent")).agg(F.max_by("id", "key").alias("parent_entry"))
    up = rows.where("parent IS NOT NULL").join(by_name, "parent", "left")
    made = entry(0, F.col("id"), F.col("kind"), "organization", F.col("name"), attribute_map(shortName=text("name"), sourceStructureKey=text("ref"), sourcePageUrl=text("url"), officialUrl=text("url"), sourceDiscoveryPageUrl=text("discovery"), sourcePageTitle=text("page_title"), sourceHeading=text("heading"), sourceSummary=text("summary")), cited)
    return Interpreted(entries_of(rows, [made]), edges_of(up, [edge(1, F.col("id"), "part_of", F.col("parent_entry"), cited)]), union(bad, *lost, finding(up.where("parent_entry IS NULL"), "warn", f"{prefix}_parent_missing", F.concat_ws(" ", "key", F.lit("has parent"), "parent"))))


def executive(records: DataFrame, lookups: Lookups) -> Interpreted:
    """Offices, and references to agencies that other sources describe: both have a relation to the office of the parent's key; a reference gives no entry of its own."""
    rows, bad = parsed(records, ref="key", name="name", url="sourceUrl", source_kind="entryKind", parent="parentKey", relation="relationKind", description="description", official="officialUrl")
    missing = "executive_structure_missing_fields"
    rows = rows.withColumn("source_kind", F.when(F.col("source_kind").isin("office", "agency_ref"), F.col("source_kind")))
    rows, lost = required(rows, ref=missing, name=missing, url=missing, source_kind=missing)
    agency = lookups.by_name.select(F.col("key").alias("__key"), F.col("id").alias("agency"))
    rows = rows.withColumn("__key", lookup_key(F.col("name"))).join(agency, "__key", "left").withColumn("id", F.when(F.col("source_kind") == "office", made_id("office", F.col("ref"))).otherwise(F.col("agency")))
    rows = written(rows)
    offices = rows.where("source_kind = 'office'").groupBy(F.col("ref").alias("parent")).agg(F.max_by("id", "key").alias("parent_entry"))
    up = rows.where("parent IS NOT NULL AND id IS NOT NULL").join(offices, "parent", "left")
    cited = F.array(cite(F.col("source"), F.col("key"), url=F.col("url")))
    made = entry(0, F.col("id"), "office", "organization", F.col("name"), attribute_map(sourceOfficeKey=text("ref"), sourcePageUrl=text("url"), officialUrl=text("official"), description=quoted(clean_description(F.col("description")))), cited, F.col("source_kind") == "office")
    known = F.col("relation").isin("part_of", "reports_to")
    links = [edge(1, F.col("id"), kind, F.col("parent_entry"), cited, F.col("parent_entry").isNotNull() & (F.col("relation") == kind)) for kind in ("part_of", "reports_to")]
    problems = [
        finding(rows.where("id IS NULL"), "warn", "executive_agency_unresolved", F.concat_ws(" ", "key", F.lit("names agency"), "name")),
        finding(up.where("parent_entry IS NULL"), "warn", "executive_parent_missing", F.concat_ws(" ", "key", F.lit("has parent"), "parent")),
        finding(up.where(~F.coalesce(known, F.lit(False))), "warn", "executive_relation_missing"),
    ]
    return Interpreted(entries_of(rows, [made]), edges_of(up, links), union(bad, *lost, *problems))


def profiles(records: DataFrame) -> Interpreted:
    """Commissions with their wards and the seats of their commissioners; ids with a slash leave seats to review."""
    rows, bad = parsed(records, anc="ancId", name="name", profile="profileUrl", official="officialUrl", places="representedNeighborhoods")
    missing = "profile_missing_fields"
    rows, lost = required(rows, anc=missing, name=missing, profile=missing)
    many = lambda path, kind: F.coalesce(F.try_variant_get("__v", path, kind), F.array().cast(kind))
    rows = rows.withColumn("wards", F.array_sort(F.array_distinct(many("$.wardNumbers", "array<string>")))).withColumn("people", F.filter(many("$.commissioners", "array<struct<smdId:string,name:string,officerRole:string>>"), lambda p: p["smdId"].isNotNull() & p["name"].isNotNull()))
    cited, plain = F.array(cite(F.col("source"), F.col("key"), url=F.col("profile"))), cited_once()
    anc_id = made_id("anc", percent_id(F.col("anc")))
    slashed = lambda p: F.contains("anc", F.lit("/")) | F.contains(p["smdId"], F.lit("/"))
    own = F.array(entry(0, anc_id, "anc", "organization", F.col("name"), attribute_map(sourceAncId=text("anc"), sourceOancProfileUrl=text("profile"), officialUrl=text("official"), representedNeighborhoods=text("places"), sourceWardNumbers=F.when(F.size("wards") > 0, F.to_json("wards"))), cited))
    seats = F.transform(F.filter("people", lambda p: ~slashed(p)), lambda p: entry(1, made_id("anc_commissioner_seat", p["smdId"]), "anc_commissioner_seat", "position", F.concat(F.lit("Commissioner Seat for SMD "), p["smdId"]), attribute_map(sourceAncId=text("anc"), sourceSmdId=quoted(p["smdId"]), currentHolderName=quoted(p["name"]), officerRole=quoted(p["officerRole"]), sourceOancProfileUrl=text("profile")), cited))
    wards = F.transform("wards", lambda w: entry(2, made_id("ward", w), "ward", "area", F.concat(F.lit("Ward "), w), attribute_map(wardNumber=quoted(w)), plain))
    contains = F.transform("wards", lambda w: F.struct(F.lit(3).alias("emit"), made_id("ward", w).alias("from_id"), F.lit("contains").alias("relation_kind"), anc_id.alias("to_id"), plain.alias("citations")))
    deferred = rows.select("*", F.explode(F.filter("people", slashed)).alias("p"))
    return Interpreted(entries_of(rows, F.concat(own, seats, wards)), edges_of(rows, contains), union(bad, *lost, finding(deferred, "info", "commissioner_slash_smd_deferred", F.concat_ws(" ", "key", F.lit("has seat"), "p.smdId"))))


def public_bodies(records: DataFrame, trusted: DataFrame, lookups: Lookups, rules: list[tuple[str, str]] = BODY_RULES, corrections: dict[str, str] | None = None, excluded: tuple[str, ...] = ()) -> Interpreted:
    """Bodies of a directory: kinds by their names, ids of trusted entries (kind, name, id, seq) where kind and name agree, and edges to the agencies that
    govern (``governs``) and administer (``affiliated_with``) them. Duplicates of one name without substance give no entry."""
    rows, bad = parsed(records, name="name", slug="slug", detail="detailUrl", about="description", official="officialUrl", statute="enablingStatute", statute_url="enablingStatuteUrl", governing="governingAgency", acronym="governingAgencyAcronym", administering="administeringAgency")
    missing = "public_body_missing_fields"
    rows, lost = required(rows, name=missing, slug=missing, detail=missing)
    rows = rows.withColumns({"about": clean_description(F.col("about")), "statute": clean_statute(F.col("statute"))}).withColumn("substantive", F.coalesce("about", "official", "statute", "statute_url", "governing", "administering").isNotNull())
    typed = written(it.public_bodies(rows.drop("__v"), trusted, rules, corrections, excluded))
    stale, kept = typed.where("stale"), typed.where("NOT stale")
    for label in ("governing", "administering"):
        keys = F.array_compact(F.array(lookup_key(F.col(label)), lookup_key(F.col("acronym")))) if label == "governing" else F.array_compact(F.array(lookup_key(F.col(label))))
        tries = kept.select("key", F.posexplode(keys).alias("try", "__key")).join(lookups.by_name.select(F.col("key").alias("__key"), F.col("id").alias("__to")), "__key").groupBy("key").agg(F.min_by("__to", "try").alias(f"to_{label}"))
        kept = kept.join(tries, "key", "left")
    kept = with_law(kept, ("statute_url",))
    kind = F.when(F.col("kind").isin("committee", "commission", "board", "authority", "council", "office"), F.col("kind")).otherwise("agency")
    made = entry(0, F.col("id"), kind, "organization", F.col("name"), attribute_map(sourceOpenDcSlug=text("slug"), sourceOpenDcUrl=text("detail"), description=text("about"), officialUrl=text("official"), enablingStatute=text("statute"), enablingStatuteUrl=text("statute_url")), F.col("law_citations"))
    other = lambda c: F.col(c).isNotNull() & (F.col(c) != F.col("id"))
    links = [edge(1, F.col("id"), "governs", F.col("to_governing"), cited_once(), other("to_governing")), edge(2, F.col("id"), "affiliated_with", F.col("to_administering"), cited_once(), other("to_administering"))]
    problems = [
        finding(typed.where("kind = 'public_body'"), "warn", "public_body_unclassified", F.col("name")),
        finding(typed.where("shadow"), "info", "public_body_source_shadow_merged", F.concat_ws(" ", "name", F.lit("is"), "id")),
        finding(stale, "info", "stale_or_failed_duplicate", F.col("name")),
        finding(kept.where("governing IS NOT NULL AND to_governing IS NULL"), "warn", "governing_agency_unresolved", F.concat_ws(" ", "name", F.lit("names"), "governing")),
        finding(kept.where("to_governing = id"), "warn", "governing_agency_self_reference", F.col("name")),
    ]
    return Interpreted(union(entries_of(kept, [made]), law_entries(kept)), union(edges_of(kept, links), law_edges(kept)), union(bad, *lost, *problems))


def entrypoints(records: DataFrame) -> Interpreted:
    """Legal sites, one entry a record; whether they come from the seed is an attribute."""
    rows, bad = parsed(records, name="name", url="url", page_title="pageTitle", heading="heading", summary="summary")
    rows, lost = required(rows, name="legal_entrypoint_missing_fields", url="legal_entrypoint_missing_fields")
    seeded = F.coalesce(F.try_variant_get("__v", "$.fromSeed", "boolean"), F.lit(False)).cast("string")
    made = entry(0, made_id("legal_entrypoint", entity_slug(F.col("name"))), "legal_entrypoint", "authority", F.col("name"), attribute_map(officialUrl=text("url"), sourcePageTitle=text("page_title"), sourceHeading=text("heading"), sourceSummary=text("summary"), sourceSeeded=seeded), F.array(cite(F.col("source"), F.col("key"), url=F.col("url"))))
    none = edges_of(rows.limit(0), [edge(0, F.col("name"), "contains", F.col("name"), cited_once())])
    return Interpreted(entries_of(rows, [made]), none, union(bad, *lost))


def directory(records: DataFrame, lookups: Lookups) -> Interpreted:
    """A directory's addresses as further fragments of agencies that are known by one of the names that a row may go by."""
    rows, bad = parsed(records, name=("directoryName", "name"), url=("officialUrl", "url"))
    rows, lost = required(rows, name="agency_directory_missing_fields", url="agency_directory_missing_fields")
    placed = rows.select("name", "url", F.col("key").alias("pos"))
    found, problems = it.enrich_directory(placed, lookups.by_name)
    by_url = rows.groupBy("url").agg(F.min_by(F.struct("source", "key", "name", "cited"), "key").alias("r"))
    made = found.join(by_url, "url").select("id", "url", "r.*")
    out = entry(0, F.col("id"), "agency", "organization", F.col("name"), attribute_map(officialUrl=text("url")), F.array(cite(F.col("source"), F.col("key"), url=F.col("url"))))
    said = problems.select(F.lit("warn").alias("kind"), F.concat(F.lit("interpreter.agency_directory_"), F.col("problem")).alias("code"), F.concat_ws(" ", "name", "url").alias("message"), F.lit(None).cast(CITATION).alias("citation"))
    return Interpreted(entries_of(made, [out]), edges_of(made.limit(0), [edge(0, F.col("id"), "contains", F.col("id"), cited_once())]), union(bad, *lost, said))
