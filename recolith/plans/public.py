"""Public tables of a state: one plan a table, from entries and relations that carry their names and sources.

Two written tables carry the work: entries with their primary citation's source, and relations with both ends' names and kinds; each of the fourteen
is a projection or a grouping of these. Lists in a cell (members of a committee, users of an authority) are what readers of the release
ask for: they are built here, at the end, from counted groups, and ``usage`` has the same as a table of rows.

Defined cases: missing texts are empty; relations whose target is no entry have an empty name and type; entries that repeat an id are
not expected (the compile has merged them); an empty state gives empty tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import raw_verb, strip_label
from ..functions.values import attribute_text
from ..operators import graph
from ..stages import materialise

#: Kinds of public bodies.
BODY_KINDS = ("board", "commission", "council", "authority")
# Attributes that say where an entry comes from, if its citations don't.
SOURCE_URLS = ("sourceProfileUrl", "sourceUrl", "sourcePageUrl", "sourceOpenDcUrl", "sourceOancProfileUrl", "webUrl", "officialUrl", "canonicalUrl")
# Columns of the sources table, as coverage has them.
SOURCES = ("source", "publisher", "source_url", "family", "access_method", "collection_status", "release_status", "records", "citations", "scope", "contributes", "excludes", "notes")


@dataclass(frozen=True)
class Names:
    """How the registry writes kinds and relation kinds, and which sources an entry of a kind is cited by first."""

    kind_prefix: str = ""
    relation_prefix: str = ""
    preferred: tuple[tuple[str, tuple[str, ...]], ...] = ()

    def leading(self) -> tuple[str, ...]:
        """Sources whose citations the tables look for; the public tables need no more of an entry's citations than ``fragments.leading_citations`` of these."""
        return tuple(dict.fromkeys(s for _, sources in self.preferred for s in sources))

    def kind(self, name: str) -> str:
        return self.kind_prefix + name

    def relation(self, name: str) -> str:
        return self.relation_prefix + name


def attribute(name: str) -> Column:
    return F.coalesce(attribute_text(F.try_element_at("attributes", F.lit(name))), F.lit(""))


def first_filled(*columns: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def first_source(citations: Column) -> Column:
    """The first citation that names a source or an address."""
    return F.get(F.filter(citations, lambda c: c["source"].isNotNull() | c["url"].isNotNull()), 0)


def cited_from(source: str) -> Column:
    """The entry's first citation of the source."""
    return F.get(F.filter("citations", lambda c: c["source"] == source), 0)


def source_id(citation: Column) -> Column:
    return F.coalesce(F.when(citation["source"].isNotNull(), F.concat_ws(":", citation["source"], F.nullif(citation["source_record_id"], F.lit("")))), F.lit(""))


def with_source(rows: DataFrame, citation: Column, coverage: DataFrame, *fallback: Column) -> DataFrame:
    """``rows`` with source_url (the citation's, its source's or a fallback) and source_id. Coverage has a row a source."""
    urls = coverage.select(F.col("source").alias("__source"), F.col("source_url").alias("__url"))
    cited = rows.withColumn("__c", citation).withColumn("source_id", source_id(F.col("__c")))
    joined = cited.join(urls, F.col("__c.source") == F.col("__source"), "left")
    return joined.withColumn("source_url", first_filled(F.col("__c.url"), F.col("__url"), *fallback)).drop("__c", "__source", "__url")


class Tables(Mapping[str, DataFrame]):
    """Tables by name, each planned when it is first asked for, with no more of what several share than it needs."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]) -> None:
        self.makers = {k: cache(f) for k, f in makers.items()}

    def __getitem__(self, name: str) -> DataFrame:
        return self.makers[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self.makers)

    def __len__(self) -> int:
        return len(self.makers)


def bases(entries: DataFrame, relations: DataFrame, coverage: DataFrame, verbs: dict[str, graph.Verb], names: Names) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """Entries with what the tables say of them, and what makes the relations with it; both are written."""
    primary = first_source(F.col("citations"))
    for kind, sources in reversed(names.preferred):
        own = [cited_from(s) for s in sources]
        primary = F.when(F.col("kind") == names.kind(kind), F.coalesce(*own, first_source(F.col("citations")))).otherwise(primary)
    rows = with_source(entries, primary, coverage, *[attribute(a) for a in SOURCE_URLS])
    rows = materialise(rows.select("id", "kind", "name", "attributes", "source_url", "source_id"), "public-entries")
    end = lambda side: rows.select(F.col("id").alias(f"{side}_id"), F.col("name").alias(f"{side}_name"), F.col("kind").alias(f"{side}_kind"))

    def relations_named() -> DataFrame:
        links = relations.join(end("from"), "from_id").join(end("to"), "to_id", "left")
        label = F.coalesce(graph.public_verb(verbs, F.col("kind"), F.col("from_kind"), F.col("to_kind")), raw_verb(F.col("kind")))
        links = with_source(links.withColumn("label", label), first_source(F.col("citations")), coverage).na.fill("", ["to_name", "to_kind"])
        return materialise(links.select("from_id", "from_name", "from_kind", "kind", "label", "to_id", "to_name", "to_kind", "source_url", "source_id"), "public-relations")

    return rows, relations_named


def seat(office: Column, ward: Column) -> Column:
    """chairman, at_large, ward or unknown."""
    return F.when(F.contains(F.lower(office), F.lit("chairman")), "chairman").when(F.contains(F.lower(office), F.lit("at-large")), "at_large").when(ward != "", "ward").otherwise("unknown")


def sort_order(seat_type: Column, ward: Column, name: Column) -> Column:
    """The chairman, then members at large by name, then wards by number, then others."""
    return F.when(seat_type == "chairman", "00").when(seat_type == "ward", F.concat(F.lit("2"), F.lpad(ward, F.greatest(F.length(ward), F.lit(2)), F.lit("0")))).when(seat_type == "at_large", F.concat(F.lit("1"), name)).otherwise(F.concat(F.lit("99"), name))


def usage(links: DataFrame, names: Names) -> DataFrame:
    """authority_id, entry_id, name: what each authority authorises, a row each."""
    return links.where(F.col("kind") == names.relation("authorized_by")).select(F.col("to_id").alias("authority_id"), F.col("from_id").alias("entry_id"), F.col("from_name").alias("name"))


def structure(rows: DataFrame, links: DataFrame, names: Names) -> DataFrame:
    """Commissions, their areas and the areas' seats: a row an area of a commission."""
    chain = graph.chain(rows, links, (names.relation("contains"), names.kind("smd")), (names.relation("represents"), names.kind("anc_commissioner_seat")), names.kind("anc"))
    contains = links.where(F.col("kind") == names.relation("contains")).select(F.col("from_id").alias("anc_id"), F.col("to_id").alias("smd_id"), F.col("from_name").alias("anc_name"), F.col("to_name").alias("smd_name"), "source_url", "source_id")
    seats = rows.where(F.col("kind") == names.kind("anc_commissioner_seat")).select(F.col("id").alias("commissioner_seat_id"), first_filled(attribute("currentHolderName"), attribute("sourceRepresentativeName")).alias("current_commissioner_name"), attribute("officerRole").alias("officer_role"))
    wards = rows.where(F.col("kind") == names.kind("anc")).select(F.col("id").alias("anc_id"), attribute("sourceWardNumbers").alias("wards"))
    found = chain.withColumnsRenamed({"top_id": "anc_id", "middle_id": "smd_id", "seat_id": "commissioner_seat_id"}).join(contains, ["anc_id", "smd_id"]).join(seats, "commissioner_seat_id", "left").join(wards, "anc_id", "left")
    return found.withColumns({"anc": F.trim(strip_label(F.col("anc_name"), "ANC")), "smd": F.trim(strip_label(F.col("smd_name"), "SMD"))}).na.fill("", ["commissioner_seat_id", "current_commissioner_name", "officer_role", "wards"])


def public_tables(entries: DataFrame, relations: DataFrame, coverage: DataFrame, verbs: dict[str, graph.Verb] | None = None, names: Names | None = None) -> Tables:
    """The fourteen tables by name, planned when asked for. ``coverage``: a row a source, with ``SOURCES`` or some of them."""
    names = names or Names()
    # entries and relations have few sources each, so a shuffled join would make them one task's
    cited = F.broadcast(coverage) if coverage.count() <= graph.MOST else coverage
    rows, made = bases(entries, relations, cited, verbs or {}, names)
    links = cache(made)
    of = lambda *kinds: rows.where(F.col("kind").isin(*[names.kind(k) for k in kinds]))
    by = lambda *kinds: links().where(F.col("kind").isin(*[names.relation(k) for k in kinds]))
    bare = lambda c: F.regexp_replace(c, "^" + names.kind_prefix.replace(".", r"\."), "") if names.kind_prefix else c

    def parents(*kinds: str) -> DataFrame:
        rank = F.array_position(F.array(*[F.lit(names.relation(k)) for k in kinds]), F.col("kind"))
        return by(*kinds).groupBy(F.col("from_id").alias("id")).agg(F.min_by(F.struct(F.col("to_id").alias("id"), F.col("to_name").alias("name")), F.struct(rank.alias("r"), F.col("to_id"))).alias("p")).select("id", F.col("p.id").alias("parent_id"), F.col("p.name").alias("parent_name"))

    def organisations(kind: str, key: str) -> DataFrame:
        up = of(kind).join(parents("reports_to", "part_of"), "id", "left").na.fill("", ["parent_id", "parent_name"])
        return up.select(F.col("id").alias(key), "name", attribute("shortName").alias("short_name"), attribute("officialUrl").alias("official_url"), "parent_id", "parent_name", "source_url", "source_id")

    @cache
    def people() -> DataFrame:
        seat_type = seat(attribute("officeLabel"), attribute("wardNumber"))
        found = of("councilmember").select("id", "name", seat_type.alias("seat_type"), attribute("officeLabel").alias("office_title"), attribute("wardNumber").alias("ward"), attribute("sourceProfileUrl").alias("profile_url"), "source_url", "source_id")
        return found.withColumn("sort_order", sort_order(F.col("seat_type"), F.col("ward"), F.col("name")))

    def committees() -> DataFrame:
        chairs = by("chairs").groupBy(F.col("to_id").alias("id")).agg(F.min(F.struct(F.col("from_id").alias("id"), F.col("from_name").alias("name"))).alias("c")).select("id", F.col("c.id").alias("chair_id"), F.col("c.name").alias("chair_name"))
        seated = by("member_of").join(people().select(F.col("id").alias("from_id"), "sort_order"), "from_id").select(F.col("to_id").alias("id"), "sort_order", F.col("from_name").alias("members"))
        return of("committee").join(chairs, "id", "left").join(graph.listed(seated, "id", ["sort_order", "members"], ["members"]), "id", "left").na.fill("", ["chair_id", "chair_name", "members"]).na.fill(0, ["n"])

    def bodies() -> DataFrame:
        agencies_of = by("governs", "affiliated_with").select(F.col("from_id").alias("id"), F.col("to_id").alias("agency_ids"), F.col("to_name").alias("agency_names")).distinct()
        agency_lists = graph.listed(agencies_of, "id", ["agency_names", "agency_ids"], ["agency_ids", "agency_names"]).drop("n")
        law = of("legal_authority").select(F.col("id").alias("to_id"), attribute("locator").alias("locator"), attribute("canonicalUrl").alias("canonical_url"))
        first_law = by("authorized_by").join(law, "to_id").groupBy(F.col("from_id").alias("id")).agg(F.min_by(F.struct("locator", "canonical_url"), "to_id").alias("law"))
        return of(*BODY_KINDS).join(first_law, "id", "left").join(agency_lists, "id", "left").na.fill("", ["agency_ids", "agency_names"])

    @cache
    def areas() -> DataFrame:
        return structure(rows, links(), names)

    def commissions() -> DataFrame:
        # sizes and lists read these several times, and the joins before are the work
        found = materialise(areas().select(F.col("anc_id").alias("id"), "smd_id", F.col("current_commissioner_name").alias("commissioners")), "commissions")
        held = materialise(found.where("commissioners <> ''").select("id", "commissioners").distinct(), "commissioners")
        sizes = found.groupBy("id").agg(F.count_distinct("smd_id").alias("smd_count"))
        return of("anc").join(sizes, "id", "left").join(graph.listed(held, "id", ["commissioners"], ["commissioners"]).drop("n"), "id", "left").na.fill("", ["commissioners"]).na.fill(0, ["smd_count"])

    def laws() -> DataFrame:
        used = usage(links(), names).select(F.col("authority_id").alias("id"), F.col("entry_id").alias("used_by_ids"), F.col("name").alias("used_by_names"))
        lists = graph.listed(used, "id", ["used_by_names", "used_by_ids"], ["used_by_ids", "used_by_names"])
        return of("legal_authority").join(lists, "id", "left").na.fill("", ["used_by_ids", "used_by_names"]).na.fill(0, ["n"])

    known = set(coverage.columns)
    return Tables({
        "agencies": lambda: organisations("agency", "agency_id"),
        "offices": lambda: organisations("office", "office_id"),
        "councilmembers": lambda: people().select("sort_order", F.col("id").alias("councilmember_id"), "name", "seat_type", "office_title", "ward", F.col("seat_type").isin("at_large", "chairman").cast("string").alias("is_at_large"), "profile_url", "source_url", "source_id"),
        "council_committees": lambda: committees().select(F.col("id").alias("committee_id"), "name", attribute("committeeType").alias("committee_type"), "chair_id", "chair_name", F.col("n").alias("member_count"), "members", "source_url", "source_id"),
        "public_bodies": lambda: bodies().select(
            F.col("id").alias("public_body_id"), "name", bare(F.col("kind")).alias("body_type"), attribute("shortName").alias("short_name"), attribute("officialUrl").alias("official_url"),
            first_filled(F.col("law.locator"), attribute("enablingStatute")).alias("enabling_authority"), first_filled(F.col("law.canonical_url"), attribute("enablingStatuteUrl")).alias("authority_url"),
            attribute("sourceOpenDcUrl").alias("open_dc_url"), attribute("currentStateNote").alias("current_state_note"), "agency_ids", "agency_names", "source_url", "source_id",
        ),
        "public_body_affiliations": lambda: by("governs", "affiliated_with").where(F.col("from_kind").isin(*[names.kind(k) for k in BODY_KINDS])).select(F.col("from_id").alias("public_body_id"), F.col("from_name").alias("public_body_name"), bare(F.col("from_kind")).alias("body_type"), F.col("label").alias("relation_type"), F.col("to_id").alias("target_id"), F.col("to_name").alias("target_name"), F.col("to_kind").alias("target_type"), "source_url", "source_id"),
        "ancs": lambda: commissions().select(
            F.col("id").alias("anc_id"), F.col("name").alias("anc"), first_filled(attribute("officialUrl"), attribute("webUrl")).alias("official_url"), attribute("sourceOancProfileUrl").alias("oanc_profile_url"), attribute("sourceWardNumbers").alias("wards"),
            attribute("representedNeighborhoods").alias("neighborhoods"), "smd_count", F.col("commissioners").alias("current_commissioners"), first_filled(attribute("currentStateNote"), attribute("description")).alias("current_state_note"), "source_url", "source_id",
        ),
        "smds": lambda: areas().select("smd_id", "smd", "anc_id", "anc", "wards", "commissioner_seat_id", "current_commissioner_name", "officer_role", "source_url", "source_id"),
        "smd_commissioners": lambda: areas().select("smd", "anc", "wards", "current_commissioner_name", "officer_role", "smd_id", "anc_id", "commissioner_seat_id", "source_url", "source_id"),
        "wards": lambda: of("ward").select(F.col("id").alias("ward_id"), attribute("wardNumber").alias("ward_number"), "name"),
        "courts": lambda: of("court_system", "court", "court_division").join(parents("part_of"), "id", "left").na.fill("", ["parent_id", "parent_name"]).select(F.col("id").alias("court_id"), "name", bare(F.col("kind")).alias("court_type"), "parent_id", "parent_name", attribute("officialUrl").alias("official_url"), "source_url", "source_id"),
        "legal_authorities": lambda: laws().select(F.col("id").alias("authority_id"), attribute("authorityType").alias("authority_type"), attribute("locator").alias("locator"), attribute("canonicalUrl").alias("canonical_url"), "name", F.col("n").alias("used_by_count"), "used_by_ids", "used_by_names"),
        "relationships": lambda: links().select("from_id", "from_name", F.col("from_kind").alias("from_type"), F.col("label").alias("relation_type"), "to_id", "to_name", F.col("to_kind").alias("to_type"), "source_url", "source_id"),
        "sources": lambda: coverage.select(*[F.col(c) if c in known else F.lit("").alias(c) for c in SOURCES]),
    })


def audit_tables(entries: DataFrame, relations: DataFrame, names: Names | None = None) -> dict[str, DataFrame]:
    """What the public tables come from, for those who check them: entries, relations, their citations, affiliations of boards, commissions
    and authorities, the committees' memberships, the areas' structure, and counts by kind and source."""
    names = names or Names()
    kind_of = entries.select(F.col("id").alias("from_id"), F.col("kind").alias("from_kind"), F.col("name").alias("from_name"))
    name_of = entries.select(F.col("id").alias("to_id"), F.col("name").alias("to_name"), F.col("kind").alias("to_kind"))
    links = relations.join(kind_of, "from_id", "left").join(name_of, "to_id", "left")
    own = entries.select(F.lit("entry").alias("citation_type"), F.col("id").alias("entry_id"), F.lit("").alias("relation_kind"), F.lit("").alias("to_id"), F.explode("citations").alias("c"))
    edge = relations.select(F.lit("relation").alias("citation_type"), F.col("from_id").alias("entry_id"), F.col("kind").alias("relation_kind"), "to_id", F.explode("citations").alias("c"))
    cited = own.unionByName(edge).select("citation_type", "entry_id", "relation_kind", "to_id", *[F.coalesce(F.col(f"c.{x}"), F.lit("")).alias(x) for x in ("source", "source_record_id", "locator", "url", "reason")], F.coalesce("c.uncited", F.lit(False)).alias("uncited"))
    affiliations = lambda kind: links.where((F.col("from_kind") == names.kind(kind)) & F.col("kind").isin(names.relation("governs"), names.relation("affiliated_with"))).select(F.col("from_id").alias(f"{kind}_id"), F.col("from_name").alias(f"{kind}_name"), "kind", "to_id", "to_name")
    roles = links.where(F.col("kind").isin(names.relation("member_of"), names.relation("chairs")) & (F.col("from_kind") == names.kind("councilmember"))).select(F.col("to_id").alias("committee_id"), F.col("to_name").alias("committee_name"), F.col("from_id").alias("councilmember_id"), F.col("from_name").alias("councilmember_name"), F.when(F.col("kind") == names.relation("chairs"), "chair").otherwise("member").alias("membership_role"))
    memberships = graph.role_override(roles, ["committee_id", "committee_name", "councilmember_id", "councilmember_name"], "membership_role", ("member", "chair"))
    return {
        "entries": entries.select("id", "family", "kind", "name", F.coalesce(attribute_text(F.try_element_at("attributes", F.lit("shortName"))), F.col("name")).alias("short_name"), F.to_json("attributes").alias("attributes")),
        "relations": relations.select("from_id", "kind", "to_id", F.to_json("citations").alias("citations")),
        "citations": cited,
        "board_affiliations": affiliations("board"),
        "commission_affiliations": affiliations("commission"),
        "authority_affiliations": affiliations("authority"),
        "committee_memberships": memberships,
        "kind_counts": entries.groupBy("kind").agg(F.count("*").alias("n")),
        "relation_kind_counts": relations.groupBy("kind").agg(F.count("*").alias("n")),
        "source_counts": cited.where("source <> ''").groupBy("source").agg(F.count("*").alias("n")),
    }


# The public tables and their first columns, by which files are ordered, with those that break ties.
ORDER = {
    "agencies": ("agency_id",), "offices": ("office_id",), "councilmembers": ("sort_order", "councilmember_id"), "council_committees": ("committee_id",), "public_bodies": ("public_body_id",),
    "public_body_affiliations": ("public_body_id", "relation_type", "target_id"), "ancs": ("anc_id",), "smds": ("smd_id", "anc_id"), "smd_commissioners": ("smd", "smd_id", "anc_id"), "wards": ("ward_id",), "courts": ("court_id",),
    "legal_authorities": ("authority_id",), "relationships": ("from_id", "relation_type", "to_id"), "sources": ("source",),
}
# Primary keys of the bundle's tables.
KEYS = {
    "agencies": ["agency_id"], "offices": ["office_id"], "councilmembers": ["councilmember_id"], "council_committees": ["committee_id"], "public_bodies": ["public_body_id"], "ancs": ["anc_id"], "smds": ["smd_id", "anc_id"],
    "wards": ["ward_id"], "courts": ["court_id"], "legal_authorities": ["authority_id"], "sources": ["source"], "entries": ["id"], "kind_counts": ["kind"], "relation_kind_counts": ["kind"], "source_counts": ["source"],
}
# Further names of tables in the bundle.
VIEWS = {"boards_and_commissions": "public_bodies", "advisory_neighborhood_commissions": "ancs", "single_member_districts": "smds", "council": "councilmembers"}


def bundle(public: dict[str, DataFrame], audit: dict[str, DataFrame], path: str) -> dict[str, DataFrame]:
    """All tables under one path, their keys checked, swapped in together; what was written, by name."""
    from ..sinks import write_bundle

    return write_bundle({**public, **{f"audit_{k}" if k in public else k: v for k, v in audit.items()}}, path, KEYS, VIEWS)
