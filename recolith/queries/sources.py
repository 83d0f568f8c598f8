"""Queries of interpreters: the driver's tables as records of sources, to fragments and findings.

Each row is one thing: an entry (id, kind, name), a relation (from, kind, to) or a finding (code, message, kind).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import BODY_RULES
from ..plans import interpreters as ip
from .common import registry, table, text

QUERIES, ORACLE_SQL, query = registry()


def records(df: DataFrame, source: str, key_: str, **payload: Column) -> DataFrame:
    """RECORD rows of a table; fields that are null are left out of the payload."""
    return df.select(F.lit(source).alias("source"), F.lit("all").alias("snapshot_key"), text(key_).alias("key"), F.to_json(F.struct(*[v.alias(k) for k, v in payload.items()])).alias("payload"))


def shown(made: ip.Interpreted) -> DataFrame:
    entries = made.entries.select(F.lit("entry").alias("what"), F.col("provisional_id").alias("a"), F.col("kind").alias("b"), F.col("name").alias("c"))
    relations = made.relations.select(F.lit("relation").alias("what"), F.col("from_id").alias("a"), F.col("relation_kind").alias("b"), F.col("to_id").alias("c"))
    findings = made.findings.select(F.lit("finding").alias("what"), F.col("code").alias("a"), F.col("message").alias("b"), F.col("kind").alias("c"))
    return entries.unionByName(relations).unionByName(findings)


def shown_whole(made: ip.Interpreted) -> DataFrame:
    """Entries with their attributes (name=JSON, in order) and citations (source, record, locator, url), relations with their citations, and findings."""
    cites = F.array_join(F.transform("citations", lambda c: F.concat_ws("|", c["source"], c["source_record_id"], F.coalesce(c["locator"], F.lit("")), F.coalesce(c["url"], F.lit("")))), ";")
    values = F.array_join(F.transform(F.array_sort(F.map_entries("attributes")), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    entries = made.entries.select(F.lit("entry").alias("what"), F.col("provisional_id").alias("a"), F.col("kind").alias("b"), F.col("name").alias("c"), values.alias("attributes"), cites.alias("cited"))
    relations = made.relations.select(F.lit("relation").alias("what"), F.col("from_id").alias("a"), F.col("relation_kind").alias("b"), F.col("to_id").alias("c"), F.lit("").alias("attributes"), cites.alias("cited"))
    findings = made.findings.select(F.lit("finding").alias("what"), F.col("code").alias("a"), F.col("message").alias("b"), F.col("kind").alias("c"), F.lit("").alias("attributes"), F.lit("").alias("cited"))
    return entries.unionByName(relations).unionByName(findings)


def agency_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as agencies below the supplier of their nation's number; some without a name."""
    k = F.col("s_suppkey")
    return records(table(spark, sf_dir, "supplier"), "gis.agencies", "s_suppkey", AGENCY_ID=k, AGENCY_NAME=F.when(k % 10 != 0, F.col("s_name")), PARENT_AGENCY_ID=F.col("s_nationkey"), LEGAL_BASIS=F.when(k % 4 == 1, F.concat(F.lit("D.C. Code § 1-"), text("s_nationkey"))))


AGENCY_SQL = """
g AS (SELECT s_suppkey AS k, s_nationkey AS up, s_name AS name, 'agency:' || lower(replace(s_name, '#', '-')) AS id, CASE WHEN s_suppkey % 4 = 1 THEN '1-' || s_nationkey END AS law FROM supplier WHERE s_suppkey % 10 <> 0)
"""


@query(f"""WITH {AGENCY_SQL}
SELECT 'entry' AS what, id AS a, 'agency' AS b, name AS c FROM g
UNION ALL SELECT 'entry', 'legal_authority:d-c-code-' || law, 'legal_authority', 'D.C. Code § ' || law FROM g WHERE law IS NOT NULL
UNION ALL SELECT 'relation', g.id, 'reports_to', p.id FROM g JOIN g p ON g.up = p.k WHERE g.up <> g.k
UNION ALL SELECT 'relation', id, 'authorized_by', 'legal_authority:d-c-code-' || law FROM g WHERE law IS NOT NULL
UNION ALL SELECT 'finding', 'interpreter.agency_name_missing', 'gis.agencies:' || s_suppkey, 'warn' FROM supplier WHERE s_suppkey % 10 = 0
UNION ALL SELECT 'finding', 'interpreter.parent_agency_missing', k || ' has parent ' || up, 'warn' FROM g WHERE up <> k AND up NOT IN (SELECT k FROM g)""")
def interpreted_agencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(ip.agencies(agency_records(spark, sf_dir))[0])


@query(f"""WITH {AGENCY_SQL}, b AS (SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey END AS ref, CASE WHEN c_custkey % 3 = 1 THEN 'Supplier#' || lpad((c_custkey % 50) :: VARCHAR, 9, '0') END AS label FROM customer)
SELECT 'entry' AS what, 'board:' || k AS a, 'board' AS b, name AS c FROM b
UNION ALL SELECT 'relation', 'board:' || b.k, 'governs', coalesce(g.id, 'agency:' || ref) FROM b LEFT JOIN g ON g.k = ref WHERE ref IS NOT NULL
UNION ALL SELECT 'relation', 'board:' || b.k, 'governs', g.id FROM b JOIN g ON g.name = label""")
def interpreted_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(board_parts(spark, sf_dir)[1])


def board_parts(spark: SparkSession, sf_dir: str) -> tuple[ip.Interpreted, ip.Interpreted]:
    """Agencies, and customers as boards: of an agency by its id, known or not, by its name, or of none."""
    k = F.col("c_custkey")
    label = F.when(k % 3 == 1, F.concat(F.lit("Supplier#"), F.lpad((k % 50).cast("string"), 9, "0")))
    rows = records(table(spark, sf_dir, "customer"), "gis.boards", "c_custkey", BOARD_ID=k, NAME=F.col("c_name"), AGENCY_ID=F.when(k % 3 == 0, F.col("c_nationkey")), GOVERNING_AGENCY=label)
    agencies, lookups = ip.agencies(agency_records(spark, sf_dir))
    return agencies, ip.bodies(rows, lookups, "board")


@query("""WITH m AS (SELECT c_custkey AS k, c_custkey % 4 AS way, c_name AS name, c_nationkey AS ward, 'councilmember:m' || c_custkey AS id,
  CASE c_custkey % 4 WHEN 0 THEN 'ward-' || c_nationkey || '-councilmember' WHEN 1 THEN 'at-large-councilmember' WHEN 2 THEN 'council-chairman' END AS office,
  CASE c_custkey % 4 WHEN 0 THEN 'Ward ' || c_nationkey || ' Councilmember' WHEN 1 THEN 'At-Large Councilmember' WHEN 2 THEN 'Chairman' END AS label FROM customer WHERE c_custkey % 9 <> 0)
SELECT 'entry' AS what, id AS a, 'councilmember' AS b, name AS c FROM m
UNION ALL SELECT 'entry', 'elected_office:' || office, 'elected_office', label FROM m WHERE office IS NOT NULL
UNION ALL SELECT 'entry', 'ward:' || ward, 'ward', 'Ward ' || ward FROM m WHERE way = 0
UNION ALL SELECT 'relation', id, 'holds', 'elected_office:' || office FROM m WHERE office IS NOT NULL
UNION ALL SELECT 'relation', unnest([id, 'elected_office:' || office]), 'represents', 'ward:' || ward FROM m WHERE way = 0
UNION ALL SELECT 'finding', 'interpreter.councilmember_missing_fields', 'council.members:' || c_custkey, 'warn' FROM customer WHERE c_custkey % 9 = 0""")
def interpreted_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(member_parts(spark, sf_dir))


def member_parts(spark: SparkSession, sf_dir: str) -> ip.Interpreted:
    """Customers as members: of a ward, at large, the chairman, or without a title; some without a profile."""
    k = F.col("c_custkey")
    title = F.when(k % 4 == 0, F.concat(F.lit("Ward "), text("c_nationkey"), F.lit("  Councilmember "), "c_name")).when(k % 4 == 1, F.concat(F.lit("At-Large Councilmember "), "c_name")).when(k % 4 == 2, F.concat(F.lit("Chairman "), "c_name")).otherwise(F.col("c_name"))
    rows = records(table(spark, sf_dir, "customer"), "council.members", "c_custkey", memberName=title, profileSlug=F.when(k % 9 != 0, F.concat(F.lit("m"), text("c_custkey"))), profileUrl=F.lit("https://c.example/"))
    return ip.members(rows)


@query("""WITH s AS (SELECT c_custkey AS k, c_nationkey AS anc, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Vacant' ELSE c_name END AS holder, c_custkey % 6 = 0 AS loose, c_custkey % 7 = 0 AS unnamed FROM customer),
n AS (SELECT *, CASE WHEN unnamed THEN 'SMD ' || k ELSE 'Area ' || k END AS name FROM s)
SELECT 'entry' AS what, 'smd:' || k AS a, 'smd' AS b, name AS c FROM n UNION ALL SELECT 'entry', 'anc_commissioner_seat:' || k, 'anc_commissioner_seat', 'Commissioner Seat for ' || name FROM n
UNION ALL SELECT 'entry', 'anc:' || n_nationkey, 'anc', n_name FROM nation
UNION ALL SELECT 'relation', 'anc:' || anc, 'contains', 'smd:' || k FROM n WHERE NOT loose UNION ALL SELECT 'relation', 'anc_commissioner_seat:' || k, 'represents', 'smd:' || k FROM n
UNION ALL SELECT 'finding', 'interpreter.smd_' || unnest([CASE WHEN unnamed THEN 'name_missing' END, CASE WHEN holder = 'Vacant' THEN 'representative_vacant' END, CASE WHEN holder IS NULL THEN 'representative_missing' END, CASE WHEN loose THEN 'anc_id_missing' END]) AS a, 'gis.smds:' || k, 'warn' FROM n""")
def interpreted_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(ip.together(*area_parts(spark, sf_dir)))


def area_parts(spark: SparkSession, sf_dir: str) -> tuple[ip.Interpreted, ip.Interpreted]:
    """Nations as commissions, customers as their areas with a seat each."""
    k = F.col("c_custkey")
    holder = F.when(k % 5 == 1, "Vacant").when(k % 5 != 0, F.col("c_name"))
    areas = records(table(spark, sf_dir, "customer"), "gis.smds", "c_custkey", SMD_ID=k, NAME=F.when(k % 7 != 0, F.concat(F.lit("Area "), text("c_custkey"))), ANC_ID=F.when(k % 6 != 0, F.col("c_nationkey")), REP_NAME=holder)
    commissions = records(table(spark, sf_dir, "nation"), "gis.ancs", "n_nationkey", ANC_ID=F.col("n_nationkey"), NAME=F.col("n_name"))
    return ip.ancs(commissions), ip.smds(areas)


ORACLE_SQL["interpreted_areas"] = "SELECT * FROM (" + ORACLE_SQL["interpreted_areas"] + ") WHERE a IS NOT NULL"


@query("""SELECT 'entry' AS what, 'court:' || replace(lower(r_name), ' ', '-') AS a, 'court' AS b, r_name AS c FROM region WHERE r_regionkey <> 2
UNION ALL SELECT 'entry', 'court_division:' || trim(regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g'), '-'), 'court_division', n_name FROM nation
UNION ALL SELECT 'relation', 'court_division:' || trim(regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g'), '-'), 'part_of', 'court:' || replace(lower(r_name), ' ', '-') FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey <> 2
UNION ALL SELECT 'finding', 'interpreter.courts_parent_missing', 'n' || n_nationkey || ' has parent ' || r_name, 'warn' FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey = 2
UNION ALL SELECT 'finding', 'interpreter.courts_missing_fields', 'courts:r2', 'warn'""")
def interpreted_courts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(court_parts(spark, sf_dir))


def court_parts(spark: SparkSession, sf_dir: str) -> ip.Interpreted:
    """Regions as courts, one of an unknown kind, and nations as their divisions."""
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    url = F.lit("https://courts.example/")
    courts = records(r.withColumn("k", F.concat(F.lit("r"), text("r_regionkey"))), "courts", "k", name=F.col("r_name"), key=F.col("k"), url=url, entryKind=F.when(F.col("r_regionkey") == 2, "mystery").otherwise("court"))
    named = n.join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey")).withColumn("k", F.concat(F.lit("n"), text("n_nationkey")))  # five regions
    divisions = records(named, "courts", "k", name=F.col("n_name"), key=F.col("k"), url=url, entryKind=F.lit("division"), parentName=F.col("r_name"))
    return ip.structure(courts.unionByName(divisions), {"court": "court", "division": "court_division"}, "courts")


@query(f"""WITH {AGENCY_SQL}, p AS (SELECT p_partkey AS k, 'Body ' || (p_partkey // 2) || CASE p_partkey // 2 % 4 WHEN 0 THEN ' Board' WHEN 1 THEN ' Commission' WHEN 2 THEN ' Authority' ELSE '' END AS name,
  CASE p_partkey // 2 % 4 WHEN 0 THEN 'board' WHEN 1 THEN 'commission' WHEN 2 THEN 'authority' ELSE 'public_body' END AS kind,
  CASE WHEN p_partkey % 2 = 0 THEN 'Supplier#' || lpad((p_partkey % 60) :: VARCHAR, 9, '0') END AS agency FROM part),
t AS (SELECT 'board' AS kind, 'body ' || x || ' board' AS name, 'board:t' || x AS id FROM (SELECT range * 4 AS x FROM range(20))),
w AS (SELECT p.*, t.id IS NOT NULL AS shadow, coalesce(t.id, p.kind || ':b' || k) AS id, agency IS NULL AND EXISTS (SELECT 1 FROM p q WHERE q.name = p.name AND q.agency IS NOT NULL) AS stale FROM p LEFT JOIN t ON t.kind = p.kind AND t.name = lower(p.name))
SELECT 'entry' AS what, id AS a, CASE kind WHEN 'public_body' THEN 'agency' ELSE kind END AS b, name AS c FROM w WHERE NOT stale
UNION ALL SELECT 'relation', w.id, 'governs', g.id FROM w JOIN g ON g.name = agency WHERE NOT stale
UNION ALL SELECT 'finding', 'interpreter.governing_agency_unresolved', w.name || ' names ' || agency, 'warn' FROM w WHERE agency IS NOT NULL AND NOT stale AND agency NOT IN (SELECT name FROM g)
UNION ALL SELECT 'finding', 'interpreter.stale_or_failed_duplicate', name, 'info' FROM w WHERE stale
UNION ALL SELECT 'finding', 'interpreter.public_body_unclassified', name, 'warn' FROM w WHERE kind = 'public_body'
UNION ALL SELECT 'finding', 'interpreter.public_body_source_shadow_merged', name || ' is ' || id, 'info' FROM w WHERE shadow""")
def interpreted_public_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as bodies, two of each name of which one has substance; some boards are known under trusted ids."""
    k = F.col("p_partkey")
    half = F.floor(k / 2)
    tail = F.when(half % 4 == 0, " Board").when(half % 4 == 1, " Commission").when(half % 4 == 2, " Authority").otherwise("")
    agency = F.when(k % 2 == 0, F.concat(F.lit("Supplier#"), F.lpad((k % 60).cast("string"), 9, "0")))
    rows = records(table(spark, sf_dir, "part"), "open.bodies", "p_partkey", name=F.concat(F.lit("Body "), half.cast("string"), tail), slug=F.concat(F.lit("b"), text("p_partkey")), detailUrl=F.lit("https://o.example/"), governingAgency=agency)
    x = (F.col("id") * 4).cast("string")
    trusted = spark.range(20).select(F.lit("board").alias("kind"), F.concat(F.lit("Body "), x, F.lit(" Board")).alias("name"), F.concat(F.lit("board:t"), x).alias("id"), F.col("id").alias("seq"))
    return shown(ip.public_bodies(rows, trusted, ip.agencies(agency_records(spark, sf_dir))[1], BODY_RULES))


@query("""WITH n AS (SELECT n_nationkey AS k, n_name AS name, CASE WHEN n_nationkey % 7 <> 0 THEN 'https://law.example/' || n_nationkey END AS url FROM nation)
SELECT 'entry' AS what, 'legal_entrypoint:' || trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') AS a, 'legal_entrypoint' AS b, name AS c,
  'officialUrl="' || url || '";sourceHeading="H ' || k || '";sourceSeeded=' || CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END AS attributes, 'law.sites|' || k || '||' || url AS cited FROM n WHERE url IS NOT NULL
UNION ALL SELECT 'finding', 'interpreter.legal_entrypoint_missing_fields', 'law.sites:' || k, 'warn', '', '' FROM n WHERE url IS NULL""")
def interpreted_entrypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as legal sites, some of the seed and some without an address."""
    k = F.col("n_nationkey")
    url = F.when(k % 7 != 0, F.concat(F.lit("https://law.example/"), text("n_nationkey")))
    rows = records(table(spark, sf_dir, "nation"), "law.sites", "n_nationkey", name=F.col("n_name"), url=url, heading=F.concat(F.lit(" H "), text("n_nationkey")), fromSeed=k % 2 == 0)
    return shown_whole(ip.entrypoints(rows))


@query(f"""WITH {AGENCY_SQL}, n AS (SELECT 'n' || n_nationkey AS k, n_name AS name, CASE WHEN n_nationkey > 4 THEN 'n' || n_regionkey END AS up, CASE WHEN n_nationkey % 3 = 0 THEN 'reports_to' ELSE 'part_of' END AS kind FROM nation),
r AS (SELECT 's' || s_suppkey AS k, s_name AS name, 'n' || CASE WHEN s_suppkey % 9 = 0 THEN 99 ELSE s_nationkey END AS up, 'Supplier#' AS label FROM supplier)
SELECT 'entry' AS what, 'office:' || k AS a, 'office' AS b, name AS c, 'sourceOfficeKey="' || k || '";sourcePageUrl="https://x.example/"' AS attributes, 'exec|' || k || '||https://x.example/' AS cited FROM n
UNION ALL SELECT 'relation', 'office:' || k, kind, 'office:' || up, '', 'exec|' || k || '||https://x.example/' FROM n WHERE up IS NOT NULL
UNION ALL SELECT 'relation', g.id, 'reports_to', 'office:' || r.up, '', 'exec|' || r.k || '||https://x.example/' FROM r JOIN g ON g.name = r.name WHERE r.up <> 'n99'
UNION ALL SELECT 'finding', 'interpreter.executive_agency_unresolved', k || ' names agency ' || name, 'warn', '', '' FROM r WHERE name NOT IN (SELECT name FROM g)
UNION ALL SELECT 'finding', 'interpreter.executive_parent_missing', r.k || ' has parent n99', 'warn', '', '' FROM r JOIN g ON g.name = r.name WHERE r.up = 'n99'""")
def interpreted_executive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as offices, most below another, and suppliers as agencies below them; some agencies and some offices are nowhere."""
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    k, url = F.col("n_nationkey"), F.lit("https://x.example/")
    own = n.withColumn("k", F.concat(F.lit("n"), text("n_nationkey")))
    offices = records(own, "exec", "k", key=F.col("k"), name=F.col("n_name"), sourceUrl=url, entryKind=F.lit("office"), parentKey=F.when(k > 4, F.concat(F.lit("n"), text("n_regionkey"))), relationKind=F.when(k % 3 == 0, "reports_to").otherwise("part_of"))
    below = s.withColumn("k", F.concat(F.lit("s"), text("s_suppkey")))
    parent = F.concat(F.lit("n"), F.when(F.col("s_suppkey") % 9 == 0, F.lit(99)).otherwise(F.col("s_nationkey")).cast("string"))
    agencies = records(below, "exec", "k", key=F.col("k"), name=F.col("s_name"), sourceUrl=url, entryKind=F.lit("agency_ref"), parentKey=parent, relationKind=F.lit("reports_to"))
    return shown_whole(ip.executive(offices.unionByName(agencies), ip.agencies(agency_records(spark, sf_dir))[1]))


@query("""WITH c AS (SELECT n_nationkey AS k, n_name AS name FROM nation), s AS (SELECT c_custkey AS k, c_nationkey AS anc, c_name AS name FROM customer)
SELECT 'entry' AS what, 'anc:' || k AS a, 'anc' AS b, name AS c, 'sourceAncId="' || k || '";sourceOancProfileUrl="https://p.example/' || k || '";sourceWardNumbers=["' || k % 8 || '"]' AS attributes, 'oanc|' || k || '||https://p.example/' || k AS cited FROM c
UNION ALL SELECT 'entry', 'ward:' || k % 8, 'ward', 'Ward ' || k % 8, 'wardNumber="' || k % 8 || '"', 'oanc|' || k || '||' FROM c
UNION ALL SELECT 'relation', 'ward:' || k % 8, 'contains', 'anc:' || k, '', 'oanc|' || k || '||' FROM c
UNION ALL SELECT 'entry', 'anc_commissioner_seat:' || k, 'anc_commissioner_seat', 'Commissioner Seat for SMD ' || k, 'currentHolderName="' || name || '"' || CASE WHEN k % 4 = 0 THEN ';officerRole="Chair"' ELSE '' END || ';sourceAncId="' || anc || '";sourceOancProfileUrl="https://p.example/' || anc || '";sourceSmdId="' || k || '"', 'oanc|' || anc || '||https://p.example/' || anc FROM s WHERE k % 5 <> 0
UNION ALL SELECT 'finding', 'interpreter.commissioner_slash_smd_deferred', anc || ' has seat ' || k || '/x', 'info', '', '' FROM s WHERE k % 5 = 0""")
def interpreted_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as commissions of a ward, with customers as commissioners; seats whose id has a slash wait for review."""
    n, c = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    seat = F.struct(F.concat(text("c_custkey"), F.when(k % 5 == 0, "/x").otherwise("")).alias("smdId"), F.col("c_name").alias("name"), F.when(k % 4 == 0, "Chair").alias("officerRole"))
    people = c.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.collect_list(seat).alias("people"))
    whole = n.join(people, "n_nationkey", "left")
    rows = records(whole, "oanc", "n_nationkey", ancId=text("n_nationkey"), name=F.col("n_name"), profileUrl=F.concat(F.lit("https://p.example/"), text("n_nationkey")), wardNumbers=F.array((F.col("n_nationkey") % 8).cast("string")), commissioners=F.col("people"))
    return shown_whole(ip.profiles(rows))


@query(f"""WITH {AGENCY_SQL}, d AS (SELECT s_suppkey AS k, s_name AS name, 'https://a.example/' || s_suppkey AS url FROM supplier)
SELECT 'entry' AS what, g.id AS a, 'agency' AS b, d.name AS c, 'officialUrl="' || url || '"' AS attributes, 'dir|' || d.k || '||' || url AS cited FROM d JOIN g ON g.name = d.name
UNION ALL SELECT 'finding', 'interpreter.agency_directory_unmatched', name || ' ' || url, 'warn', '', '' FROM d WHERE name NOT IN (SELECT name FROM g)""")
def interpreted_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in a directory: addresses of the agencies of their names; some names are no agency's."""
    rows = records(table(spark, sf_dir, "supplier"), "dir", "s_suppkey", directoryName=F.col("s_name"), officialUrl=F.concat(F.lit("https://a.example/"), text("s_suppkey")))
    return shown_whole(ip.directory(rows, ip.agencies(agency_records(spark, sf_dir))[1]))
