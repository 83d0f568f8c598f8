"""Queries of fragments, relations, revisions and candidates."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_name
from ..functions.values import cite
from ..model import REVISION
from ..operators import candidates as ca
from ..operators import fragments as fr
from ..operators import replay as rp
from ..operators import revisions as rv
from ..operators.validate import Kind, Registry, entry_issues, state_issues
from ..plans.compile import compile_state
from ..plans.incremental import Ledger
from ..stages import fresh_path, materialise, spread
from .common import GRAPH_SQL, attributes, entity_edges, entity_fragments, graph, json_text, no_citations, ord_of, registry, table, text

QUERIES, ORACLE_SQL, query = registry()


@query(f"""WITH {GRAPH_SQL}
SELECT 'entry' AS what, kind, count(*) :: BIGINT AS n FROM e GROUP BY kind UNION ALL SELECT 'relation', kind, count(*) :: BIGINT FROM r GROUP BY kind""")
def entity_graph_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four tables as fragments, compiled to a state and counted by kind."""
    frames = entity_fragments(spark, sf_dir)
    policy = spark.createDataFrame([(k, k, "promote") for k in ("region", "nation", "supplier", "customer")], "source string, kind string, action string")
    kinds = {k: Kind(f) for k, f in (("region", "area"), ("nation", "area"), ("supplier", "organization"), ("customer", "organization"))}
    compiled = compile_state(fr.union_fragments(*frames), entity_edges(spark, sf_dir), policy, Registry(kinds, {"part_of", "located_in"}))
    entries, relations = compiled.state
    counts = lambda df, what: df.groupBy("kind").agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "kind", "n")
    return counts(entries, "entry").unionByName(counts(relations, "relation"))


@query("""SELECT 0 AS binding, 'region:' || r_regionkey AS id, r_name AS name FROM region UNION ALL SELECT 1, 'nation:' || n_nationkey, n_name FROM nation
UNION ALL SELECT 2, 'supplier:' || s_suppkey, s_name FROM supplier UNION ALL SELECT 3, 'customer:' || c_custkey, c_name FROM customer""")
def fragment_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fr.union_fragments(*entity_fragments(spark, sf_dir))
    return rows.select("ord.binding", F.col("provisional_id").alias("id"), "name")


def nation_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and customers as fragments of their nation: many of an id, with ties of record ids within and across sources."""
    frames = []
    for name, p, extra in (("supplier", "s", {}), ("customer", "c", {"segment": json_text(F.col("c_mktsegment"))})):
        key = F.col(f"{p}_{'suppkey' if p == 's' else 'custkey'}")
        # the few columns that are read are dealt and written once; what they become is read several times, by all cores
        rows = materialise(spread(table(spark, sf_dir, name).select(key, f"{p}_name", f"{p}_nationkey", *(["c_mktsegment"] if p == "c" else []))), name)
        frames.append(
            rows.select(
                F.lit(name).alias("source"), F.lpad((key % 50).cast("string"), 3, "0").alias("source_record_id"), F.concat(F.lit("nation:"), text(f"{p}_nationkey")).alias("provisional_id"), F.lit(f"{p}-family").alias("family"),
                F.when(key % 3 == 0, "place").otherwise("nation").alias("kind"), F.concat(F.col(f"{p}_name"), F.repeat(F.lit("x"), (key % 4).cast("int"))).alias("name"),
                attributes(last=json_text(F.col(f"{p}_name")), **extra).alias("attributes"), F.array(cite(F.lit(name), (key % 20).cast("string"))).alias("citations"), ord_of(key).alias("ord"),
            )
        )
    return fr.union_fragments(*frames)


NATION_SQL = """
f AS (
  SELECT 0 AS binding, s_suppkey AS k, 'supplier' AS source, lpad((s_suppkey % 50) :: VARCHAR, 3, '0') AS rid, 'nation:' || s_nationkey AS id, 's-family' AS family, CASE WHEN s_suppkey % 3 = 0 THEN 'place' ELSE 'nation' END AS kind, s_name || repeat('x', (s_suppkey % 4) :: INT) AS name, s_name AS last, NULL AS segment FROM supplier
  UNION ALL
  SELECT 1, c_custkey, 'customer', lpad((c_custkey % 50) :: VARCHAR, 3, '0'), 'nation:' || c_nationkey, 'c-family', CASE WHEN c_custkey % 3 = 0 THEN 'place' ELSE 'nation' END, c_name || repeat('x', (c_custkey % 4) :: INT), c_name, c_mktsegment FROM customer
), o AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY rid, binding, k) AS i FROM f
)
"""


@query(f"""WITH {NATION_SQL}
SELECT id, arg_min(kind, i) AS kind, arg_max(family, i) AS family, (SELECT name FROM o p WHERE p.id = o.id ORDER BY length(name) DESC, i LIMIT 1) AS name,
  arg_max(last, i) AS last, arg_max(segment, i) FILTER (segment IS NOT NULL) AS segment, count(DISTINCT source || ':' || (k % 20)) :: BIGINT AS n_citations,
  string_agg(DISTINCT 'source:' || source || ':' || (k % 20) || '::', ',' ORDER BY 'source:' || source || ':' || (k % 20) || '::') AS citations FROM o GROUP BY id""")
def entry_merge_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = fr.merge_entries(nation_fragments(spark, sf_dir))
    value = lambda a: F.regexp_replace(F.try_element_at("attributes", F.lit(a)), '^"|"$', "")
    ids = F.array_join(F.transform("citations", lambda c: F.concat_ws(":", F.lit("source"), c["source"], c["source_record_id"], F.lit(""), F.lit(""))), ",")
    return merged.select("id", "kind", "family", "name", value("last").alias("last"), value("segment").alias("segment"), F.size("citations").cast("long").alias("n_citations"), ids.alias("citations"))


@query(f"""WITH {NATION_SQL.replace("FROM f", "FROM f WHERE segment IS DISTINCT FROM 'BUILDING'")}
SELECT 'entry' AS what, id, arg_min(kind, i) AS kind, (SELECT name FROM o p WHERE p.id = o.id ORDER BY length(name) DESC, i LIMIT 1) AS name, count(DISTINCT source || ':' || (k % 20)) :: BIGINT AS n FROM o GROUP BY id
UNION ALL SELECT 'relation', 'nation:' || n_nationkey, 'located_in', 'nation:' || n_regionkey, 1 FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier UNION SELECT c_nationkey FROM customer WHERE c_mktsegment <> 'BUILDING')
  AND n_regionkey IN (SELECT s_nationkey FROM supplier UNION SELECT c_nationkey FROM customer WHERE c_mktsegment <> 'BUILDING')""")
def incremental_compile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources compiled one after the other, the second then without a segment: entries and relations as of a full compile."""
    rows = nation_fragments(spark, sf_dir)
    policy = rows.select("source", "kind").distinct().withColumn("action", F.lit("promote"))
    ledger = Ledger(spark, fresh_path(spark, "ledger"), materialise(policy, "policy"), {"inside": "located_in"}, buckets=4)
    edges = table(spark, sf_dir, "nation").select(F.lit("supplier").alias("source"), text("n_nationkey").alias("source_record_id"), F.concat(F.lit("nation:"), text("n_nationkey")).alias("from_id"), F.lit("inside").alias("relation_kind"), F.concat(F.lit("nation:"), text("n_regionkey")).alias("to_id"), F.array(cite(F.lit("supplier"), text("n_nationkey"))).alias("citations"), ord_of(F.col("n_nationkey")).alias("ord"))
    ledger.update("supplier", rows.where("source = 'supplier'"), edges)
    ledger.update("customer", rows.where("source = 'customer'"), edges.limit(0))
    ledger.update("customer", rows.where("source = 'customer' AND NOT attributes['segment'] <=> '\"BUILDING\"'"), edges.limit(0))
    entries = ledger.entries().select(F.lit("entry").alias("what"), "id", "kind", "name", F.size("citations").cast("long").alias("n"))
    return entries.unionByName(ledger.relations().select(F.lit("relation").alias("what"), F.col("from_id").alias("id"), "kind", F.col("to_id").alias("name"), F.size("citations").cast("long").alias("n")))


@query(f"""WITH {NATION_SQL}, k AS (SELECT id, arg_min(kind, i) AS kind FROM o GROUP BY id)
SELECT k.id, k.kind, count(*) :: BIGINT AS conflicts FROM o JOIN k USING (id) WHERE o.kind <> k.kind GROUP BY k.id, k.kind""")
def kind_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fr.kind_conflicts(nation_fragments(spark, sf_dir))


ACTIONS = {"en": "promote", "de": "promote_with_warning", "fr": "review_required", "es": "drop"}


def document_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    action = F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv])[F.col("kind")]
    # sources that end in 7 have no policy, so theirs conflict
    policy = docs.select("source", F.col("lang").alias("kind")).distinct().where(~F.col("source").endswith("7")).withColumn("action", action)
    rows = docs.select("source", text("doc_id").alias("source_record_id"), F.concat(F.lit("doc:"), (F.col("doc_id") % 300).cast("string")).alias("provisional_id"), F.lit("text").alias("family"), F.col("lang").alias("kind"), F.lit("d").alias("name"), attributes(x=F.lit("1")).alias("attributes"), F.array(cite(F.col("source"), text("doc_id"))).alias("citations"), ord_of(F.col("doc_id")).alias("ord"))
    return fr.promotion(rows, policy)


DECISION_SQL = """
d AS (
  SELECT 'doc:' || (doc_id % 300) AS id, doc_id :: VARCHAR AS rid, doc_id, source, CASE WHEN source LIKE '%7' THEN 'conflict' WHEN lang = 'en' THEN 'promote' WHEN lang = 'de' THEN 'promote_with_warning' WHEN lang = 'fr' THEN 'review_required' WHEN lang = 'es' THEN 'drop' ELSE 'conflict' END AS action FROM documents
)
"""


@query(f"""WITH {DECISION_SQL}
SELECT id, arg_max(action, rid) AS action FROM d GROUP BY id HAVING NOT bool_or(action IN ('promote', 'promote_with_warning'))""")
def promotion_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that no fragment promotes, with the last decision."""
    return fr.not_promoted(document_decisions(spark, sf_dir))


@query(f"""WITH {DECISION_SQL}
SELECT CASE action WHEN 'conflict' THEN 'conflict' WHEN 'drop' THEN 'info' ELSE 'warn' END AS kind, 'promotion.' || action AS code, count(*) :: BIGINT AS n FROM d WHERE action <> 'promote' GROUP BY ALL""")
def promotion_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fr.promotion_findings(document_decisions(spark, sf_dir)).groupBy("kind", "code").agg(F.count("*").alias("n"))


def order_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.lit("orders").alias("source"), text("o_orderkey").alias("source_record_id"), F.concat(F.lit("part:"), (F.col("o_orderkey") % 11).cast("string")).alias("from_id"), F.concat(F.lit("status_"), F.col("o_orderstatus")).alias("relation_kind"), F.concat(F.lit("customer:"), text("o_custkey")).alias("to_id"), F.array(cite(F.lit("orders"), text("o_orderkey"))).alias("citations"), ord_of(F.col("o_orderkey")).alias("ord"))


@query("""WITH r AS (SELECT o_orderkey % 11 AS f, o_custkey AS t FROM orders)
SELECT CASE WHEN f = 3 THEN 'source_missing' WHEN f = 4 THEN 'source_not_promoted' WHEN t % 14 = 0 THEN 'target_not_promoted' WHEN t % 7 = 0 OR t NOT IN (SELECT c_custkey FROM customer) THEN 'target_missing' ELSE 'keep' END AS status, count(*) :: BIGINT AS n FROM r GROUP BY 1""")
def relation_endpoint_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_relations(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"))


def checked_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as relations, some of whose ends are missing or not promoted."""
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("customer:"), text("c_custkey")).alias("id"), "c_custkey")
    parts = spark.range(11).where("id <> 3").select(F.concat(F.lit("part:"), text("id")).alias("id"))
    entries = c.where("c_custkey % 7 <> 0").select("id").unionByName(parts.where("id <> 'part:4'"))
    held = c.where("c_custkey % 14 = 0").select("id").unionByName(parts.where("id = 'part:4'"))
    return fr.endpoint_status(order_relations(spark, sf_dir), entries, held)


@query("""SELECT 'supplier:' || l_suppkey AS from_id, 'supplies' AS kind, 'part:' || l_partkey AS to_id, count(DISTINCT l_orderkey) :: BIGINT AS n_citations, replace(min(l_orderkey || '::'), '::', '') AS first_citation FROM lineitem GROUP BY ALL""")
def relation_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("supplier:"), text("l_suppkey")).alias("from_id"), F.lit("supplies").alias("relation_kind"), F.concat(F.lit("part:"), text("l_partkey")).alias("to_id"), F.array(cite(F.lit("lineitem"), text("l_orderkey"))).alias("citations"))
    return fr.dedupe_relations(rows).select("from_id", "kind", "to_id", F.size("citations").cast("long").alias("n_citations"), F.get("citations", 0)["source_record_id"].alias("first_citation"))


@query("""SELECT CASE o_orderstatus WHEN 'F' THEN 'governs' ELSE 'status_' || o_orderstatus END AS kind, count(*) :: BIGINT AS n, count_if(o_orderstatus = 'F') :: BIGINT AS renamed FROM orders GROUP BY 1""")
def relation_kind_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fr.canonical_kinds(order_relations(spark, sf_dir), {"status_F": "governs"})
    return rows.groupBy(F.col("relation_kind").alias("kind")).agg(F.count("*").alias("n"), F.count_if("renamed").alias("renamed"))


@query("""WITH c AS (SELECT 'customer:' || c_custkey AS id, c_custkey AS k FROM customer)
SELECT code, path, count(*) :: BIGINT AS n FROM (
  SELECT unnest([CASE WHEN k % 10 = 0 THEN {code: 'entry.name_missing', path: 'name'} END, CASE WHEN k % 9 = 0 THEN {code: 'entry.kind_unknown', path: 'kind'} END,
    CASE WHEN k % 9 <> 0 AND k % 8 = 0 THEN {code: 'entry.family_mismatch', path: 'family'} END, CASE WHEN k % 9 <> 0 AND k % 7 = 0 THEN {code: 'entry.attribute_missing', path: 'attributes.segment'} END,
    CASE WHEN k % 9 <> 0 AND k % 7 <> 0 AND k % 5 = 0 THEN {code: 'entry.attribute_type', path: 'attributes.segment'} END, CASE WHEN k % 6 = 0 THEN {code: 'entry.citation_invalid', path: 'citations[1]'} END]) AS i FROM c), (SELECT 1)
CROSS JOIN LATERAL (SELECT i.code AS code, i.path AS path) WHERE i IS NOT NULL GROUP BY code, path""")
def entry_validation_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    seg = F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 5 == 0, "12").otherwise(json_text(F.col("c_mktsegment")))
    bad = F.when(k % 6 == 0, cite(F.lit(None).cast("string"), F.lit(None).cast("string"))).otherwise(cite(F.lit("b"), text("c_custkey")))
    rows = table(spark, sf_dir, "customer").select(F.concat(F.lit("customer:"), text("c_custkey")).alias("id"), F.when(k % 8 == 0, "area").otherwise("organization").alias("family"), F.when(k % 9 == 0, "client").otherwise("customer").alias("kind"), F.when(k % 10 == 0, "").otherwise(F.col("c_name")).alias("name"), attributes(segment=seg).alias("attributes"), F.array(cite(F.lit("a"), text("c_custkey")), bad).alias("citations"))
    return entry_issues(rows, Registry({"customer": Kind("organization", {"segment": ("string", True)})})).groupBy("code", "path").agg(F.count("*").alias("n"))


@query(f"""WITH {GRAPH_SQL}
SELECT 'entry.relation_kind_unknown' AS code, count(*) :: BIGINT AS n FROM r WHERE kind = 'part_of' UNION ALL SELECT 'relation.target_missing', count(*) :: BIGINT FROM r WHERE to_id IN ('nation:3', 'nation:4')""")
def state_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries, relations = graph(spark, sf_dir)
    kinds = {k: Kind(f) for k, f in (("region", "area"), ("nation", "area"), ("supplier", "organization"), ("customer", "organization"))}
    issues = state_issues(entries.where("id NOT IN ('nation:3', 'nation:4')"), relations, Registry(kinds, {"located_in"}))
    return issues.groupBy("code").agg(F.count("*").alias("n"))


@query(f"WITH {GRAPH_SQL} SELECT to_id AS id, kind, count(*) :: BIGINT AS n, min(from_id) AS first_from FROM r GROUP BY to_id, kind")
def backlinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fr.backlinks(graph(spark, sf_dir)[1]).groupBy("id", "kind").agg(F.count("*").alias("n"), F.min("from_id").alias("first_from"))


@query("""WITH a AS (SELECT 'old:' || (c_custkey % 400) AS key, 'customer:' || (c_custkey % 800) AS canonical FROM customer), g AS (SELECT key, count(DISTINCT canonical) AS n, min(canonical) AS one, string_agg(DISTINCT canonical, ',' ORDER BY canonical) AS every FROM a GROUP BY key)
SELECT k.key, CASE WHEN n IS NULL THEN 'missing' WHEN n = 1 THEN 'resolved' ELSE 'ambiguous' END AS status, CASE WHEN n = 1 THEN one END AS canonical_id, every AS canonical_ids FROM (SELECT 'old:' || range AS key FROM range(500)) k LEFT JOIN g USING (key)""")
def alias_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    aliases = c.select(text("c_custkey").alias("id"), F.concat(F.lit("customer:"), (F.col("c_custkey") % 800).cast("string")).alias("canonical_id"), F.array(F.concat(F.lit("old:"), (F.col("c_custkey") % 400).cast("string"))).alias("previous_ids"), F.array(cite(F.lit("c"), text("c_custkey"))).alias("source_refs"))
    keys = spark.range(500).select(F.lit("id").alias("key_type"), F.concat(F.lit("old:"), text("id")).alias("key"))
    return rv.resolve_aliases(keys, rv.alias_index(aliases)).drop("key_type")


@query(f"""WITH {GRAPH_SQL}, g AS (SELECT 'nation:' || n AS id, CASE WHEN n % 2 = 0 THEN 'nation:' || (n + 1) END AS other FROM (VALUES (0), (2), (5), (6)) v(n))
SELECT r.from_id, r.kind, coalesce(other, to_id) AS to_id FROM r LEFT JOIN g ON r.to_id = g.id WHERE r.from_id NOT IN (SELECT id FROM g) AND (g.id IS NULL OR other IS NOT NULL)""")
def suppress_retarget(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries, relations = graph(spark, sf_dir)
    plan = spark.createDataFrame([("nation:0", "nation:1"), ("nation:2", "nation:3"), ("nation:5", None), ("nation:6", "nation:7")], "id string, replacement string")
    return rv.suppress(entries, relations, plan)[1].drop("citations")


@query(f"""WITH {GRAPH_SQL}, m AS (SELECT * FROM (VALUES ('supplier:1', 'One', 'supplier', '"x"'), ('supplier:2', NULL, 'supplier', '"z"'), ('supplier:3', 'Three', 'vendor', NULL)) v(id, name, kind, note))
SELECT e.id, coalesce(m.kind, e.kind) AS kind, coalesce(m.name, e.name) AS name, note, (SELECT string_agg(CASE WHEN to_id = 'nation:0' THEN 'nation:1' ELSE to_id END, ',') FROM r WHERE from_id = e.id) AS targets
FROM e LEFT JOIN m USING (id) WHERE e.kind = 'supplier' AND e.id <> 'supplier:4'""")
def revision_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patches, a suppression and a chain of them, in order of revision id."""
    entries, relations = graph(spark, sf_dir)
    row = lambda id_, target, patch: {"id": id_, "source": "q", "target_kind": "entry", "target_id": target, "target": None, "rationale": "r", "evidence": None, "patch": json.dumps(patch)}
    shadow = lambda to: {"suppress": True, "review": {"decision": "source_shadow", "canonicalEntryId": to}}
    revisions = [
        row("r3", "supplier:3", {"name": "Three", "kind": "vendor"}), row("r1", "supplier:1", {"name": "One", "attributes": {"note": "x"}}), row("r2", "supplier:2", {"attributes": {"note": "y"}}),
        row("r4", "supplier:2", {"attributes": {"note": "z"}}), row("r5", "supplier:4", {"suppress": True}), row("r6", "nation:0", shadow("nation:1")), row("r7", "nowhere", {"name": "x"}),
    ]
    after, edges = rp.apply(entries, relations, rp.replay(spark.createDataFrame(revisions, REVISION), entries))
    targets = edges.groupBy(F.col("from_id").alias("id")).agg(F.array_join(F.array_sort(F.collect_list("to_id")), ",").alias("targets"))
    suppliers = after.where("kind IN ('supplier', 'vendor')")
    return suppliers.join(targets, "id", "left").select("id", "kind", "name", F.try_element_at("attributes", F.lit("note")).alias("note"), "targets")


@query("""WITH c AS (SELECT c_custkey AS k, c_custkey % 9 AS m FROM customer), o AS (SELECT o_custkey AS k, o_orderkey AS o, o_orderstatus AS s FROM orders), l AS (SELECT k, arg_max(s, o) AS status FROM o GROUP BY k),
e AS (SELECT CASE WHEN k % 9 BETWEEN 1 AND 4 THEN k - k % 9 + 5 ELSE k END AS k, count(*) :: BIGINT AS n FROM o GROUP BY 1)
SELECT 'customer:' || k AS id, CASE WHEN m = 5 THEN 'account' WHEN m = 0 AND k + 6 NOT IN (SELECT k FROM c) THEN 'merged' ELSE 'customer' END AS kind, status, coalesce(n, 0) AS orders
FROM c LEFT JOIN l USING (k) LEFT JOIN e USING (k) WHERE m NOT BETWEEN 1 AND 4""")
def revision_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A revision an order, which patches its customer; others give kinds, name two customers at once (which is a conflict) or suppress
    runs of four customers, each for the next, whose orders end at the fifth."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    k, m = F.col("c_custkey"), F.col("c_custkey") % 9
    customer = lambda key: F.concat(F.lit("customer:"), key.cast("string"))
    entries = c.select(customer(k).alias("id"), F.lit("organization").alias("family"), F.lit("customer").alias("kind"), F.col("c_name").alias("name"), attributes(x=F.lit("1")).alias("attributes"), no_citations().alias("citations"))
    relations = o.select(F.concat(F.lit("order:"), text("o_orderkey")).alias("from_id"), F.lit("placed_by").alias("kind"), customer(F.col("o_custkey")).alias("to_id"), no_citations().alias("citations"))
    target = spark.createDataFrame([], REVISION).schema["target"].dataType.simpleString()
    none = F.lit(None).cast(target)
    revision = lambda rows, id_, key, to, patch: rows.select(id_.alias("id"), F.lit("q").alias("source"), F.lit("entry").alias("target_kind"), customer(key).alias("target_id"), to.alias("target"), F.lit("r").alias("rationale"), no_citations().alias("evidence"), patch.alias("patch"))
    named = lambda first: F.concat(F.lit(first), F.lpad(k.cast("string"), 12, "0"))
    shadow = F.concat(F.lit('{"suppress":true,"review":{"decision":"source_shadow","canonicalEntryId":"customer:'), (k + 1).cast("string"), F.lit('"}}'))
    both = F.struct(F.lit(None).cast("string").alias("canonical_id"), F.array(customer(k + 6)).alias("previous_ids"), no_citations().alias("source_refs"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("name"))
    revisions = [
        revision(o, F.lpad(text("o_orderkey"), 12, "0"), F.col("o_custkey"), none, F.concat(F.lit('{"attributes":{"status":"'), "o_orderstatus", F.lit('"}}'))),
        revision(c.where(m == 5), named("k"), k, none, F.lit('{"kind":"account"}')),
        revision(c.where(m == 0), named("m"), k, both, F.lit('{"kind":"merged"}')),
        revision(c.where(m.between(1, 4)), named("s"), k, none, shadow),
    ]
    every = reduce(DataFrame.unionByName, revisions)
    after, edges = rp.apply(entries, relations, rp.replay(every, entries))
    counts = edges.groupBy(F.col("to_id").alias("id")).agg(F.count("*").alias("orders"))
    return after.join(counts, "id", "left").select("id", "kind", F.regexp_replace(F.try_element_at("attributes", F.lit("status")), '"', "").alias("status"), F.coalesce("orders", F.lit(0)).alias("orders"))


def named_entries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parts as entries with names that collide; some have relations."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    parts = p.select(F.concat(F.lit("part:"), text("p_partkey")).alias("id"), F.lit("thing").alias("family"), F.when(k % 5 == 0, "item").otherwise("part").alias("kind"), F.concat(F.col("p_name"), F.when(k % 2 == 0, " & Co").otherwise("!"), (k % 40).cast("string")).alias("name"), attributes(x=F.lit("1")).alias("attributes"), F.array(cite(F.when(k % 3 == 0, "a.parts").otherwise("b.parts"), text("p_partkey"))).alias("citations"))
    edges = p.where("p_partkey % 4 = 1").select(F.concat(F.lit("part:"), text("p_partkey")).alias("from_id"), F.lit("made_by").alias("kind"), F.lit("x").alias("to_id"), no_citations().alias("citations"))
    return parts, edges


CANDIDATE_SQL = """
p AS (SELECT 'part:' || p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN 'item' ELSE 'part' END AS kind, CASE WHEN p_partkey % 3 = 0 THEN 'a.parts' ELSE 'b.parts' END AS source, p_partkey % 4 = 1 AS related,
  trim(regexp_replace(replace(lower(p_name || CASE WHEN p_partkey % 2 = 0 THEN ' & Co' ELSE '!' END || (p_partkey % 40)), '&', ' and '), '[^a-z0-9]+', ' ', 'g')) AS key FROM part),
g AS (SELECT key, count(*) AS n, count(DISTINCT kind) AS kinds, count(DISTINCT source) AS sources, bool_or(related) AS related FROM p GROUP BY key HAVING count(*) > 1),
c AS (SELECT 'same_normalized_name:' || regexp_replace(key, '[^a-z0-9]+', '-', 'g') AS id, key AS match_key, n, CASE WHEN kinds > 1 OR (sources > 1 AND related) THEN 'high' WHEN sources > 1 THEN 'medium' ELSE 'low' END AS severity,
  CASE WHEN kinds > 1 THEN 'kind_conflict' WHEN sources > 1 THEN 'source_shadow' ELSE 'same_source_duplicate' END AS review_category,
  concat_ws(',', CASE WHEN sources > 1 THEN 'cross_source_shadow' END, CASE WHEN kinds > 1 THEN 'kind_conflict' END, CASE WHEN related THEN 'relation_review_needed' END, CASE WHEN sources = 1 THEN 'same_source_duplicate' END) AS risks, sources, kinds FROM g)
"""


def part_packets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return ca.find_candidates(*named_entries(spark, sf_dir))


@query(f"WITH {CANDIDATE_SQL} SELECT id, match_key, n :: BIGINT AS n, severity, 'high' AS confidence, review_category, risks FROM c")
def candidates_same_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_packets(spark, sf_dir)[0].where("reason = 'same_normalized_name'").select("id", "match_key", "n", "severity", "confidence", "review_category", F.array_join("risks", ",").alias("risks"))


@query("""WITH p AS (SELECT 'page:' || page_id AS id, lower(regexp_replace(regexp_replace(trim(url), '[?#].*$', ''), '/+$', '')) AS key, page_id FROM pages WHERE url IS NOT NULL),
h AS (SELECT *, 'http://' || regexp_extract(key, '^[a-z]+://([^/]+)', 1) || '/' AS home FROM p), u AS (SELECT DISTINCT id, page_id, unnest([key, regexp_replace(home, '/+$', '')]) AS k FROM h),
g AS (SELECT k, count(*) AS n, count(DISTINCT CASE WHEN page_id % 2 = 0 THEN 'even' ELSE 'odd' END) AS kinds FROM u GROUP BY k HAVING count(*) > 1)
SELECT k AS match_key, n :: BIGINT AS n, CASE WHEN kinds > 1 THEN 'high' ELSE 'low' END AS severity, CASE WHEN kinds > 1 THEN 'kind_conflict' ELSE 'same_source_duplicate' END AS review_category FROM g WHERE NOT (kinds = 1 AND n > 2)""")
def candidates_shared_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages share their own URL and, in an attribute, their host's."""
    k = F.col("page_id")
    home = F.concat(F.lit("http://"), F.lower(F.regexp_extract("url", r"^[A-Za-z]+://([^/?#]+)", 1)), F.lit("/"))
    pages = table(spark, sf_dir, "pages").where("url IS NOT NULL").select(F.concat(F.lit("page:"), text("page_id")).alias("id"), F.lit("web").alias("family"), F.when(k % 2 == 0, "even").otherwise("odd").alias("kind"), F.lit("").alias("name"), attributes(home=json_text(home)).alias("attributes"), F.array(cite(F.lit("crawl"), text("page_id"), url=F.col("url"))).alias("citations"))
    none = spark.createDataFrame([], f"from_id string, kind string, to_id string, citations {pages.schema['citations'].dataType.simpleString()}")
    return ca.find_candidates(pages, none)[0].select("match_key", "n", "severity", "review_category")


@query("""WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'item' ELSE 'part' END AS kind, CASE WHEN p_partkey % 3 = 0 THEN 'a' ELSE 'b' END AS source, 'D.C. Code § 1-' || p_size AS key FROM part)
SELECT key AS match_key, count(*) :: BIGINT AS n, CASE WHEN count(DISTINCT kind) > 1 THEN 'high' ELSE 'medium' END AS severity, CASE WHEN count(DISTINCT kind) > 1 THEN 'kind_conflict' WHEN count(DISTINCT source) > 1 THEN 'source_shadow' ELSE 'same_source_duplicate' END AS review_category, string_agg(DISTINCT source, ',' ORDER BY source) AS families
FROM p GROUP BY key HAVING count(*) > 1""")
def candidates_shared_locator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that cite one section, spelt with other blanks."""
    k = F.col("p_partkey")
    source = F.when(k % 3 == 0, "a.parts").otherwise("b.parts")
    locator = F.concat(F.lit("D.C."), F.when(k % 2 == 0, "  ").otherwise(" "), F.lit("Code § 1-"), text("p_size"), F.when(k % 2 == 0, " ").otherwise(""))
    parts = table(spark, sf_dir, "part").select(F.concat(F.lit("part:"), text("p_partkey")).alias("id"), F.lit("thing").alias("family"), F.when(k % 5 == 0, "item").otherwise("part").alias("kind"), F.lit("").alias("name"), attributes(x=F.lit("1")).alias("attributes"), F.array(cite(source, text("p_partkey"), locator)).alias("citations"))
    none = spark.createDataFrame([], f"from_id string, kind string, to_id string, citations {parts.schema['citations'].dataType.simpleString()}")
    found = ca.find_candidates(parts, none)[0].where("reason = 'shared_legal_locator'")
    return found.select("match_key", "n", "severity", "review_category", F.array_join("source_families", ",").alias("families"))


@query("""WITH g AS (SELECT n_nationkey AS k, count(s_suppkey) AS boards FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1)
SELECT 'https://law.example/' || k AS match_key, (boards + 1) :: BIGINT AS n, 'high' AS severity, 'cross_source_shadow,family_conflict,kind_conflict' || CASE WHEN k % 3 = 1 THEN ',relation_review_needed' ELSE '' END AS risks FROM g WHERE boards > 0 AND k % 3 <> 0""")
def candidates_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laws and the boards on their page: noise where the law authorises every board, candidates where it authorises some or none."""
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    url = lambda k: F.concat(F.lit("https://law.example/"), text(k))
    made = lambda df, key, kind, family, link: df.select(F.concat(F.lit(f"{kind}:"), text(key)).alias("id"), F.lit(family).alias("family"), F.lit(kind).alias("kind"), F.lit("").alias("name"), attributes(webUrl=json_text(url(link))).alias("attributes"), F.array(cite(F.lit(kind), text(key))).alias("citations"))
    entries = made(n, "n_nationkey", "legal_authority", "authority", "n_nationkey").unionByName(made(s, "s_suppkey", "board", "organization", "s_nationkey"))
    law = F.concat(F.lit("legal_authority:"), text("s_nationkey"))
    k = F.col("s_nationkey") % 3
    edges = s.select(F.concat(F.lit("board:"), text("s_suppkey")).alias("from_id"), F.when(k == 0, "relation:authorized_by").when(k == 1, "relation:governs").alias("kind"), law.alias("to_id"), no_citations().alias("citations")).where("kind IS NOT NULL")
    return ca.find_candidates(entries, edges)[0].where("reason = 'shared_url'").select("match_key", "n", "severity", F.array_join("risks", ",").alias("risks"))


@query("""WITH d AS (SELECT doc_id, trim(regexp_replace(replace(lower(text), '&', ' and '), '[^a-z0-9]+', ' ', 'g')) AS k, source IN ('src0', 'src1', 'src2', 'src3', 'src4') AS good FROM documents), g AS (SELECT k FROM d WHERE k <> '' GROUP BY k HAVING count(*) > 1 AND bool_or(good))
SELECT doc_id, k IN (SELECT k FROM g) AND NOT good AS stale FROM d""")
def stale_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2(normalize_name(F.col("text")), 256).alias("key"), "source")
    good = F.col("source").isin("src0", "src1", "src2", "src3", "src4")
    return ca.stale_duplicates(docs, F.col("key"), good).select("doc_id", "stale")


@query("""WITH d AS (SELECT 'slug-' || (p_partkey // 2) AS slug, trim(regexp_replace(replace(lower(p_name), '&', ' and '), '[^a-z0-9]+', ' ', 'g')) AS name FROM part)
SELECT name, count(DISTINCT slug) :: BIGINT AS n, string_agg(DISTINCT slug, '; ' ORDER BY slug) AS slugs FROM d WHERE name <> '' GROUP BY name HAVING count(DISTINCT slug) > 1""")
def duplicate_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts that several slugs share; one is that of two parts each."""
    p = table(spark, sf_dir, "part")
    return ca.duplicate_slugs(p, normalize_name(F.col("p_name")), F.concat(F.lit("slug-"), F.floor(F.col("p_partkey") / 2).cast("string")), most=5)


@query(f"WITH {CANDIDATE_SQL} SELECT id, match_key, (SELECT count(*) FROM c) :: BIGINT AS candidate_count FROM c ORDER BY match_key LIMIT 20")
def topk_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 20 packets and the number of all."""
    found = part_packets(spark, sf_dir)[0].where("reason = 'same_normalized_name'")
    return ca.top_packets(found, 20).select("id", "match_key", "candidate_count")


@query("""WITH i AS (SELECT o_orderkey AS item, o_custkey AS c FROM orders), v AS (SELECT c_custkey AS rev, c_custkey AS target, c_custkey + 1 AS related FROM customer)
SELECT DISTINCT 'item:' || item AS item_id, 'rev:' || rev AS revision_id FROM i JOIN v ON i.c = v.target OR i.c = v.related OR i.item = v.rev""")
def item_revision_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and revisions that share an id or a citation: an equi-join in place of a theta join."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    items = o.select(F.concat(F.lit("item:"), text("o_orderkey")).alias("item_id"), F.array(text("o_custkey")).alias("ids"), F.array(cite(F.lit("k"), text("o_orderkey"))).alias("citations"))
    revisions = c.select(F.concat(F.lit("rev:"), text("c_custkey")).alias("revision_id"), F.array(text("c_custkey"), (F.col("c_custkey") + 1).cast("string")).alias("ids"), F.array(cite(F.lit("k"), text("c_custkey"))).alias("citations"))
    return rv.item_revisions(items, revisions)
