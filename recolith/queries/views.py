"""Queries of review items, projections, coverage and verification."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..model import REVISION
from ..operators import coverage as co
from ..operators import fragments as fr
from ..operators import graph as gr
from ..operators import review as re_
from ..plans.review import Review, generate, posture
from ..stages import fresh_path
from ..streaming.collect import event_counts
from .common import GRAPH_SQL, graph, registry, table, text
from .entities import CANDIDATE_SQL, DECISION_SQL, checked_relations, document_decisions, named_entries, part_packets

QUERIES, ORACLE_SQL, query = registry()

ITEM_SQL = f"""{CANDIDATE_SQL}, {DECISION_SQL},
i AS (SELECT id, CASE WHEN kinds > 1 THEN 'kind_conflict' ELSE review_category END AS category, 'curation_conflict' AS classification, severity, 'reconciliation_candidate' AS source_type, n AS n_entries, severity = 'high' AS release, false AS state, NULL AS code FROM c
  UNION ALL SELECT 'finding:' || rid, 'out_of_scope_candidate', 'out_of_scope', CASE WHEN action = 'conflict' THEN 'high' ELSE 'medium' END, 'finding', 0, false, action = 'conflict', 'promotion.' || action FROM d WHERE action <> 'promote'),
q AS (SELECT *, CASE WHEN state OR (release AND n_entries > 0) THEN 'blocking' WHEN classification = 'out_of_scope' THEN 'deferred' ELSE 'actionable' END AS queue FROM i)
"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = part_packets(spark, sf_dir)[0].where("reason = 'same_normalized_name'")
    return re_.from_candidates(packets).unionByName(re_.from_findings(fr.promotion_findings(document_decisions(spark, sf_dir))))


@query(f"WITH {ITEM_SQL} SELECT category, classification, severity, source_type, queue, count(*) :: BIGINT AS n FROM q GROUP BY ALL")
def review_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = items(spark, sf_dir).withColumn("queue", re_.queue())
    return rows.groupBy("category", "classification", "severity", "source_type", "queue").agg(F.count("*").alias("n"))


@query(f"WITH {ITEM_SQL} SELECT v.queue, count(q.id) :: BIGINT AS n FROM (VALUES ('blocking'), ('actionable'), ('drafted'), ('applied'), ('deferred')) v(queue) LEFT JOIN q ON q.queue = v.queue GROUP BY v.queue")
def review_queues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return re_.queue_counts(items(spark, sf_dir))


@query(f"""WITH {DECISION_SQL}, f AS (SELECT action, 'finding:promotion-' || replace(action, '_', '-') || ':fragment-' || replace(id, ':', '-') || '-of-' || source || '-has-decision-' || replace(action, '_', '-') || ':source-' || source || '-' || rid AS item FROM d WHERE action NOT IN ('promote', 'conflict'))
SELECT 'out_of_scope_candidate' AS category, 'promotion.' || action AS label, count(*) :: BIGINT AS n, rtrim(min(item || '-'), '-') AS sample FROM f GROUP BY action""")
def deferred_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the first item of each group, whose id is shown without the hash at its end."""
    return re_.deferred_groups(items(spark, sf_dir)).select("category", "label", "n", F.regexp_replace("sample_id", "-[0-9a-z]+$", "").alias("sample"))


REVIEW_SQL = f"""{CANDIDATE_SQL},
o AS (SELECT o_orderkey AS k, o_orderkey % 11 AS f, o_custkey AS t, o_orderstatus AS s FROM orders),
w AS (SELECT *, CASE WHEN f = 3 THEN 'source_missing' WHEN f = 4 THEN 'source_not_promoted' WHEN t % 14 = 0 THEN 'target_not_promoted' WHEN t % 7 = 0 OR t NOT IN (SELECT c_custkey FROM customer) THEN 'target_missing' ELSE 'keep' END AS status FROM o),
f AS (SELECT DISTINCT status, s, CASE WHEN status LIKE 'source%' THEN 'part:' || f ELSE 'customer:' || t END AS ending, CASE WHEN status LIKE '%missing' THEN NULL ELSE k END AS cited FROM w WHERE status <> 'keep'),
h AS (SELECT key, bool_or(id IN ('part:1', 'part:2', 'part:7')) AS named FROM p GROUP BY key),
i AS (SELECT CASE WHEN kinds > 1 THEN 'kind_conflict' ELSE review_category END AS category, 'curation_conflict' AS classification, severity, 'reconciliation_candidate' AS source_type, CASE WHEN named THEN 'applied' ELSE 'open' END AS status, CASE WHEN named THEN 'applied' WHEN severity = 'high' THEN 'blocking' ELSE 'actionable' END AS queue FROM c JOIN h ON h.key = c.match_key
  UNION ALL SELECT CASE WHEN status LIKE '%missing' THEN 'relation_endpoint_missing' ELSE 'out_of_scope_candidate' END, CASE WHEN status LIKE '%missing' THEN 'compiler_rule_bug' ELSE 'out_of_scope' END, CASE WHEN status LIKE '%missing' THEN 'high' ELSE 'medium' END, 'finding', 'open', CASE WHEN status LIKE '%missing' THEN 'blocking' ELSE 'deferred' END FROM f
  UNION ALL SELECT * FROM (VALUES ('source_shadow', 'curation_conflict', 'high', 'tracked_revision', 'applied', 'applied'), ('preserve_distinct_candidate', 'curation_conflict', 'medium', 'tracked_revision', 'applied', 'applied')) v)
"""


def generated(spark: SparkSession, sf_dir: str) -> Review:
    """Parts as entries with candidates, findings of relations that lead nowhere, and two tracked revisions."""
    entries, relations = named_entries(spark, sf_dir)
    row = lambda id_, target, patch: {"id": id_, "source": "q", "target_kind": "entry", "target_id": target, "target": None, "rationale": "r", "evidence": None, "patch": json.dumps(patch)}
    tracked = spark.createDataFrame([row("r1", "part:1", {"suppress": True}), row("r2", "part:2", {"review": {"decision": "preserve_distinct", "relatedEntryIds": ["part:7"]}})], REVISION)
    return generate(entries, relations, fr.relation_findings(checked_relations(spark, sf_dir)), tracked)


@query(f"WITH {REVIEW_SQL} SELECT category, classification, severity, source_type, status, queue, count(*) :: BIGINT AS n FROM i GROUP BY ALL")
def review_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = generated(spark, sf_dir).items.withColumn("queue", re_.queue())
    return rows.groupBy("category", "classification", "severity", "source_type", "status", "queue").agg(F.count("*").alias("n"))


@query(f"""WITH {REVIEW_SQL} SELECT 'queue' AS section, v.x AS label, count(queue) :: BIGINT AS n FROM (VALUES ('blocking'), ('actionable'), ('drafted'), ('applied'), ('deferred')) v(x) LEFT JOIN i ON queue = v.x GROUP BY v.x
UNION ALL SELECT 'status', v.x, count(status) :: BIGINT FROM (VALUES ('open'), ('drafted'), ('applied')) v(x) LEFT JOIN i ON status = v.x GROUP BY v.x UNION ALL SELECT 'category', category, count(*) :: BIGINT FROM i GROUP BY category""")
def review_posture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posture(generated(spark, sf_dir))


@query(f"WITH {ITEM_SQL} SELECT id, category FROM q WHERE queue = 'blocking' AND source_type = 'reconciliation_candidate' ORDER BY category, id LIMIT 1")
def next_review_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of candidates: the first that blocks, by severity, status, category and id."""
    return re_.next_item(items(spark, sf_dir).where("source_type = 'reconciliation_candidate'")).select("id", "category")


CATEGORIES = {"region": "place", "nation": "place", "customer": "organisation"}
VERBS = {"part_of": gr.Verb("part_of"), "located_in": gr.Verb("based_in", ("customer",), ("nation",))}
NODE_SQL = """
n AS (SELECT id, split_part(id, ':', 2) AS slug, name, CASE kind WHEN 'customer' THEN 'organisation' ELSE 'place' END AS category, kind, family FROM e WHERE kind <> 'supplier' AND id <> 'nation:7'),
g AS (SELECT from_id, CASE kind WHEN 'part_of' THEN 'part_of' ELSE 'based_in' END AS verb, to_id, kind AS relation_kind FROM r WHERE from_id IN (SELECT id FROM n) AND to_id IN (SELECT id FROM n))
"""


def excluded(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("nation:7",)], "id string")


def projection(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    entries, relations = graph(spark, sf_dir)
    rows = gr.nodes(entries, CATEGORIES, excluded(spark))
    return rows, gr.edges(relations, rows, VERBS)


@query(f"WITH {GRAPH_SQL}, {NODE_SQL} SELECT * FROM n")
def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection(spark, sf_dir)[0]


@query(f"WITH {GRAPH_SQL}, {NODE_SQL} SELECT * FROM g")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection(spark, sf_dir)[1]


@query(f"""WITH {GRAPH_SQL}, {NODE_SQL} SELECT 'node_category' AS section, category AS label, count(*) :: BIGINT AS n FROM n GROUP BY category UNION ALL SELECT 'edge_verb', verb, count(*) :: BIGINT FROM g GROUP BY verb
UNION ALL SELECT 'mapped_relation', relation_kind || '>' || verb, count(*) :: BIGINT FROM g WHERE relation_kind <> verb GROUP BY 2""")
def graph_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.summary(*projection(spark, sf_dir))


@query(f"WITH {GRAPH_SQL}, {NODE_SQL} SELECT from_id, kind, to_id FROM r WHERE (from_id IN (SELECT id FROM n) OR from_id = 'nation:7') AND NOT (from_id IN (SELECT id FROM n) AND to_id IN (SELECT id FROM n))")
def graph_excluded_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries, relations = graph(spark, sf_dir)
    return gr.excluded_edges(relations, gr.nodes(entries, CATEGORIES, excluded(spark)), excluded(spark))


@query(f"WITH {GRAPH_SQL} SELECT e.id, e.name, r.to_id AS parent_id FROM e LEFT JOIN r ON e.id = r.from_id")
def denorm_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries, relations = graph(spark, sf_dir)
    return gr.first_parent(entries, relations, ("part_of", "located_in")).select("id", "name", "parent_id")


@query(f"WITH {GRAPH_SQL} SELECT e.id, CASE WHEN r.kind = 'located_in' THEN r.to_id END AS nation_id FROM e LEFT JOIN r ON e.id = r.from_id")
def denorm_first_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries, relations = graph(spark, sf_dir)
    return gr.first_of_kind(entries, relations, "located_in", "nation", "nation_id").select("id", "nation_id")


@query(f"""WITH {GRAPH_SQL} SELECT r.to_id AS id, count(*) :: BIGINT AS n, string_agg(e.id, '; ' ORDER BY e.name, e.id) AS ids, string_agg(e.name, '; ' ORDER BY e.name, e.id) AS names FROM r JOIN e ON r.from_id = e.id WHERE r.kind = 'part_of' GROUP BY r.to_id""")
def denorm_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries, relations = graph(spark, sf_dir)
    return gr.related_list(relations, entries, "part_of", incoming=True)


@query("""SELECT l_suppkey, count(DISTINCT l_partkey) :: BIGINT AS members, string_agg(DISTINCT l_returnflag, '; ' ORDER BY l_returnflag) AS names FROM lineitem GROUP BY l_suppkey""")
def denorm_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.distinct_summary(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_partkey", "l_returnflag")


@query(f"""WITH {GRAPH_SQL} SELECT n.to_id AS top_id, n.from_id AS middle_id, max(s.from_id) AS seat_id FROM r n LEFT JOIN r s ON s.to_id = n.from_id AND s.from_id LIKE 'supplier:%' WHERE n.kind = 'part_of' GROUP BY ALL""")
def chain_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions to nations, and to the last supplier of each."""
    entries, relations = graph(spark, sf_dir)
    turned = relations.select(F.when(F.col("kind") == "part_of", F.col("to_id")).otherwise(F.col("from_id")).alias("from_id"), "kind", F.when(F.col("kind") == "part_of", F.col("from_id")).otherwise(F.col("to_id")).alias("to_id"))
    return gr.chain(entries, turned, ("part_of", "nation"), ("located_in", "supplier"), "region")


@query("""SELECT o_custkey, o_orderstatus, arg_max(role, CASE role WHEN 'chair' THEN 2 ELSE 1 END) AS role FROM (SELECT o_custkey, o_orderstatus, CASE WHEN o_orderpriority LIKE '1%' THEN 'chair' ELSE 'member' END AS role FROM orders) GROUP BY ALL""")
def role_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", F.when(F.col("o_orderpriority").startswith("1"), "chair").otherwise("member").alias("role"))
    return gr.role_override(rows, ["o_custkey", "o_orderstatus"], "role", ("member", "chair"))


COVERAGE_SQL = """
k AS (SELECT 'src' || range AS source, 'family' || (range % 3) AS family, range % 5 = 0 AS inventory FROM range(3, 25)),
o AS (SELECT source, count(DISTINCT lang) AS snapshots, count(*) AS records, count_if(source <> 'src4' AND source <> 'src8') AS citations FROM documents WHERE source <> 'src5' GROUP BY source),
v AS (SELECT source, coalesce(family, 'unclassified') AS family, family IS NOT NULL AS cataloged, coalesce(snapshots, 0) :: BIGINT AS snapshots, coalesce(records, 0) :: BIGINT AS records, coalesce(citations, 0) :: BIGINT AS citations,
  CASE WHEN coalesce(snapshots, 0) = 0 THEN 'not_collected' WHEN coalesce(records, 0) = 0 THEN 'collected_empty' ELSE 'collected' END AS collection_status,
  CASE WHEN coalesce(inventory, false) THEN 'inventory_only' WHEN coalesce(citations, 0) > 0 THEN 'exported' WHEN coalesce(records, 0) > 0 THEN 'collected_not_exported' WHEN coalesce(snapshots, 0) > 0 THEN 'collected_empty' ELSE 'not_collected' END AS release_status
  FROM k FULL JOIN o USING (source))
"""


def source_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("id")
    catalog = spark.range(3, 25).select(F.concat(F.lit("src"), text("id")).alias("source"), F.concat(F.lit("family"), (n % 3).cast("string")).alias("family"), (n % 5 == 0).alias("inventory"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang").where("source <> 'src5'")
    cited = docs.where("source NOT IN ('src4', 'src8')").select(F.array(F.struct("source")).alias("citations"))
    return co.coverage(catalog, docs.groupBy("source").agg(F.count_distinct("lang").alias("n")), docs.groupBy("source").agg(F.count("*").alias("n")), co.citation_counts(cited))


@query(f"WITH {COVERAGE_SQL} SELECT * FROM v")
def coverage_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_coverage(spark, sf_dir)


@query(f"""WITH {COVERAGE_SQL}, s AS (SELECT family, 'collection' AS status_kind, collection_status AS status FROM v UNION ALL SELECT family, 'release', release_status FROM v)
SELECT family, status_kind, status, count(*) :: BIGINT AS n, (SELECT count(*) FROM v WHERE v.family = s.family) :: BIGINT AS family_rows FROM s GROUP BY ALL""")
def family_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return co.family_rollup(source_coverage(spark, sf_dir))


@query("""SELECT v.event_type, count(e.event_id) :: BIGINT AS n FROM (SELECT DISTINCT event_type FROM events UNION SELECT 'never') v LEFT JOIN events e ON e.event_type = v.event_type GROUP BY v.event_type""")
def zero_filled_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_type")
    kinds = tuple(r["event_type"] for r in rows.distinct().collect())  # a handful of types
    return re_.zero_filled(rows, "event_type", (*kinds, "never"))


@query("""SELECT o_orderstatus AS kind, arg_min(o_orderkey, (o_custkey % 3 <> 0, o_orderkey)) AS from_id, arg_min(o_custkey, (o_custkey % 3 <> 0, o_orderkey)) AS to_id FROM orders GROUP BY 1""")
def relation_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("kind"), F.col("o_orderkey").alias("from_id"), F.col("o_custkey").alias("to_id"))
    return co.relation_examples(rows, F.col("to_id") % 3 == 0, F.col("from_id"))


@query("""WITH n AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1), m AS (SELECT o_orderkey AS k, o_orderkey % 7 AS n FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT -c_custkey, 0 FROM customer)
SELECT k, coalesce(m.n, -1) :: BIGINT AS expected, coalesce(n.n, -1) :: BIGINT AS actual, m.n IS NOT DISTINCT FROM n.n AS ok FROM m FULL JOIN n USING (k)""")
def verify_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted and expected numbers of lines, with what is missing on either side as -1: nothing is said of pending orders, and none of customers' keys is counted."""
    actual = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n"))
    said = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 7).alias("n"))
    expected = said.unionByName(table(spark, sf_dir, "customer").select((-F.col("c_custkey")).alias("k"), F.lit(0).cast("long").alias("n")))
    return co.checks(actual, expected, ["k"], "n").na.fill(-1, ["expected", "actual"])


@query("""SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS "end", event_type, count(*) :: BIGINT AS n FROM events GROUP BY ALL""")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extension: the streamed counts, over the whole table."""
    return event_counts(table(spark, sf_dir, "events"))


@query("""WITH e AS (SELECT *, least(day(ts) // 10, 2) AS batch FROM events)
SELECT user_id, event_type, arg_max(event_id, (batch, ts, event_id)) AS event_id, arg_max(value, (batch, ts, event_id)) AS value FROM e GROUP BY user_id, event_type""")
def upsert_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three batches, by days, kept in a bucketed table: the last event of each user and type."""
    events = table(spark, sf_dir, "events")
    batch = F.least(F.floor(F.day("ts") / 10), F.lit(2))
    path = fresh_path(spark, "upserts")
    for i in range(3):
        sinks.upsert(events.where(batch == i).select("user_id", "event_type", "ts", "event_id", "value"), path, ["user_id", "event_type"], buckets=16)
    return sinks.read_table(spark, path).select("user_id", "event_type", "event_id", "value")


@query("""SELECT o_orderstatus AS status, count(*) :: BIGINT AS n, md5(string_agg(o_orderpriority || '/' || o_orderkey, '; ' ORDER BY o_orderpriority || '/' || o_orderkey)) AS digest FROM orders GROUP BY o_orderstatus""")
def hub_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of a status in one cell: hubs, whose lists are made in chunks."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.concat("o_orderpriority", F.lit("/"), text("o_orderkey")).alias("name"))
    return gr.listed(rows, "status", ["name"], ["name"], most=500).select("status", "n", F.md5("name").alias("digest"))
