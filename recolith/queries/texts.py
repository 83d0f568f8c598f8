"""Queries of HTML, URL, name, description and JSON functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import url as ur
from ..functions import values as va
from ..operators import windows as wi
from ..sources import html as ht
from .common import registry, table

QUERIES, ORACLE_SQL, query = registry()

LINK_SQL = r"""
l AS (SELECT page_id, t, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*"[^"]*"[^>]*>.*?</a>')) AS t, generate_subscripts(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*"[^"]*"[^>]*>.*?</a>'), 1) AS i FROM pages)),
a AS (SELECT page_id, pos :: INT AS pos, regexp_extract(t, '(?is)\bhref\s*=\s*"([^"]*)"', 1) AS href, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(t, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM l)
"""


@query(f"WITH {LINK_SQL} SELECT page_id, pos, href, text FROM a")
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ht.links(table(spark, sf_dir, "pages"), "page_id")


@query(f"WITH {LINK_SQL} SELECT page_id, lower(text) AS key, arg_min(href, pos) AS href, min(pos) AS pos FROM a WHERE length(text) > 3 GROUP BY page_id, lower(text)")
def html_first_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of more than three characters, the first of each text on a page."""
    return ht.first_links(table(spark, sf_dir, "pages"), "page_id", F.length("text") > 3, F.lower("text")).select("page_id", "key", "href", "pos")


CLEAN = "trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace({}, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), '\\s+', ' ', 'g'))"


@query(f"""SELECT page_id, nullif({CLEAN.format("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")}, '') AS title, nullif({CLEAN.format("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")}, '') AS heading,
  list_filter(list_transform(regexp_extract_all(html, '(?is)<p(?:\\s[^>]*)?>(.*?)</p>', 1), lambda x: {CLEAN.format('x')}), lambda x: x <> '')[1] AS summary FROM pages""")
def html_title_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ht.page_facts(table(spark, sf_dir, "pages"), "page_id")


@query(f"""WITH u AS (SELECT page_id, unnest(x) AS box, generate_subscripts(x, 1) AS list FROM (SELECT page_id, regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', '', 'g'), '(?is)<[uo]l\\b[^>]*>(.*?)</[uo]l>', 1) AS x FROM pages)),
i AS (SELECT page_id, list, unnest(y) AS li, generate_subscripts(y, 1) AS item FROM (SELECT page_id, list, regexp_extract_all(box, '(?is)<li\\b[^>]*>(.*?)</li>', 1) AS y FROM u))
SELECT page_id, list :: INT AS list, item :: BIGINT AS item, 1 :: BIGINT AS depth, {CLEAN.format("li")} AS text FROM i""")
def html_list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the lists of pages, by list and place; none of these stands in another."""
    items = ht.nested_texts(table(spark, sf_dir, "pages"), "page_id", ht.LIST)
    lists = F.dense_rank().over(Window.partitionBy("page_id").orderBy("box"))
    return items.select("page_id", lists.alias("list"), F.col("l1").alias("item"), "depth", "text")


@query(rf"""WITH t AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<h[1-6][^>]*>.*?</h[1-6]>|<a\b[^>]*>.*?</a>|<footer')) AS t, generate_subscripts(regexp_extract_all(html, '(?is)<h[1-6][^>]*>.*?</h[1-6]>|<a\b[^>]*>.*?</a>|<footer'), 1) AS i FROM pages)
SELECT page_id, count_if(t ILIKE '<a%') :: BIGINT AS n_links, count_if(t ILIKE '<h%') :: BIGINT AS n_headings FROM t WHERE t NOT ILIKE '<footer%' GROUP BY page_id""")
def html_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = r"(?is)<h[1-6][^>]*>.*?</h[1-6]>|<a\b[^>]*>.*?</a>"
    rows = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit(token), F.lit(0))).alias("t"))
    return rows.groupBy("page_id").agg(F.count_if(F.col("t").rlike("(?i)^<a")).alias("n_links"), F.count_if(F.col("t").rlike("(?i)^<h")).alias("n_headings"))


@query(r"""SELECT p_partkey, trim(both '-' from regexp_replace(replace(lower(p_name || ' & ' || p_brand), '&', ' and '), '[^a-z0-9]+', '-', 'g')) AS slug,
  list_reduce(list_prepend(2166136261 :: HUGEINT, list_transform(regexp_extract_all(p_name, '.'), lambda c: ascii(c) :: HUGEINT)), lambda h, c: (xor(h :: BIGINT, c :: BIGINT) :: HUGEINT * 16777619) % 4294967296) :: BIGINT AS fnv FROM part""")
def slug_and_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat_ws(" & ", "p_name", "p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", tx.slugify(name).alias("slug"), F.conv(F.upper(tx.fnv1a_base36(F.col("p_name"))), 36, 10).cast("long").alias("fnv"))


@query(r"""SELECT p_partkey, trim(regexp_replace(replace(lower(trim(p_name || ' Dept & (X)')), '&', ' and '), '[^a-z0-9]+', ' ', 'g')).regexp_replace('\bdept\b', 'department') AS lookup_key,
  regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS name_key, p_name || ' Dept & (X)' AS first_form, p_name || ' Dept &' AS second_form, split_part(p_type, ' ', 1) AS family FROM part""")
def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = F.concat("p_name", F.lit(" Dept & (X)"))
    forms = tx.candidate_names(full)
    return table(spark, sf_dir, "part").select("p_partkey", tx.lookup_key(full).alias("lookup_key"), tx.name_key(F.col("p_name")).alias("name_key"), F.get(forms, 0).alias("first_form"), F.get(forms, 1).alias("second_form"), tx.source_family(F.replace("p_type", F.lit(" "), F.lit("."))).alias("family"))


@query(r"""SELECT page_id, lower(regexp_replace(regexp_replace(trim(url), '[?#].*$', ''), '/+$', '')) AS canonical, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
  len(list_filter(string_split(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '')) :: INT AS n_segments, regexp_matches(url, '^https?://') AS is_http FROM pages""")
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", ur.canonical_url(u).alias("canonical"), ur.host_of(u).alias("host"), F.size(ur.segments(u)).alias("n_segments"), ur.official_url(u).isNotNull().alias("is_http"))


# Sentences without those about contacts, each without its first address and number.
SCRUB_SQL = r"""
k AS (SELECT doc_id, text AS whole, list_filter(string_split(regexp_replace(trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g')), '([.!?]) ', '\1' || chr(1), 'g'), chr(1)), lambda s: NOT (regexp_matches(s, '(?i)\b(?:phone|telephone|fax|correspondence)\b|\b(?:by|via) e-?mail\b|\be-?mail\s*:')
  OR (regexp_matches(s, '(?i)\bfor (?:(?:any|all) )?(?:questions|(?:more|additional|further) information)\b') AND (regexp_matches(s, '(?i)\b(?:contact|e-?mail)\b') OR regexp_matches(s, '\b[0-9]{10}\b|(?:\(?\b[0-9]{3}\)?[-. ]?)?\b[0-9]{3}[-. ]?[0-9]{4}\b'))))) AS parts FROM documents),
s AS (SELECT doc_id, whole, trim(regexp_replace(regexp_replace(array_to_string(list_transform(parts, lambda s: regexp_replace(regexp_replace(s, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', ''), '\b[0-9]{10}\b|(?:\(?\b[0-9]{3}\)?[-. ]?)?\b[0-9]{3}[-. ]?[0-9]{4}\b', '')), ' '), ' {2,}', ' ', 'g'), ' +([.,;!?])', '\1', 'g')) AS text FROM k)
"""


@query(f"WITH {SCRUB_SQL} SELECT doc_id, text FROM s")
def pii_scrub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without sentences about contacts, and without addresses and numbers elsewhere."""
    return table(spark, sf_dir, "documents").select("doc_id", tx.scrub_contacts(F.col("text")).alias("text"))


@query(rf"""WITH {SCRUB_SQL}, p AS (SELECT doc_id, whole, string_split(regexp_replace(trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g')), '([.!?]) ', '\1' || chr(1), 'g'), chr(1)) AS parts FROM s),
l AS (SELECT doc_id, whole, array_to_string(CASE WHEN starts_with(lower(parts[-1]), 'learn more about ') THEN parts[:-2] ELSE parts END, ' ') AS x FROM p)
SELECT doc_id, CASE WHEN NOT regexp_matches(whole, '(?i)^\s*(?:this website requires a browser feature called javascript|point of contact:|public body website:|agency website:|report website problems to:)') AND NOT regexp_matches(x, '(?i)\b(?:phone|fax|email|correspondence)\b') AND length(x) >= 40 THEN x END AS cleaned,
  CASE WHEN length(trim(regexp_replace(whole, '(?i)^(?:https?://\S+|(?:[a-z0-9-]+\.)+[a-z]{{2,}}(?:/\S*)?)\s+', ''))) >= 40 THEN md5(trim(regexp_replace(whole, '(?i)^(?:https?://\S+|(?:[a-z0-9-]+\.)+[a-z]{{2,}}(?:/\S*)?)\s+', ''))) END AS without_url FROM l""")
def description_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", tx.clean_description(t).alias("cleaned"), F.md5(tx.strip_leading_url(t)).alias("without_url"))


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, json_valid(props) AS valid, '{"k":' || json_extract_string(props, '$.k') || '}' AS stable FROM events""")
def json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("props")
    return table(spark, sf_dir, "events").select("event_id", va.json_string(p, "missing", "k").alias("k"), va.is_object(p).alias("valid"), va.stable_json(p).alias("stable"))


@query("""SELECT conv_id, turn, coalesce(last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS user_turn FROM conversations""")
def fill_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last turn of the user, at every turn; -1 before the first."""
    rows = table(spark, sf_dir, "conversations")
    return wi.fill_forward(rows, ["conv_id"], ["turn"], F.when(F.col("role") == "user", F.col("turn")), "user_turn").select("conv_id", "turn", F.coalesce("user_turn", F.lit(-1)).alias("user_turn"))


@query("""SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id, arg_min(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id""")
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return wi.first_per_key(rows, ["user_id"], F.col("ts"), F.col("event_id")).select("user_id", "event_id", "event_type")


@query("""WITH f AS (SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_value FROM events GROUP BY user_id) SELECT user_id, first_value, count(*) :: BIGINT AS n FROM events JOIN f USING (user_id) WHERE event_type <> first_value GROUP BY ALL""")
def first_with_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return wi.differing_later(rows, ["user_id"], "event_type", F.col("ts"), F.col("event_id")).groupBy("user_id", "first_value").agg(F.count("*").alias("n"))


@query("""SELECT o_custkey, (SELECT p.o_orderpriority FROM orders p WHERE p.o_custkey = o.o_custkey ORDER BY length(p.o_orderpriority) DESC, p.o_orderkey LIMIT 1) AS o_orderpriority FROM orders o GROUP BY o_custkey""")
def longest_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wi.longest_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", F.col("o_orderkey"))
