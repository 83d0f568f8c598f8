"""Line dedup by site-relative frequency: a line on too large a share of a host's pages is boilerplate.

Lines are the text between block-level tags and line ends of a page's HTML, without scripts,
styles, comments and inline tags. Pages are cut into lines once (a written table);
what is counted and shuffled are 8-byte hashes of distinct lines, pre-aggregated, so neither a hot host
nor a line that all its pages share is one task's work. (Lines are compared within a host, where 64 bits tell billions of them apart.) A host keeps at most
(lines a page / ratio) boilerplate lines; their hashes, in order, meet the pages by a join on the host, broadcast if
few, else shuffled with hot hosts split by AQE, and each line of a page is looked up by halving: a page of n lines takes n log n steps.
Texts are not shuffled on the first way.

Defined cases: null and empty pages have no lines and an empty text; pages without a
host (null or other urls) share the host ''; a line that a page repeats counts once for it and is dropped every time;
a line that one page alone of its host has is never dropped, so hosts of one page keep everything; on hosts of two or three pages a line that two of
them share goes, as its share demands (of pages that are copies nothing is left, as all they have is found elsewhere); repeated rows are
pages of their own; null ids too. There are no ties. A very long page is one row of its lines in memory. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, column, in_order, materialise

#: What is no text, whole.
HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
#: Tags that end a line.
BLOCK = r"(?i)</?(?:html|head|body|title|meta|link|nav|header|footer|main|article|section|aside|div|p|br|hr|h[1-6]|ul|ol|li|dl|dt|dd|table|thead|tbody|tr|td|th|form|pre|blockquote|figure)\b[^>]*>|<!doctype[^>]*>|\n"
TAG = r"<[^>]*>"
BLANKS = r"[\x20\x09-\x0D]+"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
#: Boilerplate is on more than this share of a host's pages, and on at least so many of them.
RATIO, LEAST = 0.3, 2


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def lines_of(html: Column) -> Column:
    parts = F.split(F.regexp_replace(html, HIDDEN, " "), BLOCK)
    clean = F.transform(parts, lambda x: F.trim(F.regexp_replace(F.when(F.contains(x, F.lit("<")), F.regexp_replace(x, TAG, "")).otherwise(x), BLANKS, " ")))
    return F.coalesce(F.filter(clean, lambda x: x != ""), F.array().cast("array<string>"))


def boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """host and drop, the keys of its boilerplate lines in order, of ``pages`` (host, keys)."""
    seen = pages.groupBy("host").agg(F.count("*").alias("pages"))
    counted = pages.select("host", F.explode(F.array_distinct("keys")).alias("key")).groupBy("host", "key").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return counted.join(seen, "host").where(F.col("n") > F.lit(float(ratio)) * F.col("pages")).groupBy("host").agg(F.array_sort(F.collect_list("key")).alias("drop"))


def dedup(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """id_col, host, n_lines, n_dropped and text, the lines that are left joined by line ends."""
    if not 0 <= ratio < 1:
        raise ValueError("ratio lies in [0, 1)")
    cut = pages.select(column(pages, id_col), host_of(column(pages, url_col)).alias("host"), lines_of(column(pages, html_col).cast("string")).alias("lines"))
    cut = materialise(cut.withColumn("keys", F.transform("lines", lambda x: F.xxhash64(x))), "page-lines")
    drop = materialise(boilerplate(cut.select("host", "keys"), ratio, least), "boilerplate")
    # a row holds all the keys of a host, so it is they that are counted
    few = (drop.agg(F.sum(F.size("drop")).alias("n")).first()["n"] or 0) <= BROADCAST_ROWS
    joined = cut.join(F.broadcast(drop) if few else drop, "host", "left")
    kept = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x, i: ~in_order(F.col("drop"), F.get("keys", i))))
    return joined.select(id_col, "host", "lines", kept.alias("kept")).select(
        id_col,
        "host",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.array_join("kept", "\n").alias("text"),
    )


ORACLE = r"""
WITH l AS (
  SELECT page_id, row_number() OVER () AS r, lower(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '')) AS host,
    list_filter(list_transform(regexp_split_to_array(regexp_replace(coalesce(html, ''), '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', ' ', 'g'),
      '(?i)</?(?:html|head|body|title|meta|link|nav|header|footer|main|article|section|aside|div|p|br|hr|h[1-6]|ul|ol|li|dl|dt|dd|table|thead|tbody|tr|td|th|form|pre|blockquote|figure)\b[^>]*>|<!doctype[^>]*>|\n'),
      lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'))), lambda x: x <> '') AS lines FROM pages
), c AS (
  SELECT host, line, count(*) AS n FROM (SELECT host, r, unnest(list_distinct(lines)) AS line FROM l) GROUP BY host, line
), b AS (
  SELECT host, list(line) AS bad FROM c JOIN (SELECT host, count(*) AS pages FROM l GROUP BY host) USING (host) WHERE n >= 2 AND n > 0.3 :: DOUBLE * pages GROUP BY host
), k AS (
  SELECT page_id, l.host, lines, CASE WHEN bad IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(bad, x)) END AS kept FROM l LEFT JOIN b ON l.host = b.host
)
SELECT page_id, host, len(lines) :: BIGINT AS n_lines, (len(lines) - len(kept)) :: BIGINT AS n_dropped, array_to_string(kept, chr(10)) AS text FROM k
"""
