"""HTML pages as DataFrames: links, tables, fields, rosters, headings. ``pages`` have an id column, url and html.

Patterns are bounded and without backtracking over whole pages; each function explodes what one page holds, and windows run along a page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, first_paragraph, heading_of, is_script_shell, let, strip_tags, title_of
from ..functions.url import detail_slug
from ..operators.windows import fill_forward, first_per_key

ANCHOR = r'(?is)<a\b[^>]*?\bhref\s*=\s*"([^"]*)"[^>]*>(.*?)</a>'


def links(pages: DataFrame, id_col: str, html: str = "html") -> DataFrame:
    """id_col, pos (from 0), href and visible text of the page's links."""
    found = F.posexplode(F.regexp_extract_all(F.col(html), F.lit(ANCHOR), F.lit(0))).alias("pos", "tag")
    return pages.select(id_col, found).select(id_col, "pos", F.regexp_extract("tag", ANCHOR, 1).alias("href"), strip_tags(F.regexp_extract("tag", ANCHOR, 2)).alias("text"))


def first_links(pages: DataFrame, id_col: str, wanted: Column, key: Column) -> DataFrame:
    """Links that are wanted, the first of each key on a page; ``wanted`` and ``key`` are over href and text."""
    rows = links(pages, id_col).where(wanted).withColumn("key", key).where("key <> ''")
    return first_per_key(rows, [id_col, "key"], F.col("pos"))


def crawl_index(index: DataFrame, supplement: DataFrame, id_col: str, wanted: Column) -> DataFrame:
    """Detail links of an index by slug, and those of a supplementary index whose slug isn't there yet."""
    rows = [first_links(p, id_col, wanted, detail_slug(F.col("href"))).groupBy("key").agg(F.min_by(F.struct("href", "text"), F.struct(F.col(id_col), F.col("pos"))).alias("link")) for p in (index, supplement)]
    more = rows[1].join(rows[0].select("key"), "key", "left_anti")
    return rows[0].withColumn("from_supplement", F.lit(False)).unionByName(more.withColumn("from_supplement", F.lit(True))).select(F.col("key").alias("slug"), "link.href", F.col("link.text").alias("name"), "from_supplement")


#: Comments, scripts and styles whole, tags, and the text between.
TOKEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<[^>]*>|[^<]+"
TABLE, LIST = (("table",), (("tr",), ("td", "th"))), (("ul", "ol"), (("li",),))


def nested(pages: DataFrame, id_col: str, shape: tuple, html: str = "html") -> DataFrame:
    """Tables or lists (``TABLE``, ``LIST``) of pages, whatever stands in what: id_col, pos, token, depth (of the table, from 1), box (the
    place where it opens), up (that of the one around it, or null), and l1, l2, the numbers of row and cell in it, from 1; 0 before the first.

    A token belongs to the innermost table around it. All are running counts along a page: the depth counts opened and closed tables, the table is the last that
    was opened at that depth, and rows and cells are counted in it, so that rows and cells which nothing closes end where the next begins.
    """
    boxes, levels = shape
    tag = F.lower(F.regexp_extract("token", r"^<(/?[A-Za-z][A-Za-z0-9]*)", 1))
    rows = pages.select(id_col, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(TOKEN), F.lit(0))).alias("pos", "token")).where(~F.col("token").rlike(r"(?i)^<(?:!--|script\b|style\b)")).withColumn("tag", tag)
    along = lambda *keys: W.partitionBy(id_col, *keys).orderBy("pos")
    opens = F.col("tag").isin(*boxes)
    closes = F.col("tag").isin(*[f"/{b}" for b in boxes]).cast("int")
    # a closing tag belongs to what it closes
    rows = rows.withColumn("depth", F.sum(opens.cast("int") - closes).over(along()) + closes)
    last = lambda keys: F.last(F.when(opens, F.col("pos")), ignorenulls=True).over(along(*keys))
    rows = rows.withColumn("box", last(("depth",))).where("depth > 0")
    above = rows.where(opens).select(id_col, (F.col("depth") + 1).alias("depth"), F.col("pos").alias("up"))
    # the table around is the last of the depth above that opens before
    around = rows.where(opens).select(id_col, "depth", "box").join(above.where("up IS NOT NULL"), [id_col, "depth"]).where("up < box").groupBy(id_col, "box").agg(F.max("up").alias("up"))
    rows = rows.join(around, [id_col, "box"], "left")
    keys = ["box"]
    for i, tags in enumerate(levels, 1):
        rows = rows.withColumn(f"l{i}", F.sum(F.when(F.col("tag").isin(*tags), 1).otherwise(0)).over(along(*keys)))
        keys.append(f"l{i}")
    return rows.select(id_col, "pos", "token", "depth", "box", "up", *keys[1:])


def joined_tokens() -> Column:
    """A group's tokens in order, a blank where something is left out."""

    def text(tokens: Column) -> Column:
        gap = lambda x, i: (i > 0) & (x["pos"] > F.get(tokens, i - 1)["pos"] + 1)
        return F.array_join(F.transform(tokens, lambda x, i: F.concat(F.when(gap(x, i), " ").otherwise(""), x["token"])), "")

    return let(F.array_sort(F.collect_list(F.struct("pos", "token"))), text)


def nested_texts(pages: DataFrame, id_col: str, shape: tuple, html: str = "html") -> DataFrame:
    """id_col, box, up, depth, the numbers of row and cell, inner (the HTML) and text of the innermost parts; what a table inside holds is its own."""
    rows = nested(pages, id_col, shape, html)
    levels = [f"l{i}" for i in range(1, len(shape[1]) + 1)]
    parts = rows.where(f"{levels[-1]} > 0").groupBy(id_col, "box", *levels).agg(F.first("up").alias("up"), F.first("depth").alias("depth"), F.min("pos").alias("pos"), joined_tokens().alias("inner"))
    return parts.select(id_col, "box", "up", "depth", *levels, "pos", "inner", strip_tags(F.col("inner")).alias("text"))


def table_cells(pages: DataFrame, id_col: str, html: str = "html") -> DataFrame:
    """id_col, row (from 0, in order of the page), cells (texts), inner (the row's HTML) of the rows of all tables, those of tables inside others too."""
    rows = nested(pages, id_col, TABLE, html).where("l1 > 0")
    cell = F.struct("l2", joined_tokens().alias("inner"), F.min("pos").alias("pos"))
    cells = rows.groupBy(id_col, "box", "l1", "l2").agg(cell.alias("c"))
    each = cells.groupBy(id_col, "box", "l1").agg(F.array_sort(F.collect_list("c")).alias("c"), F.min("c.pos").alias("pos"))
    number = F.row_number().over(W.partitionBy(id_col).orderBy("pos")) - 1
    texts = F.transform(F.filter("c", lambda x: x["l2"] > 0), lambda x: strip_tags(x["inner"]))
    return each.select(id_col, number.alias("row"), texts.alias("cells"), F.array_join(F.transform("c", lambda x: x["inner"]), "").alias("inner"))


def first_table(pages: DataFrame, id_col: str, html: str = "html") -> DataFrame:
    """``table_cells`` of the first table of a page."""
    depth = nested(pages, id_col, TABLE, html)
    first = depth.groupBy(id_col).agg(F.min("box").alias("box"))
    cut = depth.join(first, [id_col, "box"], "left_semi").groupBy(id_col).agg(joined_tokens().alias("__first"))
    return table_cells(cut, id_col, "__first")


def directory_rows(pages: DataFrame, id_col: str, generic: tuple[str, ...] = ()) -> DataFrame:
    """Name and link of table rows, distinct by both, without links to generic portals."""
    rows = table_cells(pages, id_col).select(id_col, "row", F.get("cells", 0).alias("name"), F.regexp_extract("inner", r'(?is)href\s*=\s*"([^"]+)"', 1).alias("url"))
    rows = rows.where(F.coalesce(F.col("name"), F.lit("")) != "").where(F.col("url") != "")
    rows = rows.where(~F.col("url").isin(*generic)) if generic else rows
    return first_per_key(rows, ["name", "url"], F.col(id_col), F.col("row"))


def officers(pages: DataFrame, id_col: str, heading: str) -> DataFrame:
    """Rows of the table after a heading: seat, name, roles (distinct emphasised texts, joined by ``; ``)."""
    section = F.regexp_extract("html", rf"(?is)<h\d[^>]*>\s*{heading}.*?(<table\b.*)$", 1)
    rows = first_table(pages.withColumn("__table", section), id_col, "__table")
    roles = F.array_join(F.array_distinct(F.transform(F.regexp_extract_all(F.col("inner"), F.lit(r"(?is)<em[^>]*>(.*?)</em>"), F.lit(1)), lambda c: strip_tags(c))), "; ")
    name = strip_tags(F.regexp_replace("inner", r"(?is)<em[^>]*>.*?</em>", " "))
    return rows.select(id_col, "row", F.get("cells", 0).alias("seat"), blank_to_null(F.regexp_replace(name, F.concat(F.lit(r"^\Q"), F.get("cells", 0), F.lit(r"\E\s*")), "")).alias("name"), blank_to_null(roles).alias("roles"))


def pair(label: str, value: str, inside: str = r"[^<]+") -> str:
    """A pattern of two elements in a row: a label, whose text is group 1, and what it names, group 2."""
    return rf"(?is)<{label}\b[^>]*>({inside})</{label}\s*>\s*<{value}\b[^>]*>(.*?)</{value}\s*>"


#: Layouts of named fields, first to last; group 1 is the name, group 2 the value.
LAYOUTS = (
    *(pair(label, value) for label, value in (("h3", "p"), ("dt", "dd"), ("th", "td"))),
    r"(?is)<strong>\s*([^<:]+?)\s*:?\s*</strong>\s*:?\s*(.*?)</(?:p|li|div)>",
    r"(?is)<div[^>]*\bfield-label[^>]*>\s*([^<:]+?)\s*:?\s*</div>\s*<div[^>]*>(.*?)</div>",
    r"(?is)<li[^>]*>\s*([^<:]{2,60}?):\s*(.*?)</li>",
)


def fields(pages: DataFrame, id_col: str, aliases: dict[str, str] | None = None) -> DataFrame:
    """id_col, field (normalised name), value: of each field the value of the first layout, and there the first."""

    def layout(n: int, pattern: str) -> Column:
        found = F.regexp_extract_all("html", F.lit(pattern), F.lit(0))
        return F.transform(found, lambda m, i: F.struct(F.lit(n).alias("layout"), i.alias("pos"), F.regexp_extract(m, pattern, 1).alias("name"), strip_tags(F.regexp_extract(m, pattern, 2)).alias("value")))

    every = F.flatten(F.array(*[layout(n, p) for n, p in enumerate(LAYOUTS)]))
    name = F.regexp_replace(F.regexp_replace(F.lower(strip_tags(F.col("f.name"))), "[^a-z0-9]+", "_"), "^_|_$", "")
    rows = pages.select(id_col, F.explode(every).alias("f")).select(id_col, name.alias("field"), "f.layout", "f.pos", "f.value").where("value <> '' AND field <> ''")
    if aliases:
        table = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
        rows = rows.withColumn("field", F.coalesce(table[F.col("field")], F.col("field")))
    return first_per_key(rows, [id_col, "field"], F.col("layout"), F.col("pos")).select(id_col, "field", "value")


def headed_links(pages: DataFrame, id_col: str, heading: str, text: str) -> DataFrame:
    """Links by the heading before them: id_col, pos, value (the heading's group 1), href, text. ``heading`` and ``text`` are patterns of visible texts."""
    token = r"(?is)<h[1-6][^>]*>.*?</h[1-6]>|<a\b[^>]*>.*?</a>"
    tokens = pages.select(id_col, F.posexplode(F.regexp_extract_all("html", F.lit(token), F.lit(0))).alias("pos", "t"))
    is_heading = F.col("t").rlike(r"(?i)^<h[1-6]")
    value = F.when(is_heading, blank_to_null(F.regexp_extract(strip_tags(F.col("t")), heading, 1)))
    filled = fill_forward(tokens, [id_col], ["pos"], value, "value")
    rows = filled.where(~is_heading).select(id_col, "pos", "value", F.regexp_extract("t", ANCHOR, 1).alias("href"), strip_tags(F.regexp_extract("t", ANCHOR, 2)).alias("text"))
    return rows.where(F.col("text").rlike(text))


def page_facts(pages: DataFrame, id_col: str) -> DataFrame:
    """Title, first heading and first paragraph, without pages that only ask for JavaScript."""
    rows = pages.select(id_col, title_of(F.col("html")).alias("title"), heading_of(F.col("html")).alias("heading"), first_paragraph(F.col("html")).alias("summary"))
    return rows.where(~F.coalesce(is_script_shell(F.concat_ws(" ", "title", "heading", "summary")), F.lit(False)))


def evidence(fragments: DataFrame, labels: list[str], text: str = "text") -> DataFrame:
    """``fragments`` with label: the longest of the configured labels that the text begins with; the longest text of each label, and how many
    rows have it; ``evidence_pages`` has their pages."""
    return _labelled(fragments, labels, text).groupBy("label").agg(F.min_by(text, F.struct((-F.length(text)).alias("n"), F.col(text))).alias(text), F.count("*").alias("n"))


def evidence_pages(fragments: DataFrame, labels: list[str], text: str = "text") -> DataFrame:
    """label and url, distinct: the pages that speak of each label."""
    return _labelled(fragments, labels, text).select("label", "url").distinct()


def _labelled(fragments: DataFrame, labels: list[str], text: str) -> DataFrame:
    fits = F.filter(F.array(*[F.lit(x) for x in labels]), lambda x: F.startswith(F.lower(F.col(text)), F.lower(x)))
    longest = F.array_max(F.transform(fits, lambda x: F.struct(F.length(x).alias("n"), x.alias("label"))))["label"]
    return fragments.withColumn("label", longest).where("label IS NOT NULL")


def committee_pages(pages: DataFrame, id_col: str, person: str = "/councilmembers/") -> DataFrame:
    """id_col, name (first heading), type, chair and members (structs of name and url, distinct by url, in order of the page)
    of committee pages. The first person's link after the word chair is the chair's."""
    link = rf'(?is)<a\b[^>]*?\bhref\s*=\s*"([^"]*{person}[^"]*)"[^>]*>(.*?)</a>'
    people = F.transform(F.regexp_extract_all("html", F.lit(link), F.lit(0)), lambda t: F.struct(strip_tags(F.regexp_extract(t, link, 2)).alias("name"), F.regexp_extract(t, link, 1).alias("url")))
    first = F.filter(people, lambda p, i: ~F.exists(F.slice(people, 1, i), lambda q: q["url"] == p["url"]))
    after = F.regexp_extract("html", r"(?is)\bchair(?:person|man|woman)?\b(.*)$", 1)
    chair = F.regexp_extract(after, link, 1)
    name = heading_of(F.col("html"))
    return pages.select(id_col, name.alias("name"), F.when(F.lower(name).startswith("sub"), "subcommittee").otherwise("committee").alias("type"), F.when(chair != "", chair).alias("chair"), first.alias("members"))


def grouped_values(rows: DataFrame, key: str) -> DataFrame:
    """key and the distinct values of ``headed_links`` rows, sorted: the wards of a commission, say."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_set("value")).alias("values"))
