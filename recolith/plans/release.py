"""Release tables of a state, and their verification against what was said of them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import id_slug, raw_verb
from ..functions.values import attribute_text, collection_status, release_status
from ..operators import graph
from ..sinks import manifest, row_hash, verify_manifest
from ..sources.state import exists, read_csv


def release_tables(entries: DataFrame, relations: DataFrame, categories: dict[str, str], verbs: dict[str, graph.Verb], excluded: DataFrame) -> dict[str, DataFrame]:
    """Tables by name; every one a projection of entries and relations."""
    node_rows = graph.nodes(entries, categories, excluded)
    edge_rows = graph.edges(relations, node_rows, verbs)
    cites = entries.select(F.col("id").alias("entry_id"), F.inline("citations"))
    edge_cites = relations.select("from_id", "kind", "to_id", F.inline("citations"))
    attributes = entries.select(F.col("id").alias("entry_id"), F.explode("attributes").alias("name", "json")).select("entry_id", "name", attribute_text(F.col("json")).alias("value"))
    return {
        "entries": entries.select("id", id_slug(F.col("id")).alias("slug"), "family", "kind", "name"),
        "attributes": attributes,
        "relations": relations.select("from_id", "kind", raw_verb(F.col("kind")).alias("verb"), "to_id"),
        "entry_citations": cites,
        "relation_citations": edge_cites,
        "nodes": node_rows,
        "edges": edge_rows,
        "graph_summary": graph.summary(node_rows, edge_rows),
        "kind_counts": entries.groupBy("kind").agg(F.count("*").alias("n")),
        "relation_kind_counts": relations.groupBy("kind").agg(F.count("*").alias("n")),
    }


def mark(check: str, key: Column | None = None, a: Column | int = 0, b: Column | int = 0, hash_: Column | None = None) -> Column:
    """What a row adds to a check: ``a`` and ``b`` to the sums of a key, or of the whole check where it has none."""
    number = lambda n: (F.lit(n) if isinstance(n, int) else n).cast("long")
    zero = F.lit(0) if hash_ is None else hash_
    return F.struct(F.lit(check).alias("check"), (F.lit(None) if key is None else key).cast("string").alias("key"), number(a).alias("a"), number(b).alias("b"), zero.cast("decimal(38,0)").alias("hash"))


class Tally:
    """Checks over many tables in one pass each: every row gives its marks, which are summed by check and key, and by check."""

    #: How a check's number follows from its keys: those met more than once, the sum of ``a`` of keys that no ``b`` has, the keys whose ``a`` and ``b`` differ.
    RULES = ("twice", "alone", "unequal")

    def __init__(self) -> None:
        self.marks: dict[str, tuple[DataFrame, list[Column]]] = {}
        self.rules: dict[str, str] = {}
        self.expected: dict[str, str | None] = {}

    def add(self, table: str, df: DataFrame, *marks: Column) -> None:
        self.marks.setdefault(table, (df, []))[1].extend(marks)

    def none(self, check: str, rule: str = "sum") -> None:
        """The check's number must be 0."""
        self.rules[check], self.expected[check] = rule, "0"

    def bad(self, check: str, table: str, df: DataFrame, condition: Column) -> None:
        """No row may meet the condition."""
        self.none(check)
        self.add(table, df, F.when(condition, mark(check, a=1)))

    def equal(self, check: str) -> None:
        """The sums of ``a`` and ``b`` must be the same."""
        self.rules[check], self.expected[check] = "sum", None

    def sums(self) -> DataFrame:
        """check, a, b, hash, twice, alone, unequal."""
        each = [df.select(F.explode(F.array_compact(F.array(*marks))).alias("m")).select("m.*") for df, marks in self.marks.values()]
        keyed = reduce(DataFrame.unionByName, each).groupBy("check", "key").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("hash").alias("hash"))
        return keyed.groupBy("check").agg(
            F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("hash").cast("string").alias("hash"),
            F.count_if(F.col("a") > 1).alias("twice"), F.sum(F.when(F.col("b") == 0, F.col("a")).otherwise(0)).alias("alone"), F.count_if(F.col("a") != F.col("b")).alias("unequal"),
        )

    def results(self) -> DataFrame:
        """check, expected, actual."""
        spark = next(iter(self.marks.values()))[0].sparkSession
        said = spark.createDataFrame([(c, self.rules[c], e) for c, e in self.expected.items()], "check string, rule string, said string")
        value = F.coalesce(F.when(F.col("rule") == "hash", F.concat_ws(":", "a", "hash")), *[F.when(F.col("rule") == r, F.col(r).cast("string")) for r in self.RULES], F.col("a").cast("string"))
        empty = F.when(F.col("rule") == "hash", "0:0").otherwise("0")
        found = said.join(self.sums(), "check", "left")
        return found.select("check", F.when((F.col("rule") == "sum") & F.col("said").isNull(), F.coalesce(F.col("b"), F.lit(0)).cast("string")).otherwise(F.col("said")).alias("expected"), F.coalesce(F.when(F.col("a").isNotNull(), value), empty).alias("actual"))


def verify_release(
    tables: Mapping[str, DataFrame],
    counts: DataFrame,
    keys: dict[str, list[str]],
    headers: dict[str, list[str]],
    verbs: set[str] | None = None,
    categories: set[str] | None = None,
    coverage: DataFrame | None = None,
    catalog: DataFrame | None = None,
    items: DataFrame | None = None,
    posture: DataFrame | None = None,
) -> DataFrame:
    """check, expected, actual, ok. Each table is read once, and all its checks are sums of one aggregation.

    Row counts, headers and contents against a catalogue (name, row_count and, if it has one, fingerprint); unique keys;
    roll-ups against what they sum up; the graph: ends are nodes, no loops, known verbs and categories, nodes are entries; no dangling relations;
    coverage (source, snapshots, records, citations and both statuses): statuses follow from the counts, citations are those of the tables, sources are those of the
    ``catalog``; review ``items`` (queue, category, status, blocking): none blocks the release, and they are as many as the ``posture`` says.
    Checks of tables that aren't there are left out.
    """
    spark = counts.sparkSession
    tally = Tally()
    text = lambda columns: F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    has = lambda *names: set(names) <= set(tables)
    printed = "fingerprint" in counts.columns
    said = {r["name"]: r for r in counts.where(F.col("name").isin(*tables)).collect()}  # a row a table
    for name, df in tables.items():
        if name in said:
            tally.expected[f"rows:{name}"], tally.rules[f"rows:{name}"] = str(said[name]["row_count"]), "sum"
            tally.add(name, df, mark(f"rows:{name}", a=1))
        if printed and name in said:
            tally.expected[f"content:{name}"], tally.rules[f"content:{name}"] = f"{said[name]['row_count']}:{said[name]['fingerprint']}", "hash"
            tally.add(name, df, mark(f"content:{name}", a=1, hash_=row_hash(df)))
        if name in keys:
            tally.none(f"unique:{name}", "twice")
            tally.add(name, df, mark(f"unique:{name}", text(keys[name]), 1))
    for counted, whole in (("kind_counts", "entries"), ("relation_kind_counts", "relations")):
        if has(counted, whole):
            tally.equal(f"rollup:{counted}")
            tally.add(counted, tables[counted], mark(f"rollup:{counted}", a=F.col("n")))
            tally.add(whole, tables[whole], mark(f"rollup:{counted}", b=1))
    for section, whole in (("node_category", "nodes"), ("edge_verb", "edges")):
        check = f"rollup:graph_summary:{whole}"
        if has("graph_summary", whole):
            tally.equal(check)
            tally.add("graph_summary", tables["graph_summary"], F.when(F.col("section") == section, mark(check, a=F.col("n"))))
            tally.add(whole, tables[whole], mark(check, b=1))

    def held(check: str, table: str, *ends: str, among: str) -> None:
        """The ids in the columns ``ends`` of a table are those of the other."""
        if has(table, among):
            tally.none(check, "alone")
            tally.add(table, tables[table], *[mark(check, F.col(e), a=1) for e in ends])
            tally.add(among, tables[among], mark(check, F.col("id"), b=1))

    held("edges:ends", "edges", "from_id", "to_id", among="nodes")
    held("nodes:entries", "nodes", "id", among="entries")
    held("relations:dangling", "relations", "to_id", among="entries")
    unknown = lambda c, known: ~F.coalesce(F.col(c).isin(*known), F.lit(False))
    if has("edges") and has("nodes"):
        tally.bad("edges:loops", "edges", tables["edges"], F.col("from_id") == F.col("to_id"))
    if verbs is not None and has("edges"):
        tally.bad("edges:verbs", "edges", tables["edges"], unknown("verb", verbs))
    if categories is not None and has("nodes"):
        tally.bad("nodes:categories", "nodes", tables["nodes"], unknown("category", categories))
    if coverage is not None:
        count = lambda c: F.coalesce(F.col(c), F.lit(0))
        tally.bad("coverage:collection_status", "coverage", coverage, ~F.col("collection_status").eqNullSafe(collection_status(count("snapshots"), count("records"))))
        tally.bad("coverage:release_status", "coverage", coverage, (F.col("release_status") != "inventory_only") & ~F.col("release_status").eqNullSafe(release_status(F.lit(False), count("citations"), count("snapshots"), count("records"))))
        if has("source_counts"):
            tally.none("coverage:citations", "unequal")
            tally.add("coverage", coverage, mark("coverage:citations", F.col("source"), a=count("citations")))
            tally.add("source_counts", tables["source_counts"], mark("coverage:citations", F.col("source"), b=F.col("n")))
        if catalog is not None:
            tally.none("coverage:sources", "unequal")
            tally.add("coverage", coverage, mark("coverage:sources", F.col("source"), a=1))
            tally.add("catalog", catalog, mark("coverage:sources", F.col("source"), b=1))
    if items is not None:
        tally.bad("blockers", "items", items, F.coalesce(F.col("blocking"), F.lit(False)))
    if items is not None and posture is not None:
        tally.none("posture", "unequal")
        tally.add("items", items, *[mark("posture", F.concat_ws("|", F.lit(s), F.col(s)), a=1) for s in ("queue", "category", "status")])
        tally.add("posture", posture, mark("posture", F.concat_ws("|", "section", "label"), b=F.col("n")))
    found = tally.results()
    content = F.col("check").startswith("content:")
    same = F.when(F.col("expected") == F.col("actual"), "same").otherwise("changed")
    found = found.select("check", F.when(content, "same").otherwise(F.col("expected")).alias("expected"), F.when(content, same).otherwise(F.col("actual")).alias("actual"))
    heads = [(f"header:{n}", ",".join(headers[n]), ",".join(tables[n].columns)) for n in tables if n in headers]
    found = found.unionByName(spark.createDataFrame(heads, "check string, expected string, actual string"))
    return found.withColumn("ok", F.col("expected").eqNullSafe(F.col("actual")))


def verify_export(spark: SparkSession, path: str, files: DataFrame, tables: dict[str, tuple[list[str], int]]) -> DataFrame:
    """check, expected, actual, ok of an export on disk: its files against their manifest (``files``: name, bytes, sha256), and the header and rows of each CSV against ``tables``."""
    wrong = verify_manifest(manifest(spark, path), files)
    problems = wrong.select(F.concat(F.lit("file:"), "name").alias("check"), F.lit("as listed").alias("expected"), F.col("problem").alias("actual"))
    heads, rows = [], []
    for name, (header, count) in tables.items():
        there = exists(spark, f"{path}/{name}/_head")
        table = read_csv(spark, f"{path}/{name}") if there else None
        heads.append((f"header:{name}", ",".join(header), ",".join(table.columns) if there else None))
        if there:
            rows.append(table.agg(F.count("*").cast("string").alias("actual")).select(F.lit(f"rows:{name}").alias("check"), F.lit(str(count)).alias("expected"), "actual"))
    found = reduce(DataFrame.unionByName, [spark.createDataFrame(heads, "check string, expected string, actual string"), problems, *rows])
    return found.withColumn("ok", F.col("expected").eqNullSafe(F.col("actual")))
