"""Registration, and the driver's tables as fragments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import attribute_map as attributes
from ..functions.values import cite
from ..model import CITATION

Query = Callable[[SparkSession, str], DataFrame]


def registry() -> tuple[dict[str, Query], dict[str, str], Callable[..., Callable[[Query], Query]]]:
    queries: dict[str, Query] = {}
    oracle: dict[str, str] = {}

    def query(sql: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            queries[f.__name__] = f
            if sql:
                oracle[f.__name__] = sql
            return f

        return add

    return queries, oracle, query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c: str) -> Column:
    return F.col(c).cast("string")


def ord_of(record: Column) -> Column:
    return F.struct(F.lit(0).alias("binding"), record.cast("bigint").alias("record"), F.lit(0).alias("emit"))


def json_text(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def no_citations() -> Column:
    return F.expr("array()").cast(f"array<{CITATION}>")


def fragment(df: DataFrame, source: str, key: str, kind: str, family: str, name: str, attrs: Column) -> DataFrame:
    """ENTRY_FRAGMENT rows of a table: an entry a row."""
    return df.select(F.lit(source).alias("source"), text(key).alias("source_record_id"), F.concat(F.lit(f"{kind}:"), text(key)).alias("provisional_id"), F.lit(family).alias("family"), F.lit(kind).alias("kind"), F.col(name).alias("name"), attrs.alias("attributes"), F.array(cite(F.lit(source), text(key))).alias("citations"), ord_of(F.col(key)).alias("ord"))


def entity_fragments(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Regions, nations, suppliers and customers, in this order."""
    t = lambda n: table(spark, sf_dir, n)
    return [
        fragment(t("region"), "region", "r_regionkey", "region", "area", "r_name", attributes(code=text("r_regionkey"))),
        fragment(t("nation"), "nation", "n_nationkey", "nation", "area", "n_name", attributes(code=text("n_nationkey"))),
        fragment(t("supplier"), "supplier", "s_suppkey", "supplier", "organization", "s_name", attributes(nation=text("s_nationkey"))),
        fragment(t("customer"), "customer", "c_custkey", "customer", "organization", "c_name", attributes(segment=json_text(F.col("c_mktsegment")))),
    ]


def entity_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RELATION_FRAGMENT rows: nations part_of regions, suppliers and customers located_in nations."""
    rows = []
    for name, key, to, kind, target in (("nation", "n_nationkey", "n_regionkey", "part_of", "region"), ("supplier", "s_suppkey", "s_nationkey", "located_in", "nation"), ("customer", "c_custkey", "c_nationkey", "located_in", "nation")):
        rows.append(table(spark, sf_dir, name).select(F.lit(name).alias("source"), text(key).alias("source_record_id"), F.concat(F.lit(f"{name}:"), text(key)).alias("from_id"), F.lit(kind).alias("relation_kind"), F.concat(F.lit(f"{target}:"), text(to)).alias("to_id"), F.array(cite(F.lit(name), text(key))).alias("citations"), ord_of(F.col(key)).alias("ord")))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The same as entries and relations, which they are already: an id a row."""
    frames = entity_fragments(spark, sf_dir)
    entries = frames[0]
    for f in frames[1:]:
        entries = entries.unionByName(f)
    edges = entity_edges(spark, sf_dir)
    return entries.select(F.col("provisional_id").alias("id"), "family", "kind", "name", "attributes", "citations"), edges.select("from_id", F.col("relation_kind").alias("kind"), "to_id", "citations")


#: The same graph in SQL, for the oracles.
GRAPH_SQL = """
e AS (
  SELECT 'region:' || r_regionkey AS id, 'area' AS family, 'region' AS kind, r_name AS name FROM region
  UNION ALL SELECT 'nation:' || n_nationkey, 'area', 'nation', n_name FROM nation
  UNION ALL SELECT 'supplier:' || s_suppkey, 'organization', 'supplier', s_name FROM supplier
  UNION ALL SELECT 'customer:' || c_custkey, 'organization', 'customer', c_name FROM customer
), r AS (
  SELECT 'nation:' || n_nationkey AS from_id, 'part_of' AS kind, 'region:' || n_regionkey AS to_id FROM nation
  UNION ALL SELECT 'supplier:' || s_suppkey, 'located_in', 'nation:' || s_nationkey FROM supplier
  UNION ALL SELECT 'customer:' || c_custkey, 'located_in', 'nation:' || c_nationkey FROM customer
)
"""
