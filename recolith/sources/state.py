"""Scans of records, committed state, revisions, aliases, and CSV tables."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.values import is_object
from ..model import ALIAS, CITATION, FINDING, REVISION

ENTRY_FILE = f"id string, family string, kind string, name string, attributes string, citations array<{CITATION}>, relations map<string,array<struct<kind:string,to:string,citations:array<{CITATION}>>>>"


def load_records(records: DataFrame, snapshots: DataFrame, source: str | None = None) -> DataFrame:
    """Records of known snapshots, with object: whether the payload is a JSON object."""
    rows = records.where(F.col("source") == source) if source else records
    known = snapshots.select("source", F.col("key").alias("snapshot_key"))
    return rows.join(known, ["source", "snapshot_key"], "left_semi").withColumn("object", is_object(F.col("payload")))


def read_json_dir(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document a file; other files are skipped, shapes that don't fit are an error. ``file`` is the name."""
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").option("pathGlobFilter", "*.json").json(path)
    return rows.withColumn("file", F.col("_metadata.file_name"))


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """As ``read_json_dir``; no rows where there is nothing."""
    return read_json_dir(spark, path, schema) if exists(spark, path) else spark.createDataFrame([], schema + ", file string")


def load_state(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Entries and relations of a directory of entry files."""
    rows = read_json_dir(spark, path, ENTRY_FILE)
    entries = rows.select("id", "family", "kind", "name", F.from_json("attributes", "map<string,string>").alias("attributes"), "citations")
    edges = rows.select(F.col("id").alias("from_id"), F.explode("relations").alias("facet", "list")).select("from_id", F.explode("list").alias("r"))
    return entries, edges.select("from_id", F.col("r.kind").alias("kind"), F.col("r.to").alias("to_id"), F.col("r.citations").alias("citations"))


def load_revisions(spark: SparkSession, path: str) -> DataFrame:
    return read_optional(spark, path, REVISION)


def load_aliases(spark: SparkSession, path: str) -> DataFrame:
    """Files of one alias, or of a list of them under ``aliases``."""
    item = "struct<" + ", ".join(":".join(f.split(" ", 1)) for f in ALIAS.split(", ")) + ">"
    rows = read_optional(spark, path, f"{ALIAS}, schemaVersion int, aliases array<{item}>")
    own = F.struct(*[f.split(" ", 1)[0] for f in ALIAS.split(", ")])
    return rows.select(F.explode(F.when(F.col("aliases").isNotNull(), F.col("aliases")).otherwise(F.array(own))).alias("a")).select("a.*")


def load_findings(spark: SparkSession, path: str) -> DataFrame:
    return read_optional(spark, path, FINDING)


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Quoted as written by ``sinks.write_csv``, whose header stands once beside the parts; all columns text without a schema."""
    reader = spark.read.option("quote", '"').option("escape", '"').option("multiLine", True).option("mode", "FAILFAST")
    if not exists(spark, f"{path}/_head"):
        reader = reader.option("header", True)
        return (reader.schema(schema) if schema else reader).csv(path)
    files = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_head")
    stream = files.getFileSystem(spark._jsc.hadoopConfiguration()).open(files)
    (names,) = csv.reader([spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")])
    stream.close()
    kinds = StructType([StructField(n, StringType()) for n in names])
    return reader.schema(schema or kinds).csv(path)
