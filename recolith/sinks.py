"""Sinks: state files, CSV and JSON exports, catalogues and checksums; ``buckets`` has the tables that are written by parts.

Writers that replace write beside the old table or export and swap at the end: the old one moves aside, the new one takes its
place, the old one goes. A job that is lost leaves the old one in its place, or, within the swap, both beside each other, which the next swap or ``recover`` puts right.
An export is written by ordered tasks, a part each, and a list of the parts that makes them one file (``parts``, ``concatenate``).
"""

from __future__ import annotations

import csv
import hashlib
import io
import json
import uuid
from collections.abc import Iterator, Mapping
from functools import reduce
from itertools import accumulate

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .buckets import file_system, read_table, recover, replace_source, sortables, swap, upsert
from .operators.fragments import findings_order
from .stores import file_system as store_of
from .stores import qualify

__all__ = ["changed_ranges", "concatenate", "content_fingerprint", "manifest", "overwrite", "ranges", "read_table", "recover", "replace_source", "safe_path", "swap", "upsert", "write_bundle", "write_csv", "write_export", "write_findings", "write_json_array", "write_json_lines", "write_state", "write_summary"]

#: Names that Spark's readers pass over: the text in front of the parts and behind them, and their list.
HEAD, FOOT, PARTS = "_head", "_foot", "_parts"
#: Bytes of a range that is hashed by itself.
RANGE = 64 << 20


def overwrite(df: DataFrame, path: str) -> None:
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.write.parquet(staged)
    swap(df.sparkSession, staged, path)


def reset(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        files, p = file_system(spark, path)
        files.delete(p, True)


def index_state(entries: DataFrame, relations: DataFrame, jurisdiction: str | None, path: str) -> None:
    place = F.lit(jurisdiction or "unknown").alias("jurisdiction")
    overwrite(entries.select(F.col("id").alias("entry_id"), "family", "kind", "name", place), f"{path}/state_entries")
    overwrite(relations.select("from_id", "kind", "to_id", place), f"{path}/state_relations")


def state_documents(entries: DataFrame, relations: DataFrame) -> DataFrame:
    """id and document: an entry with its relations as JSON, keys sorted. Relations of one entry are a document's size."""
    facets = relations.groupBy("from_id", "kind").agg(F.array_sort(F.collect_list(F.struct("kind", F.col("to_id").alias("to"), "citations"))).alias("list")).groupBy(F.col("from_id").alias("id")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "list")))).alias("relations"))
    attributes = F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.map_entries("attributes")), lambda e: F.concat(F.to_json(F.struct(e["key"].alias("k"))).substr(F.lit(6), F.length(F.to_json(F.struct(e["key"].alias("k")))) - 6), F.lit(":"), e["value"])), ","), F.lit("}"))
    body = F.to_json(F.struct(F.parse_json(attributes).alias("attributes"), "citations", "family", "id", "kind", "name", "relations"))
    return entries.join(facets, "id", "left").select("id", body.alias("document"))


def write_state(entries: DataFrame, relations: DataFrame, path: str) -> None:
    """Documents in ranges of ids; files of former states go."""
    spark = entries.sparkSession
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    state_documents(entries, relations).repartitionByRange("id").sortWithinPartitions("id").select("document").write.text(staged)
    swap(spark, staged, path)


def blank_nulls(df: DataFrame) -> DataFrame:
    """All columns as text, '' for null."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    files, p = file_system(spark, path)
    out = files.create(p, True)
    out.write(text.encode())
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    files, p = file_system(spark, path)
    stream = files.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _finish(spark: SparkSession, staged: str, path: str, head: str = "", foot: str = "", between: int = 0) -> None:
    """Lists the parts that ordered tasks have written to ``staged`` as one file - name, bytes and offset, the head first - and swaps it in.
    ``between``: bytes that end each row and don't belong behind the last."""
    files, p = file_system(spark, staged)
    found = [(s.getPath().getName(), s.getLen()) for s in files.listStatus(p) if s.getPath().getName().startswith("part-") and s.getLen()]  # a row a task
    found.sort(key=lambda f: int(f[0].split("-")[1]))
    if found:
        found[-1] = (found[-1][0], found[-1][1] - between)
    for name, text in ((HEAD, head), (FOOT, foot)):
        if text:
            _write_text(spark, f"{staged}/{name}", text)
    rows = [(HEAD, len(head.encode()))] * bool(head) + found + [(FOOT, len(foot.encode()))] * bool(foot)
    starts = accumulate((n for _, n in rows), initial=0)
    _write_text(spark, f"{staged}/{PARTS}", json.dumps([{"name": name, "bytes": n, "offset": at} for (name, n), at in zip(rows, starts, strict=False)]))
    swap(spark, staged, path)


def parts(spark: SparkSession, path: str) -> list[dict]:
    """name, bytes and offset of the parts that make one file, in order."""
    return json.loads(read_text(spark, f"{path}/{PARTS}"))


def concatenate(spark: SparkSession, path: str, target: str) -> None:
    """The parts of an export as one file, copied through the driver some KB at a time."""
    copy = spark._jvm.org.apache.commons.io.IOUtils.copyLarge
    staged = f"{target}.{uuid.uuid4().hex}"
    files, p = file_system(spark, staged)
    out = files.create(p, True)
    for part in parts(spark, path):
        source, q = file_system(spark, f"{path}/{part['name']}")
        stream = source.open(q)
        copy(stream, out, 0, part["bytes"])
        stream.close()
    out.close()
    swap(spark, staged, target)


def write_csv(df: DataFrame, path: str, order: list) -> None:
    """Rows ordered over all parts, minimal quotes, doubled inside; the header once, in front of the first. The old export stays until the new one is whole."""
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    blank_nulls(df.orderBy(*order)).write.option("header", False).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(staged)
    head = io.StringIO()
    csv.writer(head, lineterminator="\n").writerow(df.columns)
    _finish(df.sparkSession, staged, path, head.getvalue())


def write_json_lines(df: DataFrame, path: str, order: list) -> None:
    """A JSON object a line, ordered over all parts."""
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.orderBy(*order).write.json(staged)
    _finish(df.sparkSession, staged, path)


def write_json_array(df: DataFrame, path: str, order: list) -> None:
    """One JSON array over all parts, an object a line, keys in order, nulls written."""
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"})
    df.orderBy(*order).select(row.alias("row")).write.option("lineSep", ",\n").text(staged)
    _finish(df.sparkSession, staged, path, "[\n", "\n]\n", between=2)


def write_summary(df: DataFrame, path: str, order: list) -> None:
    """A table as a single file of one JSON array, of any length."""
    parted = f"{path}.parts"
    write_json_array(df, parted, order)
    concatenate(df.sparkSession, parted, path)
    reset(df.sparkSession, parted)


def write_findings(findings: DataFrame, path: str) -> None:
    """Findings as JSON lines, by kind, code, message and citation."""
    write_json_lines(findings, path, findings_order())


def row_hash(df: DataFrame) -> Column:
    """A hash of the row as a number that sums without overflow."""
    return (F.xxhash64(*sortables(df)) if df.columns else F.lit(0)).cast("decimal(38,0)")


def catalogue(tables: Mapping[str, DataFrame]) -> DataFrame:
    """name, columns, row_count and fingerprint of tables, each read once, and a row for the catalogue itself."""
    spark = next(iter(tables.values())).sparkSession
    each = [content_fingerprint(df).select(F.lit(name).alias("name"), F.lit(json.dumps(df.columns)).alias("columns"), F.col("rows").alias("row_count"), "fingerprint") for name, df in tables.items()]
    own = spark.createDataFrame([("catalogue", json.dumps(["name", "columns", "row_count", "fingerprint"]), len(tables) + 1, None)], "name string, columns string, row_count long, fingerprint string")
    return reduce(DataFrame.unionByName, [own, *each])


def content_fingerprint(df: DataFrame) -> DataFrame:
    """rows and sum of row hashes: equal for equal bags of rows, whatever the order and files."""
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(row_hash(df)), F.lit(0)).cast("string").alias("fingerprint"))


def range_fingerprints(df: DataFrame, keys: list[str], digits: int = 2) -> DataFrame:
    """range, rows and fingerprint of the rows whose keys' md5 begins with the digits ``range``, for 0 to ``digits`` of them: a tree whose root is the table's own
    fingerprint, as sums of a node's children are its own. One pass over the rows."""
    key = F.md5(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))
    leaves = df.select(F.substring(key, 1, digits).alias("range"), row_hash(df).alias("h")).groupBy("range").agg(F.count("*").alias("rows"), F.sum("h").alias("h"))
    nodes = leaves.select(F.explode(F.sequence(F.lit(0), F.lit(digits))).alias("level"), "range", "rows", "h").groupBy(F.expr("substring(range, 1, level)").alias("range")).agg(F.sum("rows").alias("rows"), F.sum("h").cast("string").alias("fingerprint"))
    return nodes


def changed_key_ranges(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """range, rows_expected and rows_actual of the nodes of two trees that differ; those of most digits name the keys."""
    both = expected.select("range", F.col("rows").alias("r"), F.col("fingerprint").alias("f")).join(actual, "range", "full_outer")
    changed = both.where(~F.col("f").eqNullSafe(F.col("fingerprint")) | ~F.col("r").eqNullSafe(F.col("rows")))
    return changed.select("range", F.coalesce("r", F.lit(0)).alias("rows_expected"), F.coalesce("rows", F.lit(0)).alias("rows_actual"))


def listed(spark: SparkSession, path: str) -> DataFrame:
    """root, path, name (below ``path``) and bytes of the files there, empty ones and the lists of exports too, without Hadoop's own checksums. A row a file passes the driver; of the contents nothing is read."""
    root = qualify(spark, path)
    store, base = store_of(root)
    found = [f for f in store.get_file_info(fs.FileSelector(base, recursive=True)) if f.is_file and not (f.base_name.startswith(".") and f.base_name.endswith(".crc"))]
    rows = [(root, f.path, f.path[len(base.rstrip("/")) + 1 :], f.size) for f in found]
    return spark.createDataFrame(rows, "root string, path string, name string, bytes long")


def ranges(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """name, bytes, at, size and sha256 of the byte ranges of the files below a path; each is hashed by itself, so a large file is no one task's."""
    files = listed(spark, path)
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(size).cast("long"))
    cut = files.select("root", "path", "name", "bytes", F.explode(starts).alias("at")).withColumn("size", F.least(F.lit(size), F.col("bytes") - F.col("at")))
    return _hashed(cut.repartition("path", "at"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """name, bytes and sha256 of the files below a path, of any size: read as streams, some MB at a time."""
    files = listed(spark, path)
    return _hashed(files.withColumns({"at": F.lit(0).cast("long"), "size": F.col("bytes")}).repartition("path")).select("name", "bytes", "sha256")


def _hashed(cut: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                store, path = store_of(r["root"])[0], r["path"]
                digest, left = hashlib.sha256(), r["size"]
                with store.open_input_file(path) as stream:
                    stream.seek(r["at"])
                    while left and (block := stream.read(min(left, 4 << 20))):
                        digest.update(block)
                        left -= len(block)
                if left:
                    raise OSError(f"{path} has become shorter")
                yield pa.RecordBatch.from_pylist([{k: r[k] for k in ("name", "bytes", "at", "size")} | {"sha256": digest.hexdigest()}])

    return cut.select("root", "path", "name", "bytes", "at", "size").mapInArrow(run, "name string, bytes long, at long, size long, sha256 string")


def range_tree(hashed: DataFrame) -> DataFrame:
    """name, bytes and tree: a file's range digests in order, hashed as one text; a file's ranges are its size by theirs."""
    each = F.transform(F.array_sort(F.collect_list(F.struct("at", "sha256"))), lambda x: x["sha256"])
    return hashed.groupBy("name").agg(F.max("bytes").alias("bytes"), F.sha2(F.array_join(each, ""), 256).alias("tree"))


def changed_ranges(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """name, at and problem (missing, unexpected, changed) of byte ranges that aren't as listed."""
    both = expected.select("name", "at", F.col("sha256").alias("s"), F.lit(True).alias("e")).join(actual.select("name", "at", "sha256", F.lit(True).alias("a")), ["name", "at"], "full_outer")
    problem = F.when(F.col("a").isNull(), "missing").when(F.col("e").isNull(), "unexpected").when(~F.col("s").eqNullSafe(F.col("sha256")), "changed")
    return both.select("name", "at", problem.alias("problem")).where("problem IS NOT NULL")


def verify_manifest(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """name and problem (missing, unexpected, changed) of files that aren't as listed."""
    both = expected.withColumnsRenamed({"bytes": "b", "sha256": "s"}).join(actual, "name", "full_outer")
    problem = F.when(F.col("bytes").isNull(), "missing").when(F.col("b").isNull(), "unexpected").when(~F.col("s").eqNullSafe(F.col("sha256")), "changed")
    return both.select("name", problem.alias("problem")).where("problem IS NOT NULL")


def safe_path(name: str) -> str:
    """The relative path, or an error for one that is empty, absolute, or leads up or to another drive or scheme."""
    parts = name.split("/")
    if not name or name.startswith("/") or "\\" in name or ":" in name or "\0" in name or any(p in ("", ".", "..") for p in parts):
        raise ValueError(f"unsafe path: {name!r}")
    return name


def write_bundle(tables: dict[str, DataFrame], path: str, keys: dict[str, list[str]], views: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Tables as Parquet under a path, swapped in together, after their primary keys are checked; ``views`` are further names of tables. Returns
    what was written, by name: the caller makes views of them, or not."""
    spark = next(iter(tables.values())).sparkSession
    for name, key in keys.items():
        if not tables[name].groupBy(*key).count().where("count > 1").isEmpty():
            raise ValueError(f"{name}: {', '.join(key)} is no key")
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    for name, df in tables.items():
        blank_nulls(df).write.parquet(f"{staged}/{safe_path(name)}")
    swap(spark, staged, path)
    return {name: spark.read.parquet(f"{path}/{of}") for name, of in ({n: n for n in tables} | (views or {})).items()}


def write_export(tables: dict[str, tuple[DataFrame, list]], path: str, kind: str = "csv") -> None:
    """Tables, each with its order, as ``name.kind`` below a path; a name that leads elsewhere is an error before anything is written."""
    writer = {"csv": write_csv, "jsonl": write_json_lines, "json": write_json_array}[kind]
    for name, (df, order) in [(f"{safe_path(n)}.{kind}", t) for n, t in tables.items()]:
        writer(df, f"{path.rstrip('/')}/{name}", order)
