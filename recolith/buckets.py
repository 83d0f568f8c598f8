"""Tables that are written by parts: upserts by key and replacement by source, which rewrite the parts that they touch and no others.

A table is a Parquet directory in partitions: of ``bucket``, a hash of the key, for upserts, of ``source`` for replacements. What a batch touches is read, merged, written beside
the table by Spark's writer and moved in, part by part. Until all of it is written the table is as it was; from then on
(``NEXT`` is there) ``recover``, which the next writer calls first, finishes what was begun. One writer at a time; a reader meanwhile sees
parts of both states.

A bucket is named with the number of all of them (``bucket=0003of0256``). When buckets have grown past ``BUCKET_BYTES`` twice over, the table is rewritten once with four times as many.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from .sources.state import exists
from .stages import materialise

#: What is put behind the name of a table that has moved aside, and of parts that are about to move in.
ASIDE, NEXT = ".old", ".next"
BUCKET_BYTES, MOST_BUCKETS = 64 << 20, 1 << 14
#: Rows of a first batch that ask for a bucket.
BUCKET_ROWS = 1 << 18


def file_system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def swap(spark: SparkSession, staged: str, path: str) -> None:
    """``staged`` takes the place of ``path``."""
    files, new = file_system(spark, staged)
    old = spark._jvm.org.apache.hadoop.fs.Path(path)
    files.mkdirs(old.getParent())
    recover(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + ASIDE)
    if files.exists(old) and not files.rename(old, aside):
        raise OSError(f"{path} can't be moved aside")
    if not files.rename(new, old):
        recover(spark, path)
        raise OSError(f"{staged} can't be moved to {path}")
    files.delete(aside, True)


def recover(spark: SparkSession, path: str) -> None:
    """After a writer that was lost: a table that moved aside comes back where no new one has come, else it goes; parts that were complete move in."""
    path = path.rstrip("/")
    files, table = file_system(spark, path)
    Path = spark._jvm.org.apache.hadoop.fs.Path  # noqa: N806
    aside, parts = Path(path + ASIDE), Path(path + NEXT)
    if files.exists(aside):
        if files.exists(table):
            files.delete(aside, True)
        else:
            files.rename(aside, table)
    if files.exists(parts):
        files.mkdirs(table)
        for part in files.listStatus(parts):  # a row a touched part
            if part.isDirectory():
                new, old = part.getPath(), Path(f"{path}/{part.getPath().getName()}")
                files.delete(old, True)
                if len(files.listStatus(new)) and not files.rename(new, old):
                    raise OSError(f"{new} can't be moved to {old}")
        files.delete(parts, True)


def move_in(spark: SparkSession, staged: str, path: str, emptied: list[str] = ()) -> None:
    """The parts below ``staged`` take the place of those of the table; parts named in ``emptied`` go."""
    files, new = file_system(spark, staged)
    Path = spark._jvm.org.apache.hadoop.fs.Path  # noqa: N806
    for name in emptied:
        files.mkdirs(Path(f"{staged}/{name}"))
    if not files.rename(new, Path(path.rstrip("/") + NEXT)):
        raise OSError(f"{staged} can't be moved to {path}{NEXT}")
    recover(spark, path)


def sortable(value: Column, kind: DataType) -> Column:
    """The value in a form that Spark orders and hashes: maps as their entries in order, whatever they are nested in."""
    if isinstance(kind, MapType):
        entries = F.map_entries(value)
        if "map<" in kind.valueType.simpleString():
            entries = F.transform(entries, lambda e: F.struct(e["key"].alias("key"), sortable(e["value"], kind.valueType).alias("value")))
        return F.sort_array(entries)  # compiled, unlike array_sort; entries are never null
    if "map<" not in kind.simpleString():
        return value
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: sortable(x, kind.elementType))
    if isinstance(kind, StructType):
        fields = [sortable(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return F.to_json(F.struct(value))


def sortables(df: DataFrame) -> list[Column]:
    return [sortable(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]


def one_a_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Of the rows of a key that which is largest, column by column."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    order = F.struct(*[sortable(F.col(c), df.schema[c].dataType).alias(f"c{i}") for i, c in enumerate(rest)])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__row")).select(*keys, "__row.*").select(*df.columns)


def bucket_of(keys: list[str], buckets: int) -> Column:
    number = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")
    return F.concat(F.repeat(F.lit("0"), 5 - F.length(number)), number, F.lit(f"of{buckets:05d}"))


def _parts(spark: SparkSession, path: str) -> list[str]:
    files, table = file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(table) if s.isDirectory()] if files.exists(table) else []


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table that ``upsert`` has written."""
    return spark.read.parquet(path).drop("bucket")


def _count(parts: list[str]) -> int:
    """How many buckets the table has, as its parts' names say; 0 if it isn't there."""
    return next((int(p.rsplit("of", 1)[1]) for p in parts if p.startswith("bucket=")), 0)


def _touched(rows: DataFrame, by: list[str], count: int) -> list[str]:
    return sorted(r["bucket"] for r in rows.select(bucket_of(by, count).alias("bucket")).distinct().collect())  # some of ``count`` names


def lookup(spark: SparkSession, path: str, wanted: DataFrame, by: list[str], schema: StructType) -> DataFrame:
    """Rows of the table whose columns ``by``, which place them, are those of a row of ``wanted``. Only the buckets that may have some are read."""
    recover(spark, path)
    count = _count(_parts(spark, path))
    if not count:
        return spark.createDataFrame([], schema)
    keys = wanted.select(*by).distinct()
    rows = spark.read.schema(StructType([*schema.fields, StructField("bucket", StringType())])).parquet(path).where(F.col("bucket").isin(_touched(keys, by, count))).drop("bucket")
    names = {c: f"__{c}" for c in by}
    return rows.join(keys.withColumnsRenamed(names), [rows[c].eqNullSafe(F.col(n)) for c, n in names.items()], "left_semi")


def upsert(df: DataFrame, path: str, keys: list[str], buckets: int | None = None, bucket_bytes: int = BUCKET_BYTES, by: list[str] | None = None, deleted: DataFrame | None = None) -> list[str]:
    """Rows of ``df`` replace those of the same keys, null keys included. Of rows of ``df`` that share a key the one that is largest, column by column, counts.

    ``deleted``: keys whose rows go, unless ``df`` has them. ``by``: those of the keys that place a row in a bucket, by default all. ``buckets`` is for a table that isn't there yet. Returns
    the names of the parts that were written.
    """
    spark, by = df.sparkSession, by or keys
    path = path.rstrip("/")
    if "bucket" in df.columns:
        raise ValueError("the column bucket is the table's own")
    recover(spark, path)
    new = materialise(one_a_key(df, keys), "upsert")
    found = _parts(spark, path)
    count = _count(found) or buckets or min(MOST_BUCKETS, max(1, 1 << (new.count() // BUCKET_ROWS).bit_length()))
    bucket = bucket_of(by, count).alias("bucket")
    row = F.struct(*df.columns).alias("row")
    changes = new.select(bucket, *keys, F.lit(2).alias("rank"), row)
    if deleted is not None:
        changes = changes.unionByName(deleted.select(bucket, *keys, F.lit(1).alias("rank")).withColumn("row", F.lit(None).cast(changes.schema["row"].dataType)))
    touched = sorted(r["bucket"] for r in changes.select("bucket").distinct().collect())  # some of ``count`` names
    if not touched:
        return []
    there = {p.removeprefix("bucket=") for p in found}
    old = [b for b in touched if b in there]
    if old:
        kept = spark.read.schema(StructType([*df.schema.fields, StructField("bucket", StringType())])).parquet(path).where(F.col("bucket").isin(old))
        changes = changes.unionByName(kept.select("bucket", *keys, F.lit(0).alias("rank"), row))
    # dealt by bucket, which the grouping takes as it is: one shuffle, a file a bucket
    merged = changes.repartition(len(touched), "bucket").groupBy("bucket", *keys).agg(F.max_by(F.struct("row"), "rank").alias("row"))
    staged = f"{path}.{uuid.uuid4().hex}"
    merged.select("bucket", "row.row").where("row IS NOT NULL").select("bucket", "row.*").write.partitionBy("bucket").parquet(staged)
    full = set(_parts(spark, staged))
    move_in(spark, staged, path, [f"bucket={b}" for b in old if f"bucket={b}" not in full])
    files, _ = file_system(spark, path)
    sizes = [files.getContentSummary(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{p}")).getLength() for p in sorted(full)]
    if sum(sizes) > 2 * bucket_bytes * max(1, len(sizes)) and count < MOST_BUCKETS:
        rebucket(spark, path, by, 4 * count)
    return [f"bucket={b}" for b in touched]


def rebucket(spark: SparkSession, path: str, by: list[str], buckets: int) -> None:
    """The whole table in another number of buckets."""
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    read_table(spark, path).withColumn("bucket", bucket_of(by, buckets)).repartition("bucket").write.partitionBy("bucket").parquet(staged)
    swap(spark, staged, path)


def replace_source(df: DataFrame, path: str, sources: list[str]) -> None:
    """The partitions of ``sources`` are replaced by the rows of ``df``, which must be theirs; others stay. A source that has no rows any more has none afterwards."""
    spark = df.sparkSession
    path = path.rstrip("/")
    if not df.where(F.coalesce(~F.col("source").isin(*sources), F.lit(True))).isEmpty():
        raise ValueError("rows of other sources than those that are replaced")
    recover(spark, path)
    staged = f"{path}.{uuid.uuid4().hex}"
    df.write.partitionBy("source").parquet(staged)
    named = [f"source={spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(s)}" for s in sources]
    full = set(_parts(spark, staged))
    move_in(spark, staged, path, [n for n in named if n not in full])
