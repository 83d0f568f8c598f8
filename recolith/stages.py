"""Tables between the stages of a plan: what several outputs read is written once, to the folder that driver and executors share.

Lineage ends there, so the loss of an executor repeats none of the work before it, and plans stay small. Nothing is cached.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where the session names none and driver and executors are one process (a local master), one is made and set. On a
    cluster that is an error: what executors write to a folder of their own machine, others would read as missing or empty.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="recolith-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to the shared folder and read back."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` dealt over all cores, some tasks each. A compressed file of some MB is read by one task, and what its rows go through would be one core's."""
    spark = rows.sparkSession
    return rows.repartition(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def clean_up(spark: SparkSession) -> None:
    """Deletes the tables and files that this application has written to the shared folder. Results that
    read them must be written elsewhere before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
