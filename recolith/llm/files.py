"""Files that tasks write and read in the shared folder.

A task writes files of its own names and returns a row for each; only the rows of tasks that succeeded reach
the driver, and readers open only the files of such a list. A task that is run again, or twice, thus leaves
nothing that counts. The list has a row a file, not a document.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from .. import stores
from ..stores import file_system


def qualify(spark: SparkSession, folder: str) -> str:
    """The folder, made, by the URI of the store that has it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return stores.qualify(spark, folder)


def open_new(folder: str, name: str) -> Any:
    files, path = file_system(folder)
    files.create_dir(path, recursive=True)
    return files.open_output_stream(f"{path}/{name}")


def open_old(path: str) -> Any:
    files, path = file_system(path)
    return files.open_input_stream(path)


def as_table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """The list of files as a table, a file a partition."""
    found = spark.createDataFrame(rows, schema)
    return found.repartition(max(1, len(rows)))
