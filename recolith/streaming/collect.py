"""Repeated collection as a stream: an extension, for sources that arrive in batches; the state after all is that of one batch.

Records are kept by source and key: a micro-batch replaces the records that it holds, so a source may be spread over batches, and reading a batch again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sinks import upsert


def collect_stream(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """``records`` (a stream of RECORD rows) to the table at ``path``, a row a source and key; runs what is there and stops."""
    return records.writeStream.foreachBatch(lambda df, _: upsert(df, path, ["source", "key"])).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, time: str = "ts", late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Events by type in tumbling windows, with a watermark; for streams and tables alike."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    return rows.groupBy(F.window(time, window), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "event_type", "n")
