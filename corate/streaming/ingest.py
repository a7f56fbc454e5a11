"""Streaming ingest of rating triples (S1 on a stream, K6 as the sink)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from corate.sources.text import parse_triples


def read_triples_stream(spark: SparkSession, path: str, mode: str = "strict",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of ``(user_id, item_id, rating)`` from new text
    files under ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_triples(reader.load(path), mode=mode)


def ingest_triples(stream: DataFrame, table_path: str, checkpoint: str,
                   once: bool = False) -> StreamingQuery:
    """Append parsed triples to a Parquet table (exactly-once through the
    file sink's log and ``checkpoint``)."""
    w = (stream.writeStream.format("parquet").option("path", table_path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if once:
        w = w.trigger(availableNow=True)
    return w.start()
