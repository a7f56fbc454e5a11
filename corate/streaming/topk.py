"""Top-k lists over a stream (A15): the state of a group is its k best rows.

Each micro-batch is cut to k rows a group in the map tasks, merged with the
group's state and, where a group has new rows, written as one list to the
folder ``batch=<id>`` of a Parquet table. A batch that is run again after a
failure overwrites its own folder, so every list is written once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corate.operators.topk import top_k_list, unfold_lists


def stream_top_k(stream: DataFrame, by: Sequence[str], order: Sequence[tuple[str, str]], k: int, table_path: str,
                 checkpoint: str, fields: Sequence[str] = (), once: bool = False) -> StreamingQuery:
    """Keep the first ``k`` rows of each ``by`` group of all rows seen so far
    (``order`` as in :func:`top_k_list`). ``once`` reads what is there and stops."""
    lists = stream.groupBy(*by).agg(top_k_list(stream, order, k, fields).alias("top"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/batch={batch_id}")

    w = lists.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    if once:
        w = w.trigger(availableNow=True)
    return w.start()


def read_top_k(spark: SparkSession, table_path: str, by: Sequence[str]) -> DataFrame:
    """The latest lists, one row per entry with its ``rank``. The lists of
    older batches stay in the table; folders of batches whose groups all
    have newer lists may be deleted."""
    latest = spark.read.parquet(table_path).groupBy(*by).agg(F.max_by("top", "batch").alias("top"))
    return unfold_lists(latest, by)
