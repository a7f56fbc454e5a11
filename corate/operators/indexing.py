"""Dense indexes and dictionary encode/decode.

:func:`dense_index` numbers the distinct keys 0..n-1 in key order without a
single-partition window and without sending keys to the driver:

1. range-partition the distinct keys and sort inside each partition, so
   partition p holds the p-th slice of the order;
2. ``monotonically_increasing_id()`` gives (partition << 33) + position;
3. the rows are written (in the run's folder under ``spark.checkpoint.dir``),
   which freezes that numbering: range bounds come from sampling and a
   recomputation could move rows between partitions;
4. per-partition counts (one row per partition, a bounded table) give
   each partition's offset, which is broadcast and added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corate.session import materialize

_LOW_BITS = (1 << 33) - 1


def dense_index(df: DataFrame, keys: Sequence[str] | str, order: Sequence[Column] | None = None,
                id_col: str = "id", num_partitions: int | None = None) -> DataFrame:
    """Distinct ``keys`` of ``df`` with a dense ``id_col`` (long, from 0) in
    ``order`` (default: keys ascending). The order must be total on the
    distinct keys for the numbering to be unique."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = list(order) if order else [F.col(k).asc() for k in keys]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.select(*keys).dropna().distinct()
                         .repartitionByRange(n, *order)
                         .sortWithinPartitions(*order)
                         .withColumn("_mid", F.monotonically_increasing_id()), "dense-index")
    part = F.shiftright(F.col("_mid"), 33)
    counts = ranged.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    return (ranged.withColumn("_p", part)
            .join(F.broadcast(offsets), "_p")
            .select(*keys, (F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))
                    .cast("bigint").alias(id_col)))


def build_index(df: DataFrame, key: str, out_key: str = "key", id_col: str = "id") -> DataFrame:
    """``(key string, id long)`` dictionary of the distinct values of ``key``."""
    return dense_index(df, key, id_col=id_col).select(
        F.col(key).cast("string").alias(out_key), F.col(id_col))


def extend_index(index: DataFrame, df: DataFrame, key: str, index_key: str = "key",
                 id_col: str = "id") -> DataFrame:
    """``index`` with the values of ``key`` it lacks, numbered in key order
    after its largest id. Every old key keeps its id, so triples encoded with
    the old index stay valid; extending again with the same keys adds none."""
    old = index.select(F.col(index_key).cast("string").alias(index_key), F.col(id_col).cast("bigint").alias(id_col))
    new = df.select(F.col(key).cast("string").alias(index_key)).dropna().distinct().join(old, index_key, "left_anti")
    numbered = dense_index(new, index_key, id_col=id_col)
    start = old.agg((F.coalesce(F.max(id_col), F.lit(-1)) + 1).alias("_start"))  # one row
    added = numbered.join(F.broadcast(start)).select(index_key, (F.col(id_col) + F.col("_start")).alias(id_col))
    return old.unionByName(added)


def encode(df: DataFrame, index: DataFrame, col: str, out: str,
           index_key: str = "key", index_id: str = "id", keep_unknown: bool = False) -> DataFrame:
    """Replace the name column ``col`` by its id ``out``.

    Unknown names are dropped (P7) unless ``keep_unknown`` (then NULL id).
    Spark chooses broadcast or shuffle join from the index's measured size.
    """
    ix = index.select(F.col(index_key).alias(col), F.col(index_id).alias(out))
    return df.join(ix, col, "left" if keep_unknown else "inner").drop(col)


def decode(df: DataFrame, index: DataFrame, col: str, out: str,
           index_key: str = "key", index_id: str = "id", keep_unknown: bool = False) -> DataFrame:
    """Replace the id column ``col`` by its name ``out`` (J4, reverse lookup)."""
    ix = index.select(F.col(index_id).alias(col), F.col(index_key).alias(out))
    return df.join(ix, col, "left" if keep_unknown else "inner").drop(col)
