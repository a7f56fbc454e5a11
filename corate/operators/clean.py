"""Cleaning and per-key statistics.

Per-key statistics are computed with ``groupBy`` (partial aggregation before
the shuffle, so a key holding a third of the rows costs one small row per
map task), written, and joined back as a plain scan: Spark broadcasts them
when their files are small, and otherwise both sides of the join are plain
shuffles, of which adaptive execution splits a skewed key (it does not if an
aggregate stands between the join and its shuffle). No per-key window is
used, because a window keeps a whole key in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate import ITEM, RATING, USER
from corate.functions.measures import fixed_point
from corate.operators.exact import sums_of
from corate.session import materialize

_POLICIES = ("max", "min", "avg", "last")


def dedup_ratings(df: DataFrame, policy: str = "max", user: str = USER,
                  item: str = ITEM, rating: str = RATING,
                  order_col: str | None = None) -> DataFrame:
    """One row per (user, item).

    ``max``/``min``/``avg`` combine repeated ratings; ``last`` keeps the one
    with the greatest ``order_col`` (ties: greatest rating).
    """
    if policy not in _POLICIES:
        raise ValueError(f"policy must be one of {_POLICIES}")
    g = df.groupBy(user, item)
    if policy == "max":
        out = g.agg(F.max(rating).alias(rating))
    elif policy == "min":
        out = g.agg(F.min(rating).alias(rating))
    elif policy == "avg":
        sums = sums_of(df, rating)
        out = g.agg(*sums.aggregates(F.col(rating), "_sum"), F.count(rating).alias("_n"))
        out = out.withColumn(rating, sums.total("_sum") / F.col("_n"))
    else:
        if order_col is None:
            raise ValueError("policy 'last' needs order_col")
        out = g.agg(F.max_by(F.col(rating), F.struct(order_col, rating)).alias(rating))
    return out.select(user, item, F.col(rating).cast("double").alias(rating))


def distinct_triples(df: DataFrame, user: str = USER, item: str = ITEM,
                     rating: str = RATING) -> DataFrame:
    """Set semantics of the reference vectors: exact duplicates collapse,
    one item with two ratings stays twice (A1 as written)."""
    return df.dropDuplicates([user, item, rating])


def truncate_ratings(df: DataFrame, rating: str = RATING) -> DataFrame:
    """Floor ratings to whole numbers (F3), kept as double."""
    return df.withColumn(rating, F.floor(F.col(rating)).cast("double"))


def rating_histogram(df: DataFrame, item: str = ITEM, rating: str = RATING,
                     levels=(1, 2, 3, 4, 5)) -> DataFrame:
    """Per item, how many ratings have each value (A4): ``r1..r5`` columns.
    A rating that is none of ``levels`` fails the job, as it does in the
    reference."""
    r = F.when(F.col(rating).isin([float(v) for v in levels]), F.col(rating)).otherwise(
        F.raise_error(F.concat(F.lit("rating outside the levels: "),
                               F.coalesce(F.col(rating).cast("string"), F.lit("null")))).cast("double"))
    aggs = [F.count_if(F.col("_r") == F.lit(float(v))).alias(f"r{v}") for v in levels]
    return df.select(item, r.alias("_r")).groupBy(item).agg(*aggs)


def with_bucket_count(df: DataFrame, item: str = ITEM, rating: str = RATING,
                      out: str = "bucket_count") -> DataFrame:
    """Attach to each rating the number of ratings of the same item with the
    same value (J1)."""
    counts = materialize(df.groupBy(item, rating).agg(F.count(F.lit(1)).alias(out)), "bucket-counts")
    return df.join(counts, [item, rating])


def mean_centred(df: DataFrame, by: str, rating: str = RATING,
                 out: str = "centred", scale: float | None = None) -> DataFrame:
    """rating - mean(rating of the same ``by`` key) (P8 by user, P9 by item).

    The mean is sum/count of the key; the sum does not depend on the order
    of rows, also for fractional ratings. With ``scale`` the deviation is
    returned as a fixed-point long, ``round_half_up(dev * scale)``, whose
    sums are exact (used by adjusted cosine, D5).
    """
    sums = sums_of(df, rating)
    stats = df.groupBy(by).agg(*sums.aggregates(F.col(rating), "_sum"), F.count(F.lit(1)).alias("_n"))
    stats = materialize(stats.select(by, sums.total("_sum").alias("_s"), "_n"), "key-means")
    dev = F.col(rating) - F.col("_s") / F.col("_n")
    j = df.join(stats, by)
    val = fixed_point(dev, scale) if scale else dev
    return j.withColumn(out, val).drop("_s", "_n")
