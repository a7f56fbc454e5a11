"""Map the driver's parquet tables onto the rating data model.

``lineitem`` joined to ``orders`` gives who bought which part how many
times; the quantity (integral 1..50) is folded onto the 1..5 rating scale.
``customer.c_name`` serves as the external user key and ``'P' || p_partkey``
as the external item key (``p_name`` is not unique, so it is only used for
id -> name display). ``events.props`` carries a JSON item reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corate import ITEM, RATING, USER
from corate.operators.clean import dedup_ratings


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quantity_rating(q):
    """1..50 -> 1..5: ((q - 1) mod 5) + 1."""
    return (F.pmod(q.cast("int") - 1, F.lit(5)) + 1).cast("double")


def raw_order_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: ``(user_id, item_id, rating)``, duplicates kept."""
    li = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias(USER), F.col("l_partkey").alias(ITEM),
                    quantity_rating(F.col("l_quantity")).alias(RATING)))


def order_ratings(spark: SparkSession, sf_dir: str, policy: str = "max") -> DataFrame:
    """The central ``ratings`` table: one row per (user, item)."""
    return dedup_ratings(raw_order_triples(spark, sf_dir), policy=policy)


def basket_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse ratings: user = order, item = part, the largest per pair."""
    li = load_table(spark, sf_dir, "lineitem")
    return dedup_ratings(li.select(F.col("l_orderkey").alias(USER), F.col("l_partkey").alias(ITEM),
                                   quantity_rating(F.col("l_quantity")).alias(RATING)))


def named_order_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings keyed by external names: ``(reviewerID, asin, overall)``.

    The review-shaped form the ETL job (C1) consumes.
    """
    r = order_ratings(spark, sf_dir)
    cust = load_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return (r.join(cust, r[USER] == cust.c_custkey)
            .select(F.col("c_name").alias("reviewerID"),
                    F.concat(F.lit("P"), F.col(ITEM).cast("string")).alias("asin"),
                    F.col(RATING).alias("overall")))


def event_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings from the ``events`` stream table: item from ``props.k``.

    rating = min(5, 1 + floor(value / 20)); max per (user, item).
    """
    ev = load_table(spark, sf_dir, "events").select("user_id", "value", "props")
    k = F.get_json_object(F.col("props"), "$.k")
    raw = ev.select(F.col("user_id").alias(USER), k.try_cast("bigint").alias(ITEM),
                    F.least(F.lit(5.0), F.lit(1.0) + F.floor(F.col("value") / 20)
                            ).cast("double").alias(RATING))
    return dedup_ratings(raw.where(F.col(ITEM).isNotNull() & F.col(RATING).isNotNull()))
