"""Quality metrics of a recommendation against a held-out set (G9, G10,
G11, J10, A16).

Both are computed per user with joins and aggregations and then averaged
over the held-out users; a user without recommendations still counts (its
error is the norm of its held-out ratings, its overlap 0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate import ITEM, RATING, USER

ROUND = 9  # metric digits (sums of doubles differ in the last bit between engines)


def euclidean_per_user(recommended: DataFrame, test: DataFrame, value: str = "prediction",
                       user: str = USER, item: str = ITEM, rating: str = RATING) -> DataFrame:
    """sqrt(sum over the union of items of (predicted - held-out)^2), a
    missing side counting 0 (G9). One row per held-out user."""
    rec = (recommended.join(test.select(user).distinct(), user, "left_semi")
           .select(user, item, F.col(value).alias("_p")))
    t = test.select(user, item, F.col(rating).alias("_t"))
    d = F.coalesce(F.col("_p"), F.lit(0.0)) - F.coalesce(F.col("_t"), F.lit(0.0))
    return (rec.join(t, [user, item], "full")
            .groupBy(user).agg(F.sqrt(F.sum(d * d)).alias("error")))


def jaccard_per_user(recommended: DataFrame, test: DataFrame, user: str = USER,
                     item: str = ITEM) -> DataFrame:
    """|R intersect T| / |R union T| on item ids per held-out user (G10,
    G11), with true division."""
    rec = (recommended.join(test.select(user).distinct(), user, "left_semi")
           .select(user, item, F.lit(1).alias("_r")).distinct())
    t = test.select(user, item, F.lit(1).alias("_t")).distinct()
    j = rec.join(t, [user, item], "full")
    return j.groupBy(user).agg(
        (F.count_if(F.col("_r").isNotNull() & F.col("_t").isNotNull()).cast("double")
         / F.count(F.lit(1)).cast("double")).alias("jaccard"))


def mean_metric(per_user: DataFrame, value: str, test: DataFrame, user: str = USER,
                out: str | None = None) -> DataFrame:
    """Average over all held-out users (A16): ``n_users, <out>``."""
    users = test.select(user).distinct()
    j = users.join(per_user, user, "left").select(F.coalesce(F.col(value), F.lit(0.0)).alias("_v"))
    return j.agg(F.count(F.lit(1)).alias("n_users"),
                 F.round(F.avg("_v"), ROUND).alias(out or f"mean_{value}"))
