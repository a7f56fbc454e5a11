"""Holdout split (C5: W6, W7, J5, A13).

The test users are the most active ones; each gives up its k lowest item
ids as the held-out set, the rest stays in training.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate import ITEM, RATING, USER
from corate.operators.topk import number_rows, top_k


def active_users(ratings: DataFrame, n: int = 25, user: str = USER) -> DataFrame:
    """The ``n`` users with most ratings (W6): ``user_id, n_ratings, rank``.

    Ties go to the smaller user id. The limit is the feature: a top-n
    report. Counting is a partial aggregation; the ordered limit keeps n
    rows per map task.
    """
    counts = ratings.groupBy(user).agg(F.count(F.lit(1)).alias("n_ratings"))
    top = counts.orderBy(F.col("n_ratings").desc(), F.col(user).asc()).limit(n)
    return number_rows(top.coalesce(1), [], [F.col("n_ratings").desc(), F.col(user).asc()])


def holdout(ratings: DataFrame, test_users: DataFrame, k: int = 10, user: str = USER,
            item: str = ITEM, rating: str = RATING) -> tuple[DataFrame, DataFrame]:
    """(test, train): test = each test user's ``k`` lowest item ids (W7);
    train = all ratings minus test (J5, left anti-join on user and item)."""
    mine = ratings.join(test_users.select(user), user, "left_semi")
    test = top_k(mine, user, [F.col(item).asc()], k).select(user, item, rating)
    train = ratings.join(test.select(user, item), [user, item], "left_anti")
    return test, train


def holdout_users(test: DataFrame, user: str = USER) -> DataFrame:
    """Distinct users of the held-out set."""
    return test.select(user).distinct()
