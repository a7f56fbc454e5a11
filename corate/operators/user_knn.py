"""User k-nearest neighbours for a batch of query users (C4: P3, P4, J8, J9,
G7, G8, W2, W3).

The reference scores one query user at a time against every other user.
Here all query users are scored in one job: the query users' ratings are
joined on item with everyone's ratings (:func:`fanout_join`: broadcast
when the query side is within a byte bound, else hot items split), so only
users sharing at least one item meet, and per (query,
other) pair one aggregation yields

* ``common``  number of shared items,
* ``gain``    sum over shared items of |a| + |b| - |a - b|,
* ``agree``   sum over shared items of 5 - |a - b|.

From those and per-user totals (n = ratings, S = sum |rating|):

* L1 distance over the union of items (missing = 0) = S_q + S_v - gain;
* agreement = agree / (n_q + n_v - common).

Users sharing no item with the query still have an L1 distance
(S_q + S_v) and can be nearest. They rank among themselves by S_v, so only
the first k of them in (S_v, user) order can enter a list;
:func:`_free_users` finds exactly those in the gaps between the ranks of the
users that do overlap. The agreement of such users is 0 and they compete by
the lowest user id; ``fill=False`` leaves them out. They are looked up only
for query users with fewer than k similar users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate import ITEM, RATING, USER
from corate.functions.measures import agreement, l1_from_overlap
from corate.operators.exact import Sums, sums_of
from corate.operators.indexing import dense_index
from corate.operators.pairs import DEFAULT_BLOCK_ROWS, DEFAULT_BROADCAST_BYTES, fanout_join, free_ranks
from corate.operators.topk import top_k
from corate.session import materialize

QUERY = "query_user"
MAX_RATING = 5.0  # top of the rating scale (fixed by the reference)


def user_totals(ratings: DataFrame, user: str = USER, rating: str = RATING,
                sums: Sums = Sums()) -> DataFrame:
    """``user_id, n, s_abs`` per user."""
    tot = ratings.groupBy(user).agg(F.count(F.lit(1)).alias("n"), *sums.aggregates(F.abs(F.col(rating)), "_s"))
    return tot.select(user, "n", sums.total("_s").alias("s_abs"))


def user_vectors(ratings: DataFrame, query_users: DataFrame, user: str = USER) -> DataFrame:
    """Ratings of the query users only (P3 for a batch: a semi-join)."""
    return ratings.join(query_users.select(user).distinct(), user, "left_semi")


def user_overlap(ratings: DataFrame, query_users: DataFrame, user: str = USER,
                 item: str = ITEM, rating: str = RATING,
                 block_rows: int = DEFAULT_BLOCK_ROWS,
                 max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                 sums: Sums = Sums()) -> DataFrame:
    """``query_user, user_id, common, gain, agree`` for every other user
    sharing at least one item with a query user (self excluded, P4).
    ``sums`` (:func:`sums_of` the ratings) keeps fractional ratings exact."""
    q = user_vectors(ratings, query_users, user).select(
        F.col(user).alias(QUERY), F.col(item), F.col(rating).alias("_a"))
    o = ratings.select(F.col(user), F.col(item), F.col(rating).alias("_b"))
    j = fanout_join(q, o, item, QUERY, user, max_broadcast_bytes, block_rows)
    j = j.where(F.col(QUERY) != F.col(user))
    a, b = F.col("_a"), F.col("_b")
    d = F.abs(a - b)
    met = j.groupBy(QUERY, user).agg(
        F.count(F.lit(1)).alias("common"),
        *sums.aggregates(F.abs(a) + F.abs(b) - d, "_gain"),
        *sums.aggregates(F.lit(MAX_RATING) - d, "_agree"))
    return met.select(QUERY, user, "common", sums.total("_gain").alias("gain"), sums.total("_agree").alias("agree"))


def _scored_inputs(ratings: DataFrame, query_users: DataFrame, user: str, item: str, rating: str,
                   block_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per-user totals, the query users that have ratings (others have no
    list), and their overlaps."""
    sums = sums_of(ratings, rating)
    tot = materialize(user_totals(ratings, user, rating, sums), "user-totals")
    query_users = materialize(query_users.select(user).distinct().join(tot, user, "left_semi"), "query-users")
    overlap = user_overlap(ratings, query_users, user, item, rating, block_rows, sums=sums)
    return tot, query_users, materialize(overlap, "user-overlap")


def _free_users(overlap: DataFrame, query_users: DataFrame, ranked: DataFrame,
                k: int, user: str) -> DataFrame:
    """``(query_user, user)``: for each query user the first k other users,
    in the order of ``ranked`` (all users numbered from 0), that share no
    item with it."""
    ranked = materialize(ranked, "user-ranks")
    queries = query_users.select(F.col(user).alias(QUERY)).distinct()
    taken = (overlap.select(QUERY, user).join(ranked, user).select(QUERY, "_r")
             .unionByName(queries.join(ranked.withColumnRenamed(user, QUERY), QUERY).select(QUERY, "_r")))
    return (free_ranks(taken, queries, QUERY, k, ranked.count())
            .join(ranked, "_r").select(QUERY, user))


def l1_knn(ratings: DataFrame, query_users: DataFrame, k: int = 100, user: str = USER,
           item: str = ITEM, rating: str = RATING,
           block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """k nearest users by L1 distance (G7, W2): ``query_user, user_id,
    distance, rank``; order distance asc, user id asc."""
    tot, query_users, ov = _scored_inputs(ratings, query_users, user, item, rating, block_rows)
    qt = tot.select(F.col(user).alias(QUERY), F.col("s_abs").alias("_sq"))
    vt = tot.select(user, F.col("s_abs").alias("_sv"))
    scored = (ov.join(qt, QUERY).join(vt, user)
              .select(QUERY, user, l1_from_overlap(F.col("_sq"), F.col("_sv"), F.col("gain"))
                      .alias("distance")))
    ranked = dense_index(tot, [user, "s_abs"], order=[F.col("s_abs").asc(), F.col(user).asc()],
                         id_col="_r").select("_r", user)
    fill = (_free_users(ov, query_users, ranked, k, user)
            .join(qt, QUERY).join(vt, user)
            .select(QUERY, user, l1_from_overlap(F.col("_sq"), F.col("_sv"), F.lit(0.0))
                    .alias("distance")))
    return top_k(scored.unionByName(fill), QUERY,
                 [F.col("distance").asc(), F.col(user).asc()], k)


def agreement_knn(ratings: DataFrame, query_users: DataFrame, k: int = 100,
                  fill: bool = True, user: str = USER, item: str = ITEM,
                  rating: str = RATING, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """k most similar users by rating agreement (G8, W3): ``query_user,
    user_id, similarity, rank``; order similarity desc, user id asc. Users
    sharing no item score 0 and fill up short lists, as all users are scored
    in the reference; ``fill=False`` lists overlapping users only."""
    tot, query_users, ov = _scored_inputs(ratings, query_users, user, item, rating, block_rows)
    qt = tot.select(F.col(user).alias(QUERY), F.col("n").alias("_nq"))
    vt = tot.select(user, F.col("n").alias("_nv"))
    scored = (ov.join(qt, QUERY).join(vt, user)
              .select(QUERY, user, agreement(F.col("agree"), F.col("_nq"), F.col("_nv"),
                                             F.col("common")).alias("similarity")))
    best = [F.col("similarity").desc(), F.col(user).asc()]
    top = top_k(scored, QUERY, best, k)
    if not fill:
        return top
    # a user without common items can enter only a list with fewer than k
    # positive similarities: ``top`` holds all positive ones of such a list
    top = materialize(top, f"agreement-top{k}")
    pos = top.groupBy(QUERY).agg(F.count_if(F.col("similarity") > 0).alias("_pos"))
    short = materialize(query_users.withColumnRenamed(user, QUERY).join(pos, QUERY, "left")
                        .where(F.coalesce("_pos", F.lit(0)) < k).select(QUERY), "short-lists")
    if short.isEmpty():
        return top
    mine = scored.join(short, QUERY, "left_semi")
    ranked = dense_index(tot, user, id_col="_r").select("_r", user)
    zero = (_free_users(ov.join(short, QUERY, "left_semi"), short.withColumnRenamed(QUERY, user), ranked, k, user)
            .select(QUERY, user, F.lit(0.0).alias("similarity")))
    refilled = top_k(mine.unionByName(zero), QUERY, best, k)
    return top.join(short, QUERY, "left_anti").unionByName(refilled)
