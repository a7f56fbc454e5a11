"""Three-way pair similarity over co-rated items (C3: A4, J1, J3, A6, G4,
G5, G6).

Ratings are truncated to whole numbers first (the job's input form). Every
rating carries ``bucket_count``: how many ratings of its item have the same
value. The co-rating self-join on user (:class:`PairLists`) gives one
record per user and item pair, laid out by the first item, where it is
aggregated per pair into count, sums, sums of squares, dot product and the
largest bucket counts: ratings are shuffled in lists, pairs never.

Deviations from the reference, on purpose: the sum of the second item's
ratings is a true sum (the reference overwrote it with the last value), and
the co-rated cosine is reported rooted (``cosine``) next to the reference's
un-rooted form (``cosine_unrooted`` = dot / (sum a^2 * sum b^2)).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate import ITEM, RATING, USER
from corate.functions.measures import bucket_jaccard, nonneg_zero, pearson_from_sums
from corate.operators.clean import truncate_ratings, with_bucket_count
from corate.operators.pairs import LIST_ROWS, PART, PairLists
from corate.session import materialize, shuffles_dropped
from corate.sinks.text import write_parquet

STORE_CODEC = "zstd"


def _lists(ratings: DataFrame, user: str, item: str, rating: str, truncate: bool, block_rows: int, **how) -> PairLists:
    r = ratings.select(user, item, rating)
    if truncate:
        r = truncate_ratings(r, rating)
    # read by the counts and the lists: computed and written once
    rc = materialize(with_bucket_count(r, item, rating, out="_c"), "pair-rated")
    return PairLists(rc, user, item, [rating, "_c"], block_rows=block_rows, **how)


def _pairs(j: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    return j.select(F.col(user), F.col(f"a_{item}").alias("item_a"), F.col(f"b_{item}").alias("item_b"),
                    F.col(f"a_{rating}").alias("r1"), F.col("a__c").alias("c1"),
                    F.col(f"b_{rating}").alias("r2"), F.col("b__c").alias("c2"), *_part(j))


def co_rating_pairs(ratings: DataFrame, user: str = USER, item: str = ITEM,
                    rating: str = RATING, truncate: bool = True,
                    block_rows: int = LIST_ROWS, by_item: bool = True) -> DataFrame:
    """One row per (user, item_a < item_b) both rated by the user (J3):
    ``user_id, item_a, item_b, r1, c1, r2, c2`` (and :data:`PART`, if items
    have so many partners that :func:`listed_pairs` parts them). Pairs that
    are summed by item are laid out by the first one; with ``by_item=False``
    they stay where the user's list is, and no list is shuffled."""
    lists = _lists(ratings, user, item, rating, truncate, block_rows, by_item=by_item)
    return _pairs(lists.pairs(), user, item, rating)


def _part(pairs: DataFrame) -> list[str]:
    return [PART] if PART in pairs.columns else []


def pair_aggregates(pairs: DataFrame) -> DataFrame:
    """Per pair (A6): ``n, s1, s2, q1, q2, dot, c1_max, c2_max``."""
    r1, r2 = F.col("r1"), F.col("r2")
    return pairs.groupBy("item_a", "item_b", *_part(pairs)).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(r1).alias("s1"), F.sum(r2).alias("s2"),
        F.sum(r1 * r1).alias("q1"), F.sum(r2 * r2).alias("q2"),
        F.sum(r1 * r2).alias("dot"),
        F.max("c1").alias("c1_max"), F.max("c2").alias("c2_max")).drop(PART)


def pearson_col() -> F.Column:
    c = F.col
    return pearson_from_sums(c("n").cast("double"), c("dot"), c("s1"), c("s2"), c("q1"), c("q2"))


def cosine_col() -> F.Column:
    c = F.col
    den = F.sqrt(c("q1")) * F.sqrt(c("q2"))
    return F.when(den > 0, nonneg_zero(c("dot") / den))


def cosine_unrooted_col() -> F.Column:
    c = F.col
    den = c("q1") * c("q2")
    return F.when(den > 0, nonneg_zero(c("dot") / den))


def jaccard_col() -> F.Column:
    return bucket_jaccard(F.col("n"), F.col("c1_max"), F.col("c2_max"))


def _similarities(agg: DataFrame) -> DataFrame:
    return agg.select("item_a", "item_b", "n", pearson_col().alias("pearson"),
                      cosine_col().alias("cosine"),
                      cosine_unrooted_col().alias("cosine_unrooted"),
                      jaccard_col().alias("jaccard"))


def pair_similarity(ratings: DataFrame, user: str = USER, item: str = ITEM,
                    rating: str = RATING,
                    block_rows: int = LIST_ROWS) -> DataFrame:
    """``item_a, item_b, n, pearson, cosine, cosine_unrooted, jaccard`` for
    every co-rated pair (C3). Undefined values are NULL."""
    return _similarities(pair_aggregates(co_rating_pairs(ratings, user, item, rating, True, block_rows)))


def write_pair_similarity(ratings: DataFrame, path: str, user: str = USER, item: str = ITEM,
                          rating: str = RATING, block_rows: int = LIST_ROWS) -> None:
    """The table of :func:`pair_similarity` in its store (K4), written for one
    share of the items after another: only a share's lists are on disk beside
    the store."""
    lists = _lists(ratings, user, item, rating, True, block_rows, shares=True)
    for share in range(lists.shares):
        found = _similarities(pair_aggregates(_pairs(lists.pairs(share), user, item, rating)))
        with shuffles_dropped(ratings.sparkSession):
            write_parquet(found, path, "append" if share else "overwrite", STORE_CODEC)
