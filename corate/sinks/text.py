"""Text and Parquet writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corate import ITEM, RATING, USER


def index_lines(index: DataFrame, key: str = "key", id_col: str = "id") -> DataFrame:
    """``"key id"`` per index entry (K1)."""
    return index.select(F.format_string("%s %d", F.col(key), F.col(id_col)).alias("value"))


def triple_lines(ratings: DataFrame, user: str = USER, item: str = ITEM,
                 rating: str = RATING) -> DataFrame:
    """``"user item rating"`` with six decimals (K2, K6)."""
    return ratings.select(F.format_string("%d %d %f", F.col(user), F.col(item),
                                          F.col(rating)).alias("value"))


def recommendation_lines(recs: DataFrame, key: str = "key", item_key: str = "item_key",
                         rank: str = "rank", users: DataFrame | None = None) -> DataFrame:
    """``"name: item item ... "`` per user, best first (K5).

    The per-user list is a top-n result, so collecting it per key is
    bounded by n. With ``users`` (a column ``key``) every one of them gets a
    line, ``"name: "`` if it has no recommendation.
    """
    grouped = recs.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(F.col(rank), F.col(item_key)))).alias("_l"))
    if users is not None:
        grouped = users.select(key).distinct().join(grouped, key, "left")
        grouped = grouped.withColumn("_l", F.coalesce("_l", F.array().cast(grouped.schema["_l"].dataType)))
    items = F.transform(F.col("_l"), lambda s: F.concat(s.getField(item_key), F.lit(" ")))
    return grouped.select(key, F.concat(F.col(key), F.lit(": "),
                                        F.array_join(items, "")).alias("value"))


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a one-string-column DataFrame as text files."""
    lines.select("value").write.mode(mode).text(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", codec: str | None = None) -> None:
    """Columnar store for every intermediate table (K3, K4, K6, K7)."""
    df.write.mode(mode).parquet(path, compression=codec)
