"""Top-k per group (W1-W7) and top-k lists as a mergeable aggregate.

``row_number() <= k`` directly on the window column lets Catalyst insert a
``WindowGroupLimit`` below the shuffle: every map task keeps only its k best
rows per group, so a group with a third of all rows still ships at most
k rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.internal import InternalFunction


def top_k(df: DataFrame, by: Sequence[str] | str, order: Sequence[Column], k: int,
          rank: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of each ``by`` group in ``order``; adds a
    1-based long ``rank`` column. ``order`` must end in a unique key so the
    result is deterministic."""
    by = [by] if isinstance(by, str) else list(by)
    w = Window.partitionBy(*by).orderBy(*order)
    tmp = f"_{rank}_rn"
    ranked = df.withColumn(tmp, F.row_number().over(w)).where(F.col(tmp) <= k)
    return ranked.withColumn(rank, F.col(tmp).cast("bigint")).drop(tmp)


def number_rows(df: DataFrame, by: Sequence[str] | str, order: Sequence[Column],
                rank: str = "rank") -> DataFrame:
    """1-based position of each row inside its group (no cut)."""
    by = [by] if isinstance(by, str) else list(by)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w).cast("bigint"))


def _ascending(df: DataFrame, col: str, descending: bool) -> list[Column]:
    """Columns whose ascending order is the wanted order of ``col`` (nulls
    first, or last if descending; NaN above all numbers)."""
    x = F.col(col)
    if not descending:
        return [x]
    kind = df.schema[col].dataType
    if isinstance(kind, T.IntegralType):
        return [x.isNull(), F.bitwise_not(x.cast("bigint"))]  # ~x = -x - 1, for every long
    if isinstance(kind, T.FractionalType):
        return [x.isNull(), ~F.isnan(x.cast("double")), -x]
    raise TypeError(f"descending order of {col}: {kind.simpleString()} is no number")


def top_k_list(df: DataFrame, order: Sequence[tuple[str, str]], k: int, fields: Sequence[str] = ()) -> Column:
    """Aggregate: the first ``k`` rows of a group as an array of structs of
    the ``order`` columns and ``fields``, best first.

    ``order`` holds pairs such as ``("sim", "desc")`` and must end in a
    unique key, as in :func:`top_k`, whose rows these are. Spark's bounded
    queue (the one behind ML's top-k recommendations) never holds more than
    ``k`` rows a group, and two queues merge: map tasks ship at most ``k``
    rows of a group however many it has, without sorting it, next to any other
    aggregates of one ``groupBy``, also on a stream. Many small groups are
    served as well by :func:`top_k`, which spills.
    """
    if bad := [d for _, d in order if d not in ("asc", "desc")]:
        raise ValueError(f"asc or desc, not {bad[0]}")
    keys = [c for name, d in order for c in _ascending(df, name, d == "desc")]
    names = list(dict.fromkeys([*(name for name, _ in order), *fields]))
    row = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(keys)], F.struct(*names).alias("row"))
    return F.transform(InternalFunction.collect_top_k(row, k, True), lambda e: e["row"])


def unfold_lists(lists: DataFrame, by: Sequence[str], col: str = "top", rank: str = "rank") -> DataFrame:
    """One row per entry of the lists, with its 1-based long ``rank``."""
    at = lists.select(*by, F.posexplode(col).alias("_at", "_row"))
    return at.select(*by, "_row.*", (F.col("_at") + 1).cast("bigint").alias(rank))
