"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six white-space characters that separate words, and as a Java regex.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RE = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(col: Column) -> Column:
    """A null text is empty."""
    return F.coalesce(col.cast("string"), F.lit(""))


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(SPACES))


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """The words of a (non-null) text as an array; empty without words."""
    trimmed = strip(text)
    return F.when(trimmed == "", F.array().cast("array<string>")) \
        .otherwise(F.split(trimmed, SPACE_RE))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Inside a lambda an outer expression would be evaluated again for every
    element; binding it as a lambda variable avoids that.
    """
    return F.transform(F.array(value), body)[0]


def heavy_keys(rows: DataFrame, keys: list[str], total: int, *aggs: Column,
               parts: int = 1000) -> DataFrame:
    """Keys holding more than 1/``parts`` of the ``total`` rows, with ``aggs``.

    Fewer than ``parts`` keys can do so, whatever the data: the result may be
    broadcast. The counts are pre-aggregated in every map task.
    """
    return (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *aggs)
            .where(F.col("__n") * F.lit(parts) > F.lit(total)).drop("__n"))
