"""Plain-text readers.

Formats (all one record per line):

* rating triples ``user item rating``          (S1-S4, S9, S10)
* index lines ``key id``                        (S6)
* user lists, one external key per line         (S7)
* recommendation lines ``key: item item ... ``  (S11)

Two split rules exist for triples: ``strict`` keeps only lines that split on
single spaces into exactly three fields (lines with a double space or a
trailing space are dropped); ``whitespace`` splits on runs of whitespace and
ignores fields past the third. Rows whose numbers do not parse or aren't finite are dropped
(``try_cast`` -> NULL -> filtered) instead of failing the job;
:func:`triple_line_counts` counts them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corate import ITEM, RATING, USER
from corate.functions.parsing import (
    fields_any_space, fields_single_space, to_double, to_long,
)


def _triple_fields(mode: str, line_col: str) -> tuple[Column, Column]:
    """The fields of a line and whether their number is right."""
    if mode == "strict":
        parts = fields_single_space(F.col(line_col))
        return parts, F.coalesce(F.size(parts) == 3, F.lit(False))
    if mode == "whitespace":
        parts = fields_any_space(F.col(line_col))
        return parts, F.coalesce(F.size(parts) >= 3, F.lit(False))
    raise ValueError(f"unknown mode {mode!r}")


def parse_triples(lines: DataFrame, mode: str = "strict", line_col: str = "value",
                  user: str = USER, item: str = ITEM, rating: str = RATING,
                  truncate: bool = False, observation: Observation | None = None) -> DataFrame:
    """Lines -> ``(user long, item long, rating double)``.

    ``truncate=True`` floors the rating to a whole number (kept as double),
    the form the three-way pair similarity works on. An ``observation``
    receives the counts of :func:`triple_line_counts` from the same scan,
    once an action has run on the result.
    """
    parts, arity = _triple_fields(mode, line_col)
    field = lambda i: F.get(parts, F.lit(i))
    r = to_double(field(2))
    if truncate:
        r = F.floor(r).cast("double")
    out = lines.select(arity.alias("_ok"), to_long(field(0)).alias(user), to_long(field(1)).alias(item),
                       r.alias(rating))
    known = F.col(user).isNotNull() & F.col(item).isNotNull() & F.col(rating).isNotNull()
    if observation is not None:
        out = out.observe(observation, *_line_counts(F.col("_ok"), known))
    return out.where(F.col("_ok") & known).drop("_ok")


def _line_counts(arity: Column, good: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("n_lines"), F.count_if(arity & good).alias("n_parsed"),
            F.count_if(~arity).alias("n_bad_fields"), F.count_if(arity & ~good).alias("n_bad_numbers")]


def triple_line_counts(lines: DataFrame, mode: str = "strict", line_col: str = "value") -> DataFrame:
    """One row: ``n_lines``, ``n_parsed``, ``n_bad_fields`` (wrong number of
    fields), ``n_bad_numbers`` (an id or rating that is no finite number).
    Jobs that also read the triples pass an observation to the reader
    instead, which counts in the same scan."""
    parts, arity = _triple_fields(mode, line_col)
    field = lambda i: F.get(parts, F.lit(i))
    good = to_long(field(0)).isNotNull() & to_long(field(1)).isNotNull() & to_double(field(2)).isNotNull()
    return lines.agg(*_line_counts(arity, good))


def read_triples(spark: SparkSession, path: str, mode: str = "strict",
                 **kw) -> DataFrame:
    """Read a triple file or folder of files."""
    return parse_triples(spark.read.text(path), mode=mode, **kw)


def parse_index(lines: DataFrame, line_col: str = "value", key: str = "key", id_col: str = "id",
                order: Column | None = None) -> DataFrame:
    """``key id`` lines -> ``(key string, id long)``; other arities dropped.

    Keys stay strings (a key may have leading zeros). Direction (key->id or
    id->key) is just the join column chosen by the caller. If a key occurs
    again, its last line wins: the one with the largest ``order`` (by
    default lines count in the order they are read).
    """
    parts = fields_single_space(F.col(line_col))
    order = F.monotonically_increasing_id() if order is None else order
    out = (lines.withColumn("_line", order).where(F.size(parts) == 2)
           .select(parts.getItem(0).alias(key), to_long(parts.getItem(1)).alias(id_col), "_line"))
    return (out.where(F.col(id_col).isNotNull() & (F.col(key) != ""))
            .groupBy(key).agg(F.max_by(id_col, "_line").alias(id_col)))


def read_index(spark: SparkSession, path: str, **kw) -> DataFrame:
    """Read an index file or a folder of them (S6). Lines count in the order
    of (file path, offset), whatever the order in which files are scanned: a
    split of a file starts at a known offset and its lines are read in order."""
    at = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    return parse_index(spark.read.text(path).select("value", at.alias("_at")), order=F.col("_at"), **kw)


def read_user_list(spark: SparkSession, path: str, key: str = "key") -> DataFrame:
    """One external key per line (S7); blank lines dropped."""
    return (spark.read.text(path)
            .select(F.trim(F.col("value")).alias(key))
            .where(F.col(key) != ""))


def parse_recommendation_lines(lines: DataFrame, line_col: str = "value",
                               key: str = "key", item_key: str = "item_key",
                               rank: str = "rank") -> DataFrame:
    """``name: a b c `` lines -> ``(key, item_key, rank)``, rank from 1.

    The trailing ``:`` of the first field is removed; an empty list yields
    no rows for that key.
    """
    parts = fields_any_space(F.col(line_col))
    head = F.regexp_replace(parts.getItem(0), ":$", "")
    rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    return (lines.where(F.size(parts) >= 1)
            .select(head.alias(key), F.posexplode(rest).alias("_pos", item_key))
            .select(key, item_key, (F.col("_pos") + 1).cast("bigint").alias(rank)))


def read_recommendation_lines(spark: SparkSession, path: str, **kw) -> DataFrame:
    """Read a recommendation file written by :func:`recommendation_lines`."""
    return parse_recommendation_lines(spark.read.text(path), **kw)


def read_neighbours(spark: SparkSession, path: str) -> DataFrame:
    """Stored neighbour lists (S8), as written by ``sinks.write_parquet``."""
    return spark.read.parquet(path)
