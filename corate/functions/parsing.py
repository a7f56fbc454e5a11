"""Text-field parsing expressions.

Casts are ``try_cast``: a malformed value becomes NULL and the row is
dropped by the reader instead of failing the whole job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fields_single_space(line: Column) -> Column:
    """Split on exactly one space; empty fields are kept (``'a  b'`` -> 3)."""
    return F.split(line, " ")


def fields_any_space(line: Column) -> Column:
    """Split on runs of whitespace after trimming both ends."""
    trimmed = F.regexp_replace(line, r"^\s+|\s+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")) \
        .otherwise(F.split(trimmed, r"\s+"))


def to_long(text: Column) -> Column:
    """Integer id from text; NULL when not an integer."""
    return text.try_cast("bigint")


def to_double(text: Column) -> Column:
    """Rating from text; NULL when not a finite number (a NaN or an infinity
    would sort before every rating and spoil its item's sums)."""
    return finite(text.try_cast("double"))


def finite(x: Column) -> Column:
    """``x``, NULL for NaN and the infinities."""
    return F.when(F.abs(x) < F.lit(float("inf")), x)
