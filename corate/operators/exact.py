"""Sums that do not depend on the order of rows.

A sum of doubles depends on its order as soon as a partial sum is rounded.
Whole-number ratings never reach that point; ratings such as 1.1, or averages
of repeated ratings, do. :class:`Sums` picks the cheapest exact form for a
column whose range is known (:func:`sums_of` reads it in one aggregation):

* ``plain``: all values are whole numbers, or all multiples of 1/64, and the
  largest possible sum of products stays below 2^53 units: doubles add up
  exactly;
* otherwise a value is cut into ``LIMBS`` whole numbers of ``LIMB_BITS`` bits
  below the column's largest exponent, and these are summed as longs. The
  cut is exact down to 2^-96 of the largest value (a value with bits below
  that is cut off there, on its own, so the order still does not matter) and
  holds for 2^38 rows a key.

Products of whole numbers (:func:`product_sum`) are summed as longs where
the bounds of both factors prove that no sum can overflow, and else as
38-digit decimals. Both forms give the exact sum, hence the same double.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRID = 64.0
LIMBS = 4
LIMB_BITS = 24
_LONG_BITS = 62
#: The top of the rating scale: terms such as 5 - |a - b| are summed too.
SCALE_TOP = 5.0


@dataclass(frozen=True)
class Sums:
    """How to sum a column: as doubles (``plain``), or in limbs below 2^top
    (one bit above the largest value, so that sums of two values fit)."""

    plain: bool = True
    top: int = 0

    def aggregates(self, x: Column, name: str, power: int = 1) -> list[Column]:
        """Aggregates of ``x``, a product of ``power`` values of the column
        (or a sum of two); :meth:`total` puts them together."""
        if self.plain:
            return [F.sum(x).alias(name)]
        out, rest = [], x
        for i in range(1, LIMBS + 1):
            unit = F.lit(2.0 ** (self.top * power - LIMB_BITS * i))
            limb = F.floor(rest / unit)  # a power of two: exact
            out.append(F.sum(limb).alias(f"{name}_{i}"))
            rest = rest - limb.cast("double") * unit
        return out

    def total(self, name: str, power: int = 1) -> Column:
        """The sum as a double: a function of the exact limb sums alone."""
        if self.plain:
            return F.col(name)
        carry, low = F.lit(0).cast("bigint"), F.lit(0.0)
        mask = F.lit((1 << LIMB_BITS) - 1).cast("bigint")
        for i in range(LIMBS, 1, -1):
            limb = F.col(f"{name}_{i}") + carry
            low = low + limb.bitwiseAND(mask).cast("double") * F.lit(2.0 ** (self.top * power - LIMB_BITS * i))
            carry = F.shiftright(limb, LIMB_BITS)
        return (F.col(f"{name}_1") + carry).cast("double") * F.lit(2.0 ** (self.top * power - LIMB_BITS)) + low


def sums_of(values: DataFrame, col: str) -> Sums:
    """The exact way to sum ``col`` and products of two of its values."""
    v = F.col(col)
    on_grid = lambda unit: F.bool_and(v * unit == F.floor(v * unit).cast("double"))
    r = values.agg(F.count(v).alias("n"), F.max(F.abs(v)).alias("top"), on_grid(F.lit(1.0)).alias("whole"),
                   on_grid(F.lit(GRID)).alias("grid")).first()
    if not r.n:
        return Sums()
    top = max(float(r.top), SCALE_TOP)
    units = 1.0 if r.whole else GRID
    return Sums(bool(r.grid) and r.n * (top * units) ** 2 < 2.0**53, math.frexp(top)[1] + 1)


def fits_long(largest: float, count: float) -> bool:
    """Whether a sum of ``count`` products of two whole numbers of size
    ``largest`` surely fits a long."""
    return 2 * math.log2(max(largest, 1)) + math.log2(max(count, 1)) < _LONG_BITS


def product_sum(x: Column, y: Column, narrow: bool) -> Column:
    """The exact sum of products of longs, as an aggregate (a long, or a
    decimal where longs might overflow)."""
    if narrow:
        return F.sum(x * y)
    return F.sum(x.cast("decimal(19,0)") * y.cast("decimal(19,0)"))
