"""Similarity and distance formulas as Column expressions.

Each takes already-aggregated sums, so the same expression serves every
operator that produces those sums. Undefined values are NULL, never NaN.
Operation order is part of the contract: it is kept identical to the SQL
oracle so both engines round the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nonneg_zero(x: Column) -> Column:
    """Turn -0.0 into 0.0 (so equal values hash equally)."""
    return x + F.lit(0.0)


def cosine(dot: Column, norm_a: Column, norm_b: Column) -> Column:
    """dot / (|a| |b|) with the norms already rooted; NULL if a norm is 0."""
    return F.when((norm_a > 0) & (norm_b > 0),
                  nonneg_zero(dot / (norm_a * norm_b)))


def pearson_from_sums(n: Column, dot: Column, s1: Column, s2: Column,
                      q1: Column, q2: Column) -> Column:
    """Co-rated Pearson (G4) from n, sum(xy), sum(x), sum(y), sum(x2), sum(y2).

    (n*dot - s1*s2) / (sqrt(n*q1 - s1^2) * sqrt(n*q2 - s2^2)), NULL when the
    divisor is not positive (one co-rater or no variance).
    """
    left = n * q1 - s1 * s1
    right = n * q2 - s2 * s2
    div = F.sqrt(F.greatest(left, F.lit(0.0))) * F.sqrt(F.greatest(right, F.lit(0.0)))
    return F.when(div > 0, nonneg_zero((n * dot - s1 * s2) / div))


def bucket_jaccard(n: Column, c1_max: Column, c2_max: Column) -> Column:
    """Rating-bucket Jaccard (G6): n / (max c1 + max c2 - n), NULL if <= 0."""
    div = (c1_max + c2_max - n).cast("double")
    return F.when(div > 0, n.cast("double") / div)


def agreement(sum_agree: Column, n_a: Column, n_b: Column, common: Column) -> Column:
    """Rating agreement (G8): sum over common items of (5 - |a-b|) divided
    by the size of the union of both item sets; 1.0 when both are empty."""
    union = (n_a + n_b - common).cast("double")
    return F.when(union == 0, F.lit(1.0)).otherwise(nonneg_zero(sum_agree / union))


def l1_from_overlap(abs_a: Column, abs_b: Column, overlap_gain: Column) -> Column:
    """L1 distance (G7) over the union of items, missing = 0.

    sum|a-b| over the union = S_a + S_b - sum_common(|a| + |b| - |a-b|),
    where S is a user's sum of |rating|. ``overlap_gain`` is that last sum
    (0 for users with no common item).
    """
    return nonneg_zero(abs_a + abs_b - overlap_gain)


def ratio_or_zero(num: Column, den: Column) -> Column:
    """num / den, 0 when den == 0 (A11 normalise)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(nonneg_zero(num / den))


def fixed_point(x: Column, scale: float) -> Column:
    """Round x*scale half-up to a long; sums of these are exact."""
    return F.floor(x * F.lit(float(scale)) + F.lit(0.5)).cast("bigint")
