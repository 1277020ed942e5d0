"""Column expressions shared by the operators; all stay inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Zeroth spherical-harmonic basis constant.
SH_C0 = 0.28209479177387814


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def finite(c) -> Column:
    """Not NULL, not NaN, not infinite (NaN sorts above infinity in Spark)."""
    return F.coalesce(F.abs(col(c)) < F.lit(float("inf")), F.lit(False))


def all_finite(*cols) -> Column:
    return reduce(lambda a, b: a & b, [finite(c) for c in cols])


def clip(c, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), col(c)))


def sigmoid(c) -> Column:
    return 1.0 / (1.0 + F.exp(-clip(c, -60.0, 60.0)))


def exp_scale(c) -> Column:
    return F.exp(clip(c, -20.0, 20.0))


def norm(*cols) -> Column:
    return F.sqrt(reduce(lambda a, b: a + b, [col(c) * col(c) for c in cols]))


def distance(a, b) -> Column:
    return norm(*[col(p) - col(q) for p, q in zip(a, b)])


def nan_to_null(c) -> Column:
    return F.when(~F.isnan(col(c)), col(c))


def max_ignoring_nan(*cols) -> Column:
    """Row maximum that skips NaN; NaN when every value is NaN, NULL when every value is NULL."""
    plain = F.greatest(*[nan_to_null(c) for c in cols])
    return F.coalesce(plain, F.greatest(*[col(c) for c in cols]))


def to_byte(c) -> Column:
    """Truncating quantisation of [0, 1] to 0..255."""
    return F.floor(clip(c, 0.0, 1.0) * 255.0).cast("smallint")


def r6(c) -> Column:
    """Round for comparison; adding zero folds -0.0 into 0.0."""
    return F.round(col(c), 6) + F.lit(0.0)


def problem_list(*terms: Column) -> Column:
    """Array of the non-NULL strings in the order given."""
    return F.array_compact(F.array(*terms))


def round_half_even(c, digits: int) -> Column:
    """Round the exact binary value half to even, as Python's `round` does.

    `bround` rounds the shortest decimal form instead, which differs on values such as 0.0125.
    """
    return F.regexp_replace(F.format_number(col(c).cast("double"), digits), ",", "").try_cast("double")


def fixed_text(c, digits: int) -> Column:
    """Fixed-point text with the same rounding."""
    return F.regexp_replace(F.format_number(col(c).cast("double"), digits), ",", "")
