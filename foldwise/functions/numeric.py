"""Null- and ANSI-safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """``num / den``, NULL on a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(ratio(num, den), F.lit(0.0))


def xlogx(c: Column) -> Column:
    """``c * ln(c)`` with the limit 0 at 0."""
    return F.when(c > 0, c * F.log(c.cast("double"))).otherwise(F.lit(0.0))


def to_number(c: Column, default: float | None = 0.0) -> Column:
    """Coerce to double; unparsable and missing values become ``default``."""
    number = c.try_cast("double")
    number = F.when(~F.isnan(number), number)
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def corrected_skewness(c: Column) -> Column:
    """Bias-corrected sample skewness G1; NULL below three rows or at zero variance."""
    n = F.count(c).cast("double")
    spread = F.var_pop(c)
    correction = F.sqrt(n * (n - 1)) / (n - 2)
    return F.when((n >= 3) & (spread > 0), F.skewness(c) * correction)


def pairwise_correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are present; NULL at zero variance."""
    xs, ys = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(xs) * F.stddev_pop(ys))


def clamp_upper(c: Column, step: float = 0.3, top: float = 1.0) -> Column:
    """Raise by ``step`` but never above ``top``."""
    return F.least(c + F.lit(step), F.lit(top))
