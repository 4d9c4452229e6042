"""Fit/transform preparation. Statistics are small and fitted once; transforms are projections."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.operators.ordered import exact_quantiles, medians_without_fold

MISSING = "missing"


def counted_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long table ``(by..., column, value, n)`` of present values: one shuffle for all columns."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
    ])
    return (
        df.select(*by, F.explode(pairs).alias("x")).select(*by, "x.*").where(F.col("value").isNotNull())
        .groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent value per column, ties to the smallest."""
    best = F.min_by("value", F.struct((-F.col("n")).alias("n"), F.col("value")))
    return counted_values(df, cols).groupBy("column").agg(best.alias("mode"))


def fit_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    found = {r["column"]: r["mode"] for r in modes(df, cols).collect()} if cols else {}
    return {c: found.get(c) for c in cols}


def missing_indicator(col: str) -> Column:
    return F.col(col).isNull().cast("int")


@dataclass
class Scaling:
    """``(coalesce(x, fill) - center) / scale`` for one column."""

    fill: float | None
    center: float
    scale: float

    def apply(self, c: Column) -> Column:
        c = c.cast("double")
        c = F.when(~F.isnan(c), c)
        if self.fill is not None:
            c = F.coalesce(c, F.lit(float(self.fill)))
        if self.center != 0.0:
            c = c - F.lit(float(self.center))
        return c if self.scale == 1.0 else c / F.lit(float(self.scale))


def _clean(c: str) -> Column:
    number = F.col(c).cast("double")
    return F.when(~F.isnan(number), number)


def fit_fills(df: DataFrame, cols: Sequence[str], strategy: str | float | None):
    """Imputation value per column: ``median`` (exact), ``mean``, a constant or nothing.

    A column without values has no median or mean; it is filled with 0.
    """
    if strategy is None or not cols:
        return dict.fromkeys(cols)
    if strategy == "median":
        found = exact_quantiles(df, {c: _clean(c) for c in cols}, [0.5])
        return {c: found[c][0] if found[c][0] is not None else 0.0 for c in cols}
    if strategy == "mean":
        row = df.agg(*[F.avg(_clean(c)).alias(c) for c in cols]).first()
        return {c: row[c] if row[c] is not None else 0.0 for c in cols}
    return {c: float(strategy) for c in cols}


def fit_scaling(
    df: DataFrame, cols: Sequence[str], impute: str | float | None = "median",
    scale: str | None = "standard",
) -> dict[str, Scaling]:
    """Scaling after imputation: ``standard`` (population std), ``minmax``, ``robust`` or none.

    A zero spread divides by 1.
    """
    fills = fit_fills(df, cols, impute)
    filled = {
        c: _clean(c) if fills[c] is None else F.coalesce(_clean(c), F.lit(float(fills[c])))
        for c in cols
    }
    out = {c: Scaling(fills[c], 0.0, 1.0) for c in cols}
    if scale is None or not cols:
        return out
    if scale == "robust":
        found = exact_quantiles(df, filled, [0.25, 0.5, 0.75])
        for c in cols:
            low, mid, high = (v if v is not None else 0.0 for v in found[c])
            out[c] = Scaling(fills[c], mid, (high - low) or 1.0)
        return out
    first, second = {
        "standard": (F.avg, F.stddev_pop), "minmax": (F.min, F.max),
    }[scale]
    row = df.agg(*[
        f(e).alias(f"{tag}{i}")
        for i, e in enumerate(filled.values()) for tag, f in (("a", first), ("b", second))
    ]).first()
    for i, c in enumerate(cols):
        a, b = row[f"a{i}"] or 0.0, row[f"b{i}"] or 0.0
        spread = b if scale == "standard" else b - a
        out[c] = Scaling(fills[c], a, spread or 1.0)
    return out


def fit_scaling_by_fold(
    df: DataFrame, cols: Sequence[str], fold: str = "fold", impute: str | float = "mean",
    folds: Sequence[int] | None = None,
) -> dict[str, dict[int, Scaling]]:
    """Standard scaling fitted on the other folds, for every fold at once; gaps get ``impute``.

    One aggregate gives count, mean and variance of each fold. The training statistics of a
    fold merge those of the others: no second pass, and no subtraction of large sums. A filled
    row adds the fill's distance from the mean. Medians of all training sets are found together. ``folds`` names folds that may have no rows (default: those found).
    """
    if not cols:
        return {}
    rows = df.groupBy(fold).agg(F.count(F.lit(1)).alias("rows"), *[
        f(_clean(c)).alias(f"{tag}{i}")
        for i, c in enumerate(cols)
        for tag, f in (("n", F.count), ("m", F.avg), ("v", F.var_pop))
    ]).collect()
    held = [r[fold] for r in rows] if folds is None else list(folds)
    medians = {}
    if impute == "median":
        counts = {r[fold]: {c: r[f"n{i}"] for i, c in enumerate(cols)} for r in rows}
        medians = medians_without_fold(df, {c: _clean(c) for c in cols}, fold, counts, held)
    out: dict[str, dict[int, Scaling]] = {c: {} for c in cols}
    for h in held:
        train = [r for r in rows if r[fold] != h]
        total = sum(r["rows"] for r in train)
        for i, c in enumerate(cols):
            parts = [(r[f"n{i}"], r[f"m{i}"], r[f"v{i}"]) for r in train if r[f"n{i}"]]
            n = sum(p[0] for p in parts)
            present = math.fsum(p[0] * p[1] for p in parts) / n if n else 0.0
            if impute == "mean":
                fill = present
            elif impute == "median":
                fill = medians[c][h] if n else 0.0
            else:
                fill = float(impute)
            if total > n:
                parts.append((total - n, fill, 0.0))
            mean = math.fsum(p[0] * p[1] for p in parts) / total if total else 0.0
            spread = math.fsum(p[0] * (p[2] + (p[1] - mean) ** 2) for p in parts)
            std = math.sqrt(spread / total) if total else 0.0
            out[c][h] = Scaling(fill, mean, std or 1.0)
    return out


def fit_categories_by_fold(
    df: DataFrame, cols: Sequence[str], folds: Sequence[int], fold: str = "fold"
) -> dict[int, dict[str, tuple[str | None, list[str]]]]:
    """For every fold the mode and the sorted values of each column on the other folds.

    The values are counted once by fold and reach the driver, so it is for narrow columns.
    """
    out = {h: {c: (None, []) for c in cols} for h in folds}
    if not cols:
        return out
    counted = counted_values(df, cols, [fold])
    total = counted.groupBy("column", "value").agg(
        *[F.sum(F.when(F.col(fold) != h, F.col("n")).otherwise(0)).alias(f"n{i}") for i, h in enumerate(folds)]
    )
    held = [F.col(f"n{i}") > 0 for i in range(len(folds))]
    found = total.groupBy("column").agg(
        *[
            F.min_by("value", F.when(here, F.struct((-F.col(f"n{i}")).alias("n"), "value"))).alias(f"mode{i}")
            for i, here in enumerate(held)
        ],
        *[F.array_sort(F.collect_list(F.when(here, F.col("value")))).alias(f"values{i}") for i, here in enumerate(held)],
    ).collect()
    for row in found:
        for i, h in enumerate(folds):
            out[h][row["column"]] = (row[f"mode{i}"], list(row[f"values{i}"]))
    return out


def scale_by_fold(
    df: DataFrame, scalings: dict[str, dict[int, Scaling]], fold: str = "fold"
) -> DataFrame:
    """Scale each row with the statistics of the folds it is not in: k literals, no join."""
    new = {}
    for c, by_fold in scalings.items():
        pick = F.lit(None).cast("double")
        for i, s in sorted(by_fold.items()):
            pick = F.when(F.col(fold) == i, s.apply(F.col(c))).otherwise(pick)
        new[c] = pick
    return df.withColumns(new)


class NumericPreparer(Estimator):
    """Impute, scale and optionally flag numeric columns; boolean columns become 0/1."""

    def __init__(self, cols, impute="median", scale="standard", indicator=False):
        super().__init__()
        self.cols, self.impute, self.scale, self.indicator = list(cols), impute, scale, indicator

    def _fit(self, df: DataFrame) -> NumericPreparerModel:
        return NumericPreparerModel(
            fit_scaling(df, self.cols, self.impute, self.scale), self.indicator
        )


class NumericPreparerModel(Model):
    def __init__(self, scalings: dict[str, Scaling], indicator: bool = False):
        super().__init__()
        self.scalings, self.indicator = scalings, indicator

    def _transform(self, df: DataFrame) -> DataFrame:
        new = {c: s.apply(F.col(c)) for c, s in self.scalings.items()}
        if self.indicator:
            new |= {f"{c}_missing": missing_indicator(c) for c in self.scalings}
        return df.withColumns(new) if new else df


class CategoryImputer(Estimator):
    """Fill missing categories with the most frequent value or a constant, as strings."""

    def __init__(self, cols, strategy="most_frequent", constant=MISSING):
        super().__init__()
        self.cols, self.strategy, self.constant = list(cols), strategy, constant

    def _fit(self, df: DataFrame) -> CategoryImputerModel:
        fills = dict.fromkeys(self.cols, self.constant)
        if self.strategy == "most_frequent":
            fills = {c: v if v is not None else self.constant
                     for c, v in fit_modes(df, self.cols).items()}
        return CategoryImputerModel(fills)


class CategoryImputerModel(Model):
    def __init__(self, fills: dict[str, str]):
        super().__init__()
        self.fills = fills

    def _transform(self, df: DataFrame) -> DataFrame:
        new = {c: F.coalesce(F.col(c).cast("string"), F.lit(v)) for c, v in self.fills.items()}
        return df.withColumns(new) if new else df


def normalise_rows(values: Column) -> Column:
    """Array scaled to unit L2 norm; a zero row stays zero."""
    values = values.cast("array<double>")
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v * v))
    return F.transform(values, lambda v: F.coalesce(F.try_divide(v, norm), F.lit(0.0)))


def polynomial_terms(cols: Sequence[str]) -> dict[str, Column]:
    """Degree-2 terms without bias: each column, each square, each product."""
    out = {c: F.col(c).cast("double") for c in cols}
    for i, a in enumerate(cols):
        for b in cols[i:]:
            name = f"{a}_sq" if a == b else f"{a}_x_{b}"
            out[name] = F.col(a).cast("double") * F.col(b).cast("double")
    return out


def bin_by_cuts(c: Column, cuts: Sequence[float]) -> Column:
    """Number of cuts at or below the value; NULL stays NULL."""
    inside = sum((F.when(c >= F.lit(float(x)), 1).otherwise(0) for x in cuts), F.lit(0))
    return F.when(c.isNotNull(), inside.cast("int"))


def fit_quantile_cuts(df: DataFrame, cols: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Inner quantile edges; equal edges merge their bins."""
    probs = [i / bins for i in range(1, bins)]
    found = exact_quantiles(df, {c: _clean(c) for c in cols}, probs)
    return {c: sorted({x for x in v if x is not None}) for c, v in found.items()}


def fit_uniform_cuts(df: DataFrame, cols: Sequence[str], bins: int) -> dict[str, list[float]]:
    row = df.agg(*[
        f(_clean(c)).alias(f"{tag}{i}")
        for i, c in enumerate(cols) for tag, f in (("a", F.min), ("b", F.max))
    ]).first()
    out = {}
    for i, c in enumerate(cols):
        a, b = row[f"a{i}"], row[f"b{i}"]
        out[c] = [] if a is None or a == b else [a + (b - a) * j / bins for j in range(1, bins)]
    return out


def string_features(col: str) -> dict[str, Column]:
    """Null-safe length, digit count and has-digit flag."""
    text = F.coalesce(F.col(col).cast("string"), F.lit(""))
    digits = F.length(text) - F.length(F.regexp_replace(text, "[0-9]", ""))
    return {
        f"{col}_length": F.length(text), f"{col}_digits": digits,
        f"{col}_has_digit": text.rlike("[0-9]").cast("int"),
    }


def date_parts(col: str) -> dict[str, Column]:
    """Year, month, day, ISO weekday (Monday 1) and hour."""
    c = F.col(col)
    return {
        f"{col}_year": F.year(c), f"{col}_month": F.month(c), f"{col}_day": F.dayofmonth(c),
        f"{col}_weekday": F.weekday(c) + 1, f"{col}_hour": F.hour(c),
    }
