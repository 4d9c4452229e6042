"""Univariate feature selection from one aggregate over all columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.numeric import pairwise_correlation, ratio


def melt_row(df: DataFrame, per_column: dict[str, dict[str, object]]) -> DataFrame:
    """One aggregate over ``df``, returned long: a row per column with the named statistics."""
    names = list(next(iter(per_column.values())))
    flat = df.agg(*[
        e.alias(f"{stat}__{i}")
        for i, stats in enumerate(per_column.values()) for stat, e in stats.items()
    ])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"{s}__{i}").alias(s) for s in names])
        for i, c in enumerate(per_column)
    ])
    return flat.select(F.explode(rows).alias("x")).select("x.*")


def variances(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return melt_row(df, {c: {"variance": F.var_pop(F.col(c).cast("double"))} for c in cols})


def variance_threshold(df: DataFrame, cols: Sequence[str], threshold: float = 0.0) -> list[str]:
    kept = {r["column"] for r in variances(df, cols).where(F.col("variance") > threshold).collect()}
    return [c for c in cols if c in kept]


def class_moments(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """``(class, column, n, mean, m2, total)``: one grouped pass, classes are few."""
    flat = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("class")).agg(*[
        e.alias(f"{tag}__{i}")
        for i, c in enumerate(cols)
        for tag, e in (
            ("n", F.count(c)), ("mean", F.avg(F.col(c).cast("double"))),
            ("m2", F.var_pop(F.col(c).cast("double")) * F.count(c)),
            ("total", F.sum(F.col(c).cast("double"))),
        )
    ])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), *[
            F.col(f"{t}__{i}").alias(t) for t in ("n", "mean", "m2", "total")
        ]) for i, c in enumerate(cols)
    ])
    return flat.select("class", F.explode(rows).alias("x")).select("class", "x.*")


def anova_f(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """ANOVA F of each column against the classes, from merged class moments."""
    per_column = class_moments(df, cols, label).where(F.col("n") > 0).groupBy("column").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
        F.sum("m2").alias("within"),
        F.sum("total").alias("total"), F.collect_list(F.struct("n", "mean")).alias("classes"),
    )
    grand = F.col("total") / F.col("n")
    between = F.aggregate(
        "classes", F.lit(0.0),
        lambda acc, x: acc + x["n"] * (x["mean"] - grand) * (x["mean"] - grand),
    )
    f = ratio(F.try_divide(between, F.col("k") - 1), F.try_divide(F.col("within"), F.col("n") - F.col("k")))
    return per_column.select("column", F.when(F.col("k") > 1, f).alias("score"))


def f_regression(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """F of each column against a numeric target: ``r^2 / (1 - r^2) * (n - 2)``."""
    y = F.col(target).cast("double")
    stats = melt_row(df, {
        c: {
            "r": pairwise_correlation(F.col(c).cast("double"), y),
            "n": F.count_if(F.col(c).isNotNull() & y.isNotNull()),
        } for c in cols
    })
    r2 = F.col("r") * F.col("r")
    return stats.select("column", ratio(r2 * (F.col("n") - 2), 1 - r2).alias("score"))


def chi_square(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Chi-square of non-negative columns: class sums against class share of the total."""
    moments = class_moments(df, cols, label)
    totals = moments.groupBy("column").agg(
        F.sum("total").alias("all"), F.sum("n").alias("rows"),
        F.collect_list(F.struct("n", "total")).alias("classes"),
    )
    score = F.aggregate(
        "classes", F.lit(0.0),
        lambda acc, x: acc + F.coalesce(
            F.try_divide(
                (x["total"] - x["n"] / F.col("rows") * F.col("all"))
                * (x["total"] - x["n"] / F.col("rows") * F.col("all")),
                x["n"] / F.col("rows") * F.col("all"),
            ), F.lit(0.0)),
    )
    return totals.select("column", score.alias("score"))


def best_columns(scores: DataFrame, k: int) -> DataFrame:
    """Top ``k`` columns by score, ties by name."""
    present = scores.where(F.col("score").isNotNull())
    return present.orderBy(F.desc("score"), "column").limit(k)


def select_best(df: DataFrame, scores: DataFrame, k: int, keep: Sequence[str] = ()) -> DataFrame:
    """Project ``df`` on the ``k`` best scored columns and ``keep``."""
    chosen = {r["column"] for r in best_columns(scores, k).collect()}
    return df.select(*keep, *[c for c in df.columns if c in chosen and c not in keep])
