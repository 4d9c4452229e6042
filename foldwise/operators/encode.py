"""Encoders for targets and categories. Lookup tables are joined by their measured size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwise.operators.ordered import dense_codes, lookup_join
from foldwise.operators.preprocess import counted_values
from foldwise.session import materialise

SMOOTH = 10.0
ONE_HOT_LIMIT = 100


def class_table(df: DataFrame, target: str, code: str = "code") -> DataFrame:
    """Classes of a target with 0-based codes in sort order."""
    return dense_codes(df, target, code)


def encode_label(df: DataFrame, target: str, label: str = "label", seen: DataFrame | None = None) -> DataFrame:
    """Add the class code as a double; rows without a target keep a NULL label.

    ``seen`` has the same targets as ``df``, if there is a frame from which they are cheaper to list.
    """
    classes = class_table(df if seen is None else seen, target, label)
    out = lookup_join(df, classes, [target])
    return out.withColumn(label, F.col(label).cast("double"))


def decode_label(df: DataFrame, classes: DataFrame, code: str, target: str) -> DataFrame:
    """Attach the class of a code; ``classes`` is a table ``(target, code)``."""
    return lookup_join(df, classes.select(F.col("code").alias(code), target), [code])


def ordinal_encode(
    train: DataFrame, df: DataFrame, cols: Sequence[str], suffix: str = "_code"
) -> DataFrame:
    """Sorted category codes of the training rows; unseen and missing become -1."""
    for c in cols:
        name = f"{c}{suffix}"
        df = lookup_join(df, dense_codes(train, c, name), [c])
        df = df.withColumn(name, F.coalesce(F.col(name), F.lit(-1)).cast("int"))
    return df


def route_by_cardinality(
    df: DataFrame, cols: Sequence[str], limit: int = ONE_HOT_LIMIT
) -> dict[str, str]:
    """``one_hot`` for columns of few categories, ``target`` for the others, in one pass."""
    return count_and_route(df, cols, limit)[1] if cols else {}


def count_and_route(df: DataFrame, cols: Sequence[str], limit: int = ONE_HOT_LIMIT) -> tuple[int, dict[str, str]]:
    """The number of rows and the routes of :func:`route_by_cardinality`, in one pass."""
    n, *found = df.agg(F.count(F.lit(1)), *[F.approx_count_distinct(c) for c in cols]).first()
    return n, {c: "one_hot" if distinct <= limit else "target" for c, distinct in zip(cols, found, strict=True)}


class OneHot(Estimator):
    """0/1 column per training category; unseen and missing values are all zeros."""

    def __init__(self, cols: Sequence[str], limit: int = ONE_HOT_LIMIT):
        super().__init__()
        self.cols, self.limit = list(cols), limit

    def _fit(self, df: DataFrame) -> OneHotModel:
        bound = self.limit * len(self.cols)
        rows = counted_values(df, self.cols).select("column", "value").take(bound + 1)
        categories = {c: sorted(r["value"] for r in rows if r["column"] == c) for c in self.cols}
        for c, values in categories.items():
            if len(values) > self.limit or len(rows) > bound:
                raise ValueError(f"{c} has more than {self.limit} categories: target-encode it")
        return OneHotModel(categories)


class OneHotModel(Model):
    def __init__(self, categories: dict[str, list[str]]):
        super().__init__()
        self.categories = categories

    def columns(self) -> dict[str, Column]:
        return {
            f"{c}_{v}": F.coalesce(F.col(c).cast("string") == F.lit(v), F.lit(False)).cast("int")
            for c, values in self.categories.items() for v in values
        }

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.columns())


def smoothed(total: Column, n: Column, prior: Column, smooth: float = SMOOTH) -> Column:
    return (total + F.lit(float(smooth)) * prior) / (n + F.lit(float(smooth)))


def encoding_by_fold(
    counts: DataFrame, keys: Sequence[str], cat: str, fold: str = "fold",
    smooth: float = SMOOTH, name: str = "encoded",
) -> DataFrame:
    """Out-of-fold encodings from counts ``(keys, cat, fold, n, s)``.

    A fold's encoding uses the category's totals less the fold's own part, and the target
    mean of the other folds as prior; without another fold, the mean of all. A category has at
    most k rows here.
    """
    rows, total = F.col("n").cast("double"), F.col("s").cast("double")
    of_cat = Window.partitionBy(*keys, cat)
    by_fold = counts.groupBy(*keys, fold).agg(F.sum("n").alias("_n"), F.sum("s").alias("_s"))
    # by_fold has k rows per key, so this window is bounded.
    whole = Window.partitionBy(*keys)
    priors = by_fold.select(
        *keys, fold,
        F.coalesce(
            F.try_divide(F.sum("_s").over(whole) - F.col("_s"), F.sum("_n").over(whole) - F.col("_n")),
            F.try_divide(F.sum("_s").over(whole), F.sum("_n").over(whole)),
        ).alias("_prior"),
    )
    out = counts.withColumns({
        "_rest_n": F.sum(rows).over(of_cat) - rows, "_rest_s": F.sum(total).over(of_cat) - total,
    }).join(priors if keys else F.broadcast(priors), [*keys, fold])
    return out.withColumn(
        name, smoothed(F.col("_rest_s"), F.col("_rest_n"), F.col("_prior"), smooth)
    ).drop("_rest_n", "_rest_s", "_prior")


def target_counts(
    df: DataFrame, keys: Sequence[str], cat: str, target: Column, fold: str = "fold"
) -> DataFrame:
    """Rows and target sum per category and fold, combined map-side before the shuffle."""
    return df.groupBy(*keys, cat, fold).agg(
        F.count(target).alias("n"), F.sum(target.cast("double")).alias("s")
    )


def target_encode_oof(
    df: DataFrame, cat: str, target: str, fold: str = "fold", smooth: float = SMOOTH,
    name: str = "encoded",
) -> DataFrame:
    """Row-level out-of-fold target encoding; a missing category is a category."""
    df = df.withColumn(cat, F.coalesce(F.col(cat).cast("string"), F.lit("missing")))
    counts = materialise(target_counts(df, [], cat, F.col(target), fold))
    table = encoding_by_fold(counts, [], cat, fold, smooth, name).select(cat, fold, name, "n")
    return lookup_join(df, table, [cat, fold], weight="n").drop("n")


class TargetEncoder(Estimator):
    """Smoothed target means of all training rows, for scoring new rows; unseen get the prior.

    Wide tables stay tables: a category column of any cardinality is joined, not collected.
    """

    def __init__(self, cols: Sequence[str], target: str, smooth: float = SMOOTH, suffix="_target"):
        super().__init__()
        self.cols, self.target, self.smooth, self.suffix = list(cols), target, smooth, suffix

    def _fit(self, df: DataFrame) -> TargetEncoderModel:
        y = F.col(self.target).cast("double")
        prior = df.agg(F.avg(y)).first()[0] or 0.0
        tables = {}
        for c in self.cols:
            value = F.coalesce(F.col(c).cast("string"), F.lit("missing"))
            tables[c] = materialise(
                df.groupBy(value.alias(c)).agg(F.count(y).alias("n"), F.sum(y).alias("s"))
                .select(c, "n", smoothed(F.col("s"), F.col("n"), F.lit(prior), self.smooth)
                        .alias(f"{c}{self.suffix}"))
            )
        return TargetEncoderModel(tables, prior, self.suffix)


class TargetEncoderModel(Model):
    def __init__(self, tables: dict[str, DataFrame], prior: float, suffix: str):
        super().__init__()
        self.tables, self.prior, self.suffix = tables, prior, suffix

    def _transform(self, df: DataFrame) -> DataFrame:
        for c, table in self.tables.items():
            name = f"{c}{self.suffix}"
            df = df.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit("missing")))
            # Hot keys are those of the scored rows, which training counts need not show.
            df = lookup_join(df, table.drop("n"), [c])
            df = df.withColumn(name, F.coalesce(F.col(name), F.lit(self.prior)))
        return df
