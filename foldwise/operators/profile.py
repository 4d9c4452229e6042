"""Profiling of a table, its target and its features. One pass per kind of statistic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from foldwise.functions.hashing import SEED, digest
from foldwise.functions.numeric import corrected_skewness, pairwise_correlation, to_number, xlogx
from foldwise.operators.encode import encode_label
from foldwise.operators.preprocess import (
    bin_by_cuts, counted_values, fit_modes, fit_quantile_cuts,
)
from foldwise.operators.schema import infer_roles, infer_task, normalise_nan, require_column
from foldwise.operators.select import melt_row

MI_BINS = 10


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def missing_profile(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Missing count and percentage of every column from one aggregate."""
    long = melt_row(normalise_nan(df), {
        c: {"n_rows": F.count(F.lit(1)), "n_missing": F.count_if(F.col(c).isNull())}
        for c in df.columns
    })
    pct = F.round(F.try_divide(F.col("n_missing") * 100.0, F.col("n_rows").cast("double")), 2)
    long = long.withColumn("pct_missing", pct)
    return long.where(F.col("pct_missing") > 0) if only_missing else long


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Count, share and label text of each class of a classification target."""
    counts = (
        df.where(F.col(target).isNotNull()).groupBy(F.col(target).cast("string").alias("class"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # A classification target has fewer than twenty classes: this window is bounded.
    pct = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())
    return counts.withColumn("pct", F.round(pct, 2)).withColumn(
        "text", F.format_string("%d (%.2f%%)", F.col("n"), F.col("pct"))
    )


def target_stats(df: DataFrame, target: str) -> DataFrame:
    c = F.col(target).cast("double")
    return df.agg(
        F.min(c).alias("min"), F.max(c).alias("max"), F.round(F.avg(c), 4).alias("mean"),
        F.round(corrected_skewness(c), 4).alias("skew"),
    )


def is_text_like(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, (T.StringType, T.BooleanType))


def fill_with_mode(df: DataFrame, target: str) -> DataFrame:
    """A class target as strings with gaps set to the modal class."""
    mode = fit_modes(df, [target])[target]
    filled = F.coalesce(F.col(target).cast("string"), F.lit(mode if mode is not None else "Missing"))
    return df.withColumn(target, filled)


def correlations(df: DataFrame, target: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of numeric columns with the target, ``(column, corr)``.

    A text target is filled with its mode and replaced by its sorted class codes.
    """
    require_column(df, target)
    cols = list(cols or infer_roles(df, [target]).numeric)
    df = df.select(*cols, target)
    if is_text_like(df, target):
        df = encode_label(fill_with_mode(df, target), target, "_target")
        y = F.col("_target")
    else:
        y = F.col(target).cast("double")
    df = normalise_nan(df)
    return melt_row(df, {c: {"corr": pairwise_correlation(F.col(c).cast("double"), y)} for c in cols})


def top_bottom(scores: DataFrame, value: str, k: int = 5) -> DataFrame:
    """First and last ``k`` rows by descending value, ties by name, with side and rank."""
    present = scores.where(F.col(value).isNotNull())
    ends = []
    for side, order in (
        ("top", [F.desc(value), F.asc("column")]), ("bottom", [F.asc(value), F.desc("column")])
    ):
        # One row per column of a table: the window is bounded by the table's width.
        rank = F.row_number().over(Window.orderBy(*order))
        ends.append(
            present.withColumn("rank", rank).where(F.col("rank") <= k)
            .select(F.lit(side).alias("side"), "rank", "column", value)
        )
    return ends[0].unionByName(ends[1]).withColumn(
        "sign", F.when(F.col(value) > 0, "positive").when(F.col(value) < 0, "negative")
        .otherwise("zero")
    )


def mutual_information(
    df: DataFrame, cols: Sequence[str], target: str, bins: int = MI_BINS
) -> DataFrame:
    """Plug-in mutual information (nats) of categorical columns with the target.

    Text targets count as classes, numeric ones are cut in quantile bins. All columns share
    one shuffle of their joint counts, and ``MI = H(x) + H(y) - H(x, y)`` needs no join of it.
    """
    if is_text_like(df, target):
        df = fill_with_mode(df, target)
        y = F.col(target)
    else:
        df = df.withColumn(target, to_number(F.col(target)))
        y = bin_by_cuts(F.col(target), fit_quantile_cuts(df, [target], bins)[target])
    pairs = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.coalesce(F.col(c).cast("string"), F.lit("Missing")).alias("value"),
        ) for c in cols
    ])
    joint = (
        df.select(y.alias("y"), F.explode(pairs).alias("x")).select("x.*", "y")
        .groupBy("column", "value", "y").agg(F.count(F.lit(1)).alias("n"))
    )
    of_x = (
        joint.groupBy("column", "value").agg(F.sum("n").alias("nx"), F.sum(xlogx(F.col("n"))).alias("xy"))
        .groupBy("column").agg(
            F.sum("nx").alias("n"), F.sum(xlogx(F.col("nx"))).alias("hx"), F.sum("xy").alias("hxy")
        )
    )
    of_y = (
        joint.groupBy("column", "y").agg(F.sum("n").alias("ny"))
        .groupBy("column").agg(F.sum(xlogx(F.col("ny"))).alias("hy"))
    )
    n = F.col("n").cast("double")
    mi = F.log(n) + (F.col("hxy") - F.col("hx") - F.col("hy")) / n
    return of_x.join(of_y, "column").select("column", F.greatest(mi, F.lit(0.0)).alias("mi"))


def value_samples(df: DataFrame, cols: Sequence[str], k: int = 5) -> DataFrame:
    """The ``k`` most frequent values of each column, ties by value.

    The rank filter becomes a per-task limit before the shuffle, so a column with many
    values sends only ``k`` rows per task.
    """
    order = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    return (
        counted_values(df, cols).withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )


def seeded_sample(df: DataFrame, key: Column, n: int = 5, seed: int = SEED) -> DataFrame:
    """``n`` rows that depend only on the keys and the seed."""
    order = df.withColumns({"_digest": digest(key, seed), "_key": key})
    return order.orderBy("_digest", "_key").limit(n).drop("_digest", "_key")


def _number(c: Column, places: int = 4) -> Column:
    return F.format_string(f"%.{places}f", F.round(c, places))


def _section(df: DataFrame, section: str, item, value) -> DataFrame:
    item, value = item.cast("string"), value.cast("string")
    return df.select(F.lit(section).alias("section"), item.alias("item"), value.alias("value"))


def profile_report(df: DataFrame, target: str, key: Column) -> DataFrame:
    """The whole profile as ``(section, item, value)`` text rows; bounded by the table's width."""
    require_column(df, target)
    roles = infer_roles(df, [target])
    shape = table_shape(df)
    task = infer_task(df, target)
    spark = df.sparkSession
    head = spark.range(1)
    parts = [
        _section(shape, "overview", F.lit("rows"), F.col("n_rows").cast("string")),
        _section(shape, "overview", F.lit("columns"), F.col("n_columns").cast("string")),
        _section(head, "overview", F.lit("target"), F.lit(target)),
        _section(head, "target", F.lit("task"), F.lit(task)),
    ]
    if task == "classification":
        parts.append(_section(class_distribution(df, target), "target", F.col("class"), F.col("text")))
    else:
        stats = target_stats(df, target)
        pairs = F.array(*[
            F.struct(F.lit(s).alias("item"), _number(F.col(s)).alias("value"))
            for s in ("min", "max", "mean", "skew")
        ])
        stats = stats.select(F.explode(pairs).alias("x")).select("x.*")
        parts.append(_section(stats, "target", F.col("item"), F.col("value")))
    if roles.numeric:
        ends = top_bottom(correlations(df, target, roles.numeric), "corr")
        item = F.concat_ws(" ", "side", "rank", "column")
        parts.append(_section(ends, "correlation", item, _number(F.col("corr"))))
    if roles.categorical:
        mi = mutual_information(df, roles.categorical, target)
        mi = mi.orderBy(F.desc("mi"), "column").limit(10)
        parts.append(_section(mi, "mutual_info", F.col("column"), _number(F.col("mi"))))
        samples = value_samples(df, roles.categorical)
        item = F.concat_ws(" ", "column", "rank")
        parts.append(_section(samples, "samples", item, F.col("value")))
    missing = missing_profile(df)
    parts.append(_section(missing, "missing", F.col("column"), _number(F.col("pct_missing"), 2)))
    sample = seeded_sample(df.withColumn("_id", key), F.col("_id"))
    row = F.to_json(F.struct(*[c for c in df.columns]))
    parts.append(_section(sample, "sample", F.col("_id"), row))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# Section titles of the rendered profile.
TITLES = {
    "overview": "Dataset Overview", "target": "Target Profiling",
    "correlation": "Feature-to-Target Correlation (Numerical)",
    "mutual_info": "Categorical Feature Importance (Mutual Info)",
    "missing": "Missing Values (>0%)", "samples": "Categorical Value Samples (Top 5 Unique)",
    "sample": "Data Signature (Random 5-Row Sample)",
}


def render_markdown(report: DataFrame) -> str:
    """The report as Markdown; it is bounded, so it may be collected."""
    rows = report.collect()
    lines = ["# Exploratory Data Analysis"]
    for section, title in TITLES.items():
        lines += ["", f"## {title}"]
        items = sorted((r["item"], r["value"]) for r in rows if r["section"] == section)
        lines += [f"- {item}: {value}" for item, value in items]
    return "\n".join(lines) + "\n"
