"""Metrics over scored rows, for any number of models and folds in one pass.

Inputs have a label, a prediction or score, optional grouping columns (model, fold) and an
optional weight column, so pre-aggregated scores cost no more than their distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwise.functions.numeric import ratio, ratio_or_zero
from foldwise.operators.ordered import (
    CHUNK, CHUNK_ROWS, chunk_carry, with_chunks,
)
from foldwise.session import materialise

CLIP = 1e-15
EPSILON = 2.220446049250313e-16


def _weight(weight: str | None) -> Column:
    return F.lit(1) if weight is None else F.col(weight)


def binary_counts(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", pred: str = "prediction",
    weight: str | None = None,
) -> DataFrame:
    """tp, fp, fn, tn in one pass."""
    y, p, w = F.col(label) == 1, F.col(pred) == 1, _weight(weight)
    cells = {"tp": y & p, "fp": ~y & p, "fn": y & ~p, "tn": ~y & ~p}
    return df.groupBy(*by).agg(*[
        F.coalesce(F.sum(F.when(c, w)), F.lit(0)).cast("bigint").alias(n) for n, c in cells.items()
    ])


def binary_report(counts: DataFrame) -> DataFrame:
    """Accuracy, F1, precision, sensitivity, specificity, balanced accuracy from the counts."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    sensitivity, specificity = ratio_or_zero(tp, tp + fn), ratio_or_zero(tn, tn + fp)
    return counts.withColumns({
        "positives": tp + fn, "negatives": tn + fp,
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
        "precision": ratio_or_zero(tp, tp + fp),
        "sensitivity": sensitivity, "specificity": specificity,
        "balanced_accuracy": (sensitivity + specificity) / 2,
    })


def confusion(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", pred: str = "prediction",
    weight: str | None = None,
) -> DataFrame:
    return df.groupBy(*by, label, pred).agg(F.sum(_weight(weight)).cast("bigint").alias("n"))


def multiclass_report(
    matrix: DataFrame, by: Sequence[str] = (), label: str = "label", pred: str = "prediction",
    counts: bool = False,
) -> DataFrame:
    """Accuracy, macro and micro F1 from a confusion table, over label and predicted classes.

    ``counts`` adds ``class_counts``, the rows of every class that has any, in class order.
    """
    present = F.when(F.col("rows") > 0, F.struct("class", "rows"))
    listed = [F.array_sort(F.collect_list(present)).alias("class_counts")] if counts else []
    hit = F.col(label) == F.col(pred)
    cells = F.when(hit, F.array(F.struct(
        F.col(label).alias("class"), F.col("n").alias("tp"), F.lit(0).cast("bigint").alias("miss"),
        F.col("n").alias("rows")
    ))).otherwise(F.array(
        F.struct(F.col(label).alias("class"), F.lit(0).cast("bigint").alias("tp"),
                 F.col("n").alias("miss"), F.col("n").alias("rows")),
        F.struct(F.col(pred).alias("class"), F.lit(0).cast("bigint").alias("tp"),
                 F.col("n").alias("miss"), F.lit(0).cast("bigint").alias("rows")),
    ))
    classes = (
        matrix.select(*by, F.explode(cells).alias("x")).select(*by, "x.*")
        .groupBy(*by, "class").agg(
            F.sum("tp").alias("tp"), F.sum("miss").alias("miss"), F.sum("rows").alias("rows"))
    )
    f1 = ratio_or_zero(2 * F.col("tp"), 2 * F.col("tp") + F.col("miss"))
    return classes.groupBy(*by).agg(
        F.sum("rows").alias("n"), F.count_if(F.col("rows") > 0).alias("classes"),
        ratio(F.sum("tp"), F.sum("rows")).alias("accuracy"), F.avg(f1).alias("f1_macro"),
        ratio_or_zero(2 * F.sum("tp"), 2 * F.sum("tp") + F.sum("miss")).alias("f1_micro"), *listed,
    )


def regression_report(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", pred: str = "prediction"
) -> DataFrame:
    y, error = F.col(label).cast("double"), F.col(label) - F.col(pred)
    mse = F.avg(error * error)
    scale = F.greatest(F.abs(y), F.lit(EPSILON))
    return df.groupBy(*by).agg(
        F.count(y).alias("n"), mse.alias("mse"), F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"), F.avg(F.abs(error) / scale).alias("mape"),
        (F.lit(1.0) - F.try_divide(F.sum(error * error), F.var_pop(y) * F.count(y))).alias("r2"),
        (-mse).alias("neg_mean_squared_error"),
    )


def score_points(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score",
    weight: str | None = None, rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``(by..., score, pos, neg, lower)``: rows per distinct score and negatives below it.

    Rows collapse to distinct scores, combined map-side and written once. The scores are cut
    in chunks, and a chunk needs only the number of negatives in the chunks below it.
    """
    by = list(by)
    w, y = _weight(weight), F.col(label)
    points = df.where(F.col(score).isNotNull() & y.isNotNull()).groupBy(*by, score).agg(
        F.sum(F.when(y == 1, w).otherwise(0)).alias("pos"),
        F.sum(F.when(y == 1, 0).otherwise(w)).alias("neg"),
    )
    points = with_chunks(materialise(points), score, rows)
    points = chunk_carry(points, by, {"_sum": F.sum("neg")}, {"_below": ("_sum", F.sum)})
    inside = (
        Window.partitionBy(*by, CHUNK).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    )
    lower = F.coalesce(F.col("_below"), F.lit(0)) + F.coalesce(F.sum("neg").over(inside), F.lit(0))
    return points.select(*by, score, "pos", "neg", lower.alias("lower"))


def _auc() -> Column:
    area = F.col("pos") * (F.col("lower") + F.col("neg") / 2.0)
    return F.try_divide(F.sum(area), F.sum("pos").cast("double") * F.sum("neg").cast("double"))


def roc_auc(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score",
    weight: str | None = None, rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Exact ROC AUC per group, ties counted half; NULL without both classes."""
    points = score_points(df, by, label, score, weight, rows)
    return points.groupBy(*by).agg(_auc().alias("roc_auc"))


def roc_auc_one_vs_rest(
    df: DataFrame, classes: Sequence, by: Sequence[str] = (), label: str = "label",
    probs: str = "probabilities", rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Macro mean of the one-vs-rest AUCs; ``probs`` is an array in class order."""
    each = F.array(*[
        F.struct(
            F.lit(c).alias("_class"), (F.col(label) == F.lit(c)).cast("int").alias("_is"),
            F.get(F.col(probs), F.lit(i)).alias("_score"),
        ) for i, c in enumerate(classes)
    ])
    long = df.select(*by, F.explode(each).alias("x")).select(*by, "x.*")
    per_class = roc_auc(long, [*by, "_class"], "_is", "_score", rows=rows)
    return per_class.groupBy(*by).agg(F.avg("roc_auc").alias("roc_auc"))


def log_loss(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", probs: str = "probabilities"
) -> DataFrame:
    """``neg_log_loss`` per group: the mean log of the label's own probability in the array ``probs``.

    NULL for a group whose arrays are missing or do not sum to 1; probabilities are clipped as usual.
    """
    values = F.col(probs)
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    proper = F.coalesce((F.abs(total - 1) < 1e-6) & F.forall(values, lambda v: v.between(0, 1)), F.lit(False))
    own = F.get(values, F.col(label).cast("int"))
    own = F.least(F.greatest(own, F.lit(CLIP)), F.lit(1 - CLIP))
    return df.groupBy(*by).agg(F.when(F.bool_and(proper), F.avg(F.log(own))).alias("neg_log_loss"))


def binary_scores(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score",
    weight: str | None = None, threshold: float = 0.5, rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Every binary scorer from the distinct scores: higher is better for each."""
    points = score_points(df, by, label, score, weight, rows)
    hit = F.col(score) >= threshold
    pos, neg = F.col("pos"), F.col("neg")
    p = F.least(F.greatest(F.col(score), F.lit(CLIP)), F.lit(1 - CLIP))
    tp, claimed = F.sum(F.when(hit, pos).otherwise(0)), F.sum(F.when(hit, pos + neg).otherwise(0))
    n, real = F.sum(pos + neg), F.sum(pos)
    return points.groupBy(*by).agg(
        ratio(F.sum(F.when(hit, pos).otherwise(neg)), n).alias("accuracy"),
        ratio_or_zero(2 * tp, claimed + real).alias("f1"), _auc().alias("roc_auc"),
        ratio(F.sum(pos * F.log(p) + neg * F.log(1 - p)), n).alias("neg_log_loss"),
    )


BINARY_SCORERS = ("accuracy", "f1", "roc_auc", "neg_log_loss")
REGRESSION_SCORERS = ("r2", "neg_mean_squared_error")
MULTICLASS_SCORERS = ("accuracy", "f1_macro", "f1_micro", "roc_auc")


def to_leaderboard(scores: DataFrame, metrics: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Wide scores to ``(by..., metric, value)``."""
    pairs = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
    ])
    return scores.select(*by, F.explode(pairs).alias("x")).select(*by, "x.*")


def mean_scores(leaderboard: DataFrame, by: Sequence[str] = ("model", "metric")) -> DataFrame:
    """Mean over folds."""
    return leaderboard.groupBy(*by).agg(F.avg("value").alias("value"))


def best_model(means: DataFrame, by: Sequence[str] = ("metric",)) -> DataFrame:
    """Model with the highest mean per metric, ties to the first name.

    Means equal to nine places are ties: the last digits depend on the order of summation.
    """
    present = means.where(F.col("value").isNotNull())
    order = F.struct((-F.round("value", 9)).alias("v"), F.col("model"))
    first = F.min_by(F.struct("model", "value"), order)
    return present.groupBy(*by).agg(first.alias("x")).select(*by, "x.model", "x.value")


def argmax(probs: Column) -> Column:
    """Index of the first maximum of an array."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


# Fixed values below: the layout of the text reports.
def binary_text(report: DataFrame, model: str = "model") -> DataFrame:
    """One text block per model."""
    text = F.format_string(
        "--- %s ---\n  Pos Cases: %d | Neg Cases: %d\n  Accuracy:    %.4f\n"
        "  F1 Score:    %.4f\n  Sensitivity: %.4f\n  Specificity: %.4f\n",
        F.upper(model), F.col("positives"), F.col("negatives"),
        *[F.round(c, 4) for c in ("accuracy", "f1", "sensitivity", "specificity")],
    )
    return report.select(model, text.alias("report"))


def multiclass_text(report: DataFrame, model: str = "model") -> DataFrame:
    """One text block per model, from a report with class counts."""
    each = F.transform("class_counts", lambda c: F.concat(c["class"].cast("string"), F.lit(": "), c["rows"].cast("string")))
    text = F.format_string(
        "--- %s ---\n  Classes: %d | Counts: {%s}\n  Accuracy:    %.4f\n  Macro F1:    %.4f\n  Micro F1:    %.4f\n",
        F.upper(model), F.col("classes"), F.array_join(each, ", "),
        *[F.round(c, 4) for c in ("accuracy", "f1_macro", "f1_micro")],
    )
    return report.select(model, text.alias("report"))
