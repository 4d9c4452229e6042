"""Scored predictions: metrics per fold, means, leaderboard, votes and text reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators import ensemble, folds, metrics, ordered
from foldwise.plans.fixtures import (
    CLASS_RATES, FOLDS, LINE_KEY, PRICE_ROWS, SCORED_ROWS, class_list, class_predictions,
    lineitem, price_predictions, scored_counts, sql_fold,
)
from foldwise.sources.tables import table

QUERIES, ORACLE = {}, {}


def _round(df: DataFrame, cols, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


# --- binary ---------------------------------------------------------------------------
AUC_SQL = """ranked AS (
  SELECT model, fold, score, sum(label) AS pos, count(*) - sum(label) AS neg
  FROM scored GROUP BY ALL),
stepped AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY model, fold ORDER BY score
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower_neg FROM ranked),
auc AS (
  SELECT model, fold, sum(pos * (lower_neg + neg / 2.0::DOUBLE))
         / (sum(pos)::DOUBLE * sum(neg)::DOUBLE) AS roc_auc FROM stepped GROUP BY ALL)"""

SCORES_SQL = f"""{SCORED_ROWS},
{AUC_SQL},
marked AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred FROM scored),
basic AS (
  SELECT model, fold, avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END) AS accuracy,
         coalesce(2.0::DOUBLE * sum(pred * label) / nullif(sum(pred) + sum(label), 0), 0.0) AS f1,
         avg(CASE WHEN label = 1 THEN ln(least(greatest(score, 1e-15), 1 - 1e-15))
                  ELSE ln(1 - least(greatest(score, 1e-15), 1 - 1e-15)) END) AS neg_log_loss
  FROM marked GROUP BY ALL),
scores AS (SELECT * FROM basic JOIN auc USING (model, fold))"""


def scorers_by_fold(spark: SparkSession, sf: str) -> DataFrame:
    scores = metrics.binary_scores(scored_counts(spark, sf), ["model", "fold"], weight="n")
    return _round(scores, metrics.BINARY_SCORERS)


QUERIES["scorers_by_fold"] = scorers_by_fold
ORACLE["scorers_by_fold"] = f"""WITH {SCORES_SQL}
SELECT model, fold, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1,
       round(roc_auc, 6) AS roc_auc, round(neg_log_loss, 6) AS neg_log_loss FROM scores"""


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Mean score of both predictors per metric, with the best one marked."""
    scores = metrics.binary_scores(scored_counts(spark, sf), ["model", "fold"], weight="n")
    board = metrics.to_leaderboard(scores, metrics.BINARY_SCORERS, ["model", "fold"])
    means = metrics.mean_scores(board)
    best = metrics.best_model(means).select("metric", F.col("model").alias("best"))
    return means.join(F.broadcast(best), "metric").select(
        "model", "metric", F.round("value", 6).alias("mean_score"),
        (F.col("model") == F.col("best")).alias("is_best"),
    )


MEANS_SQL = f"""{SCORES_SQL},
long AS (
  SELECT model, fold, 'accuracy' AS metric, accuracy AS value FROM scores
  UNION ALL SELECT model, fold, 'f1', f1 FROM scores
  UNION ALL SELECT model, fold, 'roc_auc', roc_auc FROM scores
  UNION ALL SELECT model, fold, 'neg_log_loss', neg_log_loss FROM scores),
means AS (SELECT model, metric, avg(value) AS value FROM long GROUP BY ALL)"""

QUERIES["flagship_leaderboard"] = flagship
ORACLE["flagship_leaderboard"] = f"""WITH {MEANS_SQL}
SELECT model, metric, round(value, 6) AS mean_score,
       row_number() OVER (PARTITION BY metric ORDER BY round(value, 9) DESC, model) = 1 AS is_best
FROM means"""


def best_by_metric(spark: SparkSession, sf: str) -> DataFrame:
    scores = metrics.binary_scores(scored_counts(spark, sf), ["model", "fold"], weight="n")
    board = metrics.to_leaderboard(scores, metrics.BINARY_SCORERS, ["model", "fold"])
    best = metrics.best_model(metrics.mean_scores(board))
    return best.select("metric", "model", F.round("value", 6).alias("score"))


QUERIES["best_by_metric"] = best_by_metric
ORACLE["best_by_metric"] = f"""WITH {MEANS_SQL}
SELECT metric, model, round(value, 6) AS score FROM means
QUALIFY row_number() OVER (PARTITION BY metric ORDER BY round(value, 9) DESC, model) = 1"""


# A threshold near the base rate gives both classes predictions.
CUT = 0.3333


def _report(spark, sf, by):
    scored = scored_counts(spark, sf).withColumn(
        "prediction", (F.col("score") >= CUT).cast("int")
    )
    return metrics.binary_report(metrics.binary_counts(scored, by, weight="n"))


REPORT_COLS = (
    "accuracy", "f1", "precision", "sensitivity", "specificity", "balanced_accuracy",
)

REPORT_SQL = f"""{SCORED_ROWS},
marked AS (SELECT *, score >= {CUT}::DOUBLE AS pred FROM scored),
counts AS (
  SELECT model, fold, count(*) FILTER (label = 1 AND pred) AS tp,
         count(*) FILTER (label = 0 AND pred) AS fp,
         count(*) FILTER (label = 1 AND NOT pred) AS fn,
         count(*) FILTER (label = 0 AND NOT pred) AS tn FROM marked GROUP BY ALL),
pooled AS (
  SELECT model, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn,
         sum(tn)::BIGINT AS tn FROM counts GROUP BY ALL)"""


def _report_sql(source: str, by: str) -> str:
    return f"""SELECT {by}, tp, fp, fn, tn, tp + fn AS positives, tn + fp AS negatives,
  round((tp + tn)::DOUBLE / (tp + fp + fn + tn), 6) AS accuracy,
  round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
  round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 6) AS sensitivity,
  round(coalesce(tn::DOUBLE / nullif(tn + fp, 0), 0), 6) AS specificity,
  round((coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0)
         + coalesce(tn::DOUBLE / nullif(tn + fp, 0), 0)) / 2, 6) AS balanced_accuracy
FROM {source}"""


QUERIES["metrics_binary"] = lambda spark, sf: _round(
    _report(spark, sf, ["model", "fold"]), REPORT_COLS
)
ORACLE["metrics_binary"] = f"WITH {REPORT_SQL}\n{_report_sql('counts', 'model, fold')}"

QUERIES["text_report_binary"] = lambda spark, sf: metrics.binary_text(_report(spark, sf, ["model"]))
ORACLE["text_report_binary"] = f"""WITH {REPORT_SQL}, r AS ({_report_sql('pooled', 'model')})
SELECT model, printf('--- %s ---' || chr(10) || '  Pos Cases: %d | Neg Cases: %d' || chr(10)
  || '  Accuracy:    %.4f' || chr(10) || '  F1 Score:    %.4f' || chr(10)
  || '  Sensitivity: %.4f' || chr(10) || '  Specificity: %.4f' || chr(10),
  upper(model), positives, negatives, round(accuracy, 4), round(f1, 4),
  round(sensitivity, 4), round(specificity, 4)) AS report FROM r"""


def soft_vote(spark: SparkSession, sf: str) -> DataFrame:
    """Mean probability of both predictors per line; the encodings are looked up, not shuffled."""
    lines = lineitem(spark, sf).dropna(subset=["l_returnflag"]).select(
        "key", folds.fold_of(F.col("key"), FOLDS).alias("fold"),
        F.col("l_linestatus").alias("line_status"),
        F.month("l_shipdate").cast("string").alias("ship_month"),
    )
    encoded = scored_counts(spark, sf)
    for model in ("line_status", "ship_month"):
        table_ = encoded.where(F.col("model") == model).groupBy(
            F.col("cat").alias(model), "fold"
        ).agg(F.max("score").alias(f"p_{model}"), F.sum("n").alias("n"))
        lines = ordered.lookup_join(lines, table_, [model, "fold"], "n").drop("n")
    vote = ensemble.vote(["p_line_status", "p_ship_month"])
    return lines.select("key", F.round(vote, 6).alias("vote"))


QUERIES["soft_vote"] = soft_vote
ORACLE["soft_vote"] = f"""WITH {SCORED_ROWS},
keyed AS (
  SELECT {LINE_KEY} AS key, {sql_fold(LINE_KEY)} AS fold, l_linestatus AS status,
         CAST(month(l_shipdate) AS VARCHAR) AS ship_month
  FROM lineitem WHERE l_returnflag IS NOT NULL)
SELECT k.key, round((a.score + b.score) / 2, 6) AS vote FROM keyed k
JOIN encoded a ON a.model = 'line_status' AND a.cat = k.status AND a.fold = k.fold
JOIN encoded b ON b.model = 'ship_month' AND b.cat = k.ship_month AND b.fold = k.fold"""


def auc_of_columns(spark: SparkSession, sf: str) -> DataFrame:
    """AUC of raw numeric columns as scores of a returned line; many distinct scores."""
    cols = ("l_quantity", "l_extendedprice", "l_discount")
    each = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("score")) for c in cols
    ])
    lines = table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), F.explode(each).alias("x")
    ).select("x.*", "label")
    return metrics.roc_auc(lines, ["column"]).select("column", F.round("roc_auc", 6).alias("roc_auc"))


QUERIES["roc_auc"] = auc_of_columns
ORACLE["roc_auc"] = """WITH tall AS (
  SELECT 'l_quantity' AS column_, l_quantity AS score, l_returnflag = 'R' AS y FROM lineitem
  UNION ALL SELECT 'l_extendedprice', l_extendedprice, l_returnflag = 'R' FROM lineitem
  UNION ALL SELECT 'l_discount', l_discount, l_returnflag = 'R' FROM lineitem),
points AS (
  SELECT column_, score, count(*) FILTER (y) AS pos, count(*) FILTER (NOT y) AS neg
  FROM tall GROUP BY ALL),
stepped AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY column_ ORDER BY score
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low FROM points)
SELECT column_ AS "column", round(sum(pos * (low + neg / 2.0::DOUBLE))
  / (sum(pos)::DOUBLE * sum(neg)::DOUBLE), 6) AS roc_auc FROM stepped GROUP BY ALL"""


# --- multi-class ----------------------------------------------------------------------
QUERIES["confusion_multiclass"] = lambda spark, sf: metrics.confusion(
    class_predictions(spark, sf), ["fold"]
)
ORACLE["confusion_multiclass"] = f"""WITH {CLASS_RATES}
SELECT fold, label, prediction, count(*) AS n FROM predicted GROUP BY ALL"""


def metrics_multiclass(spark: SparkSession, sf: str) -> DataFrame:
    matrix = metrics.confusion(class_predictions(spark, sf), ["fold"])
    report = metrics.multiclass_report(matrix, ["fold"])
    return _round(report, ("accuracy", "f1_macro", "f1_micro"))


MULTI_SQL = f"""{CLASS_RATES},
both_ AS (
  SELECT fold, label AS class, (label = prediction)::INT AS hit, 1 AS real, 0 AS claimed FROM predicted
  UNION ALL SELECT fold, prediction, 0, 0, 1 FROM predicted),
per_class AS (
  SELECT fold, class, sum(hit) AS tp, sum(real) AS real, sum(claimed) AS claimed
  FROM both_ GROUP BY ALL),
multi AS (
  SELECT fold, sum(real)::BIGINT AS n, count(*) FILTER (real > 0) AS classes,
         sum(tp)::DOUBLE / sum(real) AS accuracy,
         avg(2.0::DOUBLE * tp / (real + claimed)) AS f1_macro,
         2.0::DOUBLE * sum(tp) / (sum(real) + sum(claimed)) AS f1_micro
  FROM per_class GROUP BY ALL)"""

QUERIES["metrics_multiclass"] = metrics_multiclass
ORACLE["metrics_multiclass"] = f"""WITH {MULTI_SQL}
SELECT fold, n, classes, round(accuracy, 6) AS accuracy, round(f1_macro, 6) AS f1_macro,
       round(f1_micro, 6) AS f1_micro FROM multi"""


def text_report_multiclass(spark: SparkSession, sf: str) -> DataFrame:
    rows = class_predictions(spark, sf).withColumn("model", F.lit("hour_rate"))
    matrix = metrics.confusion(rows, ["model"])
    return metrics.multiclass_text(metrics.multiclass_report(matrix, ["model"], counts=True))


QUERIES["text_report_multiclass"] = text_report_multiclass
ORACLE["text_report_multiclass"] = f"""WITH {CLASS_RATES},
pooled AS (SELECT 'hour_rate' AS model, label, prediction FROM predicted),
both_ AS (
  SELECT model, label AS class, (label = prediction)::INT AS hit, 1 AS real, 0 AS claimed FROM pooled
  UNION ALL SELECT model, prediction, 0, 0, 1 FROM pooled),
per_class AS (
  SELECT model, class, sum(hit) AS tp, sum(real) AS real, sum(claimed) AS claimed
  FROM both_ GROUP BY ALL)
SELECT model, printf('--- %s ---' || chr(10) || '  Classes: %d | Counts: {{%s}}' || chr(10)
  || '  Accuracy:    %.4f' || chr(10) || '  Macro F1:    %.4f' || chr(10)
  || '  Micro F1:    %.4f' || chr(10), upper(model), count(*) FILTER (real > 0),
  string_agg(class || ': ' || real, ', ' ORDER BY class) FILTER (real > 0),
  round(sum(tp)::DOUBLE / sum(real), 4), round(avg(2.0::DOUBLE * tp / (real + claimed)), 4),
  round(2.0::DOUBLE * sum(tp) / (sum(real) + sum(claimed)), 4)) AS report
FROM per_class GROUP BY model"""


def auc_multiclass(spark: SparkSession, sf: str) -> DataFrame:
    names = class_list(table(spark, sf, "events"), "event_type")
    rows = class_predictions(spark, sf)
    out = metrics.roc_auc_one_vs_rest(rows, names, ["fold"])
    return out.select("fold", F.round("roc_auc", 6).alias("roc_auc"))


QUERIES["roc_auc_multiclass"] = auc_multiclass
ORACLE["roc_auc_multiclass"] = f"""WITH {CLASS_RATES},
tall AS (
  SELECT s.fold, r.class, r.rate AS score, s.label = r.class AS y
  FROM src s JOIN rates r USING (cat, fold)),
points AS (
  SELECT fold, class, score, count(*) FILTER (y) AS pos, count(*) FILTER (NOT y) AS neg
  FROM tall GROUP BY ALL),
stepped AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY fold, class ORDER BY score
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low FROM points),
each_ AS (
  SELECT fold, class, sum(pos * (low + neg / 2.0::DOUBLE))
         / (sum(pos)::DOUBLE * sum(neg)::DOUBLE) AS roc_auc FROM stepped GROUP BY ALL)
SELECT fold, round(avg(roc_auc), 6) AS roc_auc FROM each_ GROUP BY fold"""


# --- regression -----------------------------------------------------------------------
def metrics_regression(spark: SparkSession, sf: str) -> DataFrame:
    report = metrics.regression_report(price_predictions(spark, sf), ["fold"])
    report = _round(report, ("mape", "r2"))
    return _round(report, ("rmse", "mae"), 3).withColumns({
        c: F.round(c, 0) for c in ("mse", "neg_mean_squared_error")
    })


QUERIES["metrics_regression"] = metrics_regression
ORACLE["metrics_regression"] = f"""WITH {PRICE_ROWS}
SELECT fold, count(*) AS n, round(avg((label - prediction) ** 2), 0) AS mse,
  round(sqrt(avg((label - prediction) ** 2)), 3) AS rmse,
  round(avg(abs(label - prediction)), 3) AS mae,
  round(avg(abs(label - prediction) / greatest(abs(label), 2.220446049250313e-16)), 6) AS mape,
  round(1 - sum((label - prediction) ** 2) / (var_pop(label) * count(*)), 6) AS r2,
  round(-avg((label - prediction) ** 2), 0) AS neg_mean_squared_error
FROM priced GROUP BY fold"""
