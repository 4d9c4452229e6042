"""Queries that fit models: cross-validation, tuning, ensembles, clustering."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StopWordsRemover, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.functions.hashing import unit_hash
from foldwise.operators import ensemble, evaluate, folds, metrics, output, tuning, unsupervised
from foldwise.operators.boosting import Boosted, Settings
from foldwise.operators.evaluate import FOLD, KEY, LABEL
from foldwise.operators.registry import REGISTRY, Ridge
from foldwise.plans.fixtures import LINE_KEY, line_key, lineitem, sql_fold
from foldwise.plans.preparing import ALPHA, ORACLE as PREPARING
from foldwise.sources import sinks
from foldwise.sources.tables import table
from foldwise.session import materialise, scratch_path

QUERIES, ORACLE = {}, {}

# Small models: the query shows the operators, not the longest fit.
SMALL = {"lgb": {"maxIter": 5, "maxDepth": 4}}
THREADS = 4
LINE_COLUMNS = (
    "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_shipdate",
)


def lines(spark: SparkSession, sf: str, k: int = 3) -> evaluate.Prepared:
    """Lines with a binary target: was the line returned."""
    df = table(spark, sf, "lineitem").withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    df = df.select(line_key().alias("line"), "returned", *LINE_COLUMNS)
    return evaluate.prepare(
        df, "returned", F.col("line"), "classification", k, drop=["line"], stratified=False
    ).persist()


def event_classes(spark: SparkSession, sf: str, k: int = 3) -> evaluate.Prepared:
    events = table(spark, sf, "events").select(
        "event_id", "event_type", "value", "ts", F.col("user_id").cast("string").alias("user")
    )
    return evaluate.prepare(events, "event_type", F.col("event_id"), k=k, drop=["event_id"]).persist()


def order_prices(spark: SparkSession, sf: str, k: int = 3) -> evaluate.Prepared:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority", "o_orderdate",
        F.col("o_custkey").cast("string").alias("customer"),
    )
    return evaluate.prepare(orders, "o_totalprice", F.col("o_orderkey"), k=k, drop=["o_orderkey"]).persist()


def _rounded(df: DataFrame, col: str = "value") -> DataFrame:
    return df.withColumn(col, F.round(col, 6))


def baseline_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    """All baselines and the fallback on lines, by fold, with their default rounds and trees and the winner marked."""
    p = lines(spark, sf)
    board = evaluate.leaderboard(p, ["xgb", "lgb", "cat", "ridge", "random_forest"], parallelism=THREADS)
    p.unpersist()
    best = metrics.best_model(metrics.mean_scores(board.where(F.col("error").isNull())))
    best = best.select("metric", F.col("model").alias("best"))
    return _rounded(board.join(F.broadcast(best), "metric", "left"))


QUERIES["baseline_leaderboard"] = baseline_leaderboard


def regression_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    """Order prices with a wide category (the customer) target-encoded inside each fold."""
    p = order_prices(spark, sf)
    board = evaluate.leaderboard(p, ["lgb", "ridge", "linear", "lasso", "naive_bayes"], SMALL, THREADS)
    p.unpersist()
    return _rounded(board)


QUERIES["regression_leaderboard"] = regression_leaderboard


def further_models(spark: SparkSession, sf: str) -> DataFrame:
    """The other registry entries on the five event classes, with their default iterations."""
    p = event_classes(spark, sf)
    board = evaluate.leaderboard(
        p, ["logistic", "elastic_net", "tree", "linear_svm", "naive_bayes", "mlp", "ridge"], parallelism=THREADS
    )
    p.unpersist()
    return _rounded(board)


QUERIES["further_models"] = further_models


def oof_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Out-of-fold predictions of all lines: each line once, by the fold it was held out in."""
    p = lines(spark, sf, 5)
    oof, _ = evaluate.out_of_fold(p, lambda: REGISTRY["logistic"].build("classification", 2, maxIter=5), THREADS)
    return oof.groupBy(FOLD).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(KEY).alias("n_keys"),
        F.sum(LABEL).cast("bigint").alias("n_returned"),
        F.bool_and(F.col("score").between(0, 1)).alias("in_range"),
    )


QUERIES["oof_coverage"] = oof_coverage
ORACLE["oof_coverage"] = f"""SELECT {sql_fold(LINE_KEY)} AS fold, count(*) AS n_rows,
  count(DISTINCT {LINE_KEY}) AS n_keys, count(*) FILTER (l_returnflag = 'R') AS n_returned,
  TRUE AS in_range FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1"""


def ridge_fitted(spark: SparkSession, sf: str) -> DataFrame:
    """The ridge candidate fitted on every training fold: it must equal the closed form."""
    rows = folds.kfold(lineitem(spark, sf), F.col("key")).select(
        "fold", F.col("l_extendedprice").alias(LABEL), "l_quantity"
    ).persist()
    pipeline = Pipeline(stages=[
        VectorAssembler(inputCols=["l_quantity"], outputCol="features"), Ridge(ALPHA)
    ])
    out = None
    for i in range(5):
        train, valid = folds.split_fold(rows, i)
        model = pipeline.fit(train)
        last = model.stages[-1]
        error = F.col(LABEL) - F.col("prediction")
        part = model.transform(valid).groupBy("fold").agg(
            F.round(F.lit(float(last.coefficients[0])), 4).alias("slope"),
            F.round(F.lit(float(last.intercept)), 3).alias("intercept"),
            F.round(F.avg(error * error), 0).alias("mse"),
        )
        out = part if out is None else out.unionByName(part)
    return out


QUERIES["ridge_fitted"] = ridge_fitted
ORACLE["ridge_fitted"] = PREPARING["ridge_by_fold"]


def forest_importances(spark: SparkSession, sf: str) -> DataFrame:
    """Top and bottom features of the last fold's forest, written and read back."""
    p = lines(spark, sf)
    model, scored = evaluate.fit_fold(
        p, REGISTRY["random_forest"].build("classification", 2, numTrees=10, maxDepth=5), p.folds - 1
    )
    ranked = evaluate.importances(model, scored)
    path = scratch_path(spark, "importances")
    sinks.write_importances(ranked, path)
    p.unpersist()
    return spark.read.parquet(path)


QUERIES["forest_importances"] = forest_importances


def fold_scores(spark: SparkSession, p: evaluate.Prepared, fit, name: str) -> DataFrame:
    """Metrics of every fold with the number that its ``fit(train, valid)`` returns beside the scored rows."""
    fitted, found, out = evaluate.fit_by_fold(p), [], None
    for i in range(p.folds):
        with evaluate.fold_vectors(p, i, fitted[i]) as (_, train, valid):
            n, scored = fit(train, valid)
            part = evaluate.keep(p, evaluate.output_columns(p, scored, FOLD, LABEL))
        found.append((i, n))
        out = part if out is None else out.unionByName(part)
    p.unpersist()
    numbers = spark.createDataFrame(found, f"fold int, {name} int")
    return _rounded(evaluate.scores_of(p, out).join(F.broadcast(numbers), FOLD)).select(FOLD, "metric", "value", name)


def select_by_importance(spark: SparkSession, sf: str) -> DataFrame:
    """A linear model on the features a forest found important on the other folds, for every fold."""
    p = lines(spark, sf)

    def fit(train: DataFrame, valid: DataFrame) -> tuple[int, DataFrame]:
        forest = REGISTRY["random_forest"].build("classification", 2, numTrees=10, maxDepth=5).fit(train)
        slicer = evaluate.slicer_by_importance(PipelineModel([forest]))
        linear = REGISTRY["logistic"].build("classification", 2, featuresCol="selected", maxIter=10)
        model = Pipeline(stages=[slicer, linear]).fit(train)
        return len(slicer.getIndices()), model.transform(valid)

    return fold_scores(spark, p, fit, "n_features")


QUERIES["select_by_importance"] = select_by_importance


def event_probabilities(spark: SparkSession, sf: str) -> tuple[DataFrame, list]:
    """Out-of-fold forest probabilities of all events, one column per class, and the classes."""
    p = event_classes(spark, sf)
    rows, _ = evaluate.out_of_fold(
        p, lambda: REGISTRY["random_forest"].build("classification", 5, numTrees=10, maxDepth=5), THREADS
    )
    p.unpersist()
    return output.raw_predictions(rows, KEY, "event_type", None, "probabilities", len(p.classes)), p.classes


def multiclass_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The likeliest class of every event, from probabilities out of its fold."""
    raw, classes = event_probabilities(spark, sf)
    return output.format_predictions(raw, "multiclass_class", ["event_id", "event_type"], "event_type", classes)


QUERIES["multiclass_scores"] = multiclass_scores


def multiclass_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Every event once, with a probability per class; they sum to 1."""
    raw, classes = event_probabilities(spark, sf)
    key, *columns = raw.columns
    whole = sum((F.col(f"`{c}`") for c in columns), F.lit(0.0))
    return raw.select(
        F.col(key).alias("event_id"), F.lit(len(columns)).alias("n_classes"),
        (F.abs(whole - 1) < 1e-6).alias("sums_to_1"),
    )


QUERIES["multiclass_coverage"] = multiclass_coverage
ORACLE["multiclass_coverage"] = """SELECT event_id, (SELECT count(DISTINCT event_type) FROM events)::INTEGER AS n_classes,
  TRUE AS sums_to_1 FROM events WHERE event_type IS NOT NULL"""


def refit_and_score(spark: SparkSession, sf: str) -> DataFrame:
    """Fit on early orders, score late ones with a missing and an extra column."""
    orders = table(spark, sf, "orders").withColumn("high", (F.col("o_totalprice") > 250_000).cast("int"))
    orders = orders.drop("o_totalprice")
    train, test = (orders.where(c) for c in (
        F.col("o_orderdate") < "2000-01-01", F.col("o_orderdate") >= "2000-01-01"
    ))
    p = evaluate.prepare(train, "high", F.col("o_orderkey"), k=3, drop=["o_orderkey"]).persist()
    score = evaluate.refit(p, REGISTRY["lgb"].build("classification", 2, maxIter=5, maxDepth=3))
    test = test.drop("high", "o_custkey").withColumn("note", F.lit("x"))
    scored = score(evaluate.align_test(p, test, F.col("o_orderkey")))
    raw = output.raw_predictions(scored, KEY, "high", "score")
    return output.format_predictions(raw, "0/1", ["o_orderkey", "high"])


QUERIES["refit_and_score"] = refit_and_score


def refit_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Every late order is scored once, as 0 or 1."""
    return refit_and_score(spark, sf).select("o_orderkey", F.col("high").cast("int").isin(0, 1).alias("is_class"))


QUERIES["refit_coverage"] = refit_coverage
ORACLE["refit_coverage"] = """SELECT o_orderkey, TRUE AS is_class FROM orders WHERE o_orderdate >= DATE '2000-01-01'"""


def tune_random(spark: SparkSession, sf: str) -> DataFrame:
    """Seeded search of two families and an unknown one; the best parameters are saved and read
    back, and the tree that they make on one half scores the other."""
    p = lines(spark, sf, 2)
    space = {"maxDepth": ("int", 2, 4), "minInstancesPerNode": ("int", 1, 50)}
    fitted = evaluate.fit_by_fold(p)
    out = tuning.search(p, "tree", 3, space=space, fitted=fitted).withColumn("family", F.lit("tree"))
    logistic = {"regParam": ("log", 1e-3, 1.0), "maxIter": ("int", 3, 6)}
    out = out.unionByName(
        tuning.search(p, "logistic", 3, "accuracy", space=logistic, parallelism=2, fitted=fitted)
        .withColumn("family", F.lit("logistic"))
    ).unionByName(tuning.search(p, "unknown", 1).withColumn("family", F.lit("unknown")))
    tree = out.where(F.col("family") == "tree")
    chosen = tuning.best_params(tree, space)
    best = tuning.best_trial(tree).first()
    path = scratch_path(spark, "params")
    sinks.write_params(spark, path, "tree", best["score"], "roc_auc", chosen)
    early, late = folds.split_fold(p.frame, 1)
    refitted = evaluate.refit(replace(p, frame=early), REGISTRY["tree"].build("classification", 2, **chosen))
    n_scored = refitted(late.drop(LABEL, FOLD)).where(F.col("score").between(0, 1)).count()
    p.unpersist()
    saved = sinks.read_params(spark, path).select(
        F.col("model").alias("family"), F.col("best_score").alias("saved_score"),
        F.lit(n_scored).alias("n_scored"),
    )
    return out.join(F.broadcast(saved), "family", "left").select(
        "family", "trial", "status", F.round("score", 6).alias("score"),
        F.to_json("params").alias("params"), F.round("saved_score", 6).alias("saved_score"), "n_scored",
    )


QUERIES["tune_random"] = tune_random


def tune_draws(spark: SparkSession, sf: str) -> DataFrame:
    """What the search tried, and how many lines its refitted best model scored."""
    tried = tune_random(spark, sf)
    drawn = F.from_json("params", "map<string,double>")
    return tried.select(
        "family", "trial", "status", F.coalesce(F.col("score").between(0, 1), F.lit(False)).alias("in_range"),
        F.coalesce(F.col("n_scored").cast("bigint"), F.lit(0)).cast("bigint").alias("n_scored"),
        *[F.round(drawn[n], 6).alias(n) for n in ("maxDepth", "minInstancesPerNode", "regParam", "maxIter")],
    )


def _draw_sql(name: str) -> str:
    return f"(('0x' || substr(md5('42|' || t || '|{name}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


QUERIES["tune_draws"] = tune_draws
ORACLE["tune_draws"] = f"""WITH trials AS (SELECT unnest(range(3))::INTEGER AS t),
held AS (SELECT count(*) AS n FROM lineitem WHERE l_returnflag IS NOT NULL AND {sql_fold(LINE_KEY, k=2)} = 1)
SELECT 'tree' AS family, t AS trial, 'ok' AS status, TRUE AS in_range, (SELECT n FROM held) AS n_scored,
  2 + floor({_draw_sql('maxDepth')} * 3) AS "maxDepth", 1 + floor({_draw_sql('minInstancesPerNode')} * 50) AS "minInstancesPerNode",
  NULL::DOUBLE AS "regParam", NULL::DOUBLE AS "maxIter" FROM trials
UNION ALL SELECT 'logistic', t, 'ok', TRUE, 0, NULL, NULL,
  round(exp(ln(1e-3::DOUBLE) + {_draw_sql('regParam')} * ln(1e3::DOUBLE)), 6), 3 + floor({_draw_sql('maxIter')} * 4) FROM trials
UNION ALL SELECT 'unknown', 0, 'pruned', FALSE, 0, NULL, NULL, NULL, NULL"""


def early_stopping(spark: SparkSession, sf: str) -> DataFrame:
    """Boosting that stops when a held-out share of the training rows no longer improves, for every fold."""
    p = lines(spark, sf, 3)

    def fit(train: DataFrame, valid: DataFrame) -> tuple[int, DataFrame]:
        marked = train.withColumn("held", unit_hash(F.col(KEY), "held") < 0.2)
        settings = Settings(rounds=10, depth=3, rate=0.3)
        model = Boosted(settings, 2, held="held", patience=2, tolerance=1e-4).fit(marked)
        return model.getNumTrees, model.transform(valid)

    return fold_scores(spark, p, fit, "rounds")


QUERIES["early_stopping"] = early_stopping


def stacked(spark: SparkSession, sf: str) -> DataFrame:
    """Logistic stack, soft vote and calibration of two models' out-of-fold scores, all cross-fitted."""
    p = lines(spark, sf)
    oof, _, _ = evaluate.predict_folds(p, {
        "tree": lambda: REGISTRY["tree"].build("classification", 2, maxDepth=4),
        "ridge": lambda: REGISTRY["ridge"].build("classification", 2),
    }, THREADS)
    long = oof.select(KEY, FOLD, LABEL, "score", "model")
    p.unpersist()
    held = range(p.folds)
    wide = evaluate.keep(p, ensemble.pivot_models(long, KEY, ["tree", "ridge"], LABEL, FOLD))
    wide = evaluate.keep(p, ensemble.platt_by_fold(wide, "ridge", held))
    final = ensemble.stack_by_fold(wide, ["tree", "ridge"], held).withColumn("vote", ensemble.vote(["tree", "ridge"]))
    each = F.array(*[
        F.struct(F.lit(n).alias("model"), F.col(c).alias("s"))
        for n, c in (("tree", "tree"), ("ridge_calibrated", "ridge"), ("vote", "vote"), ("stack", "score"))
    ])
    tall = final.select(LABEL, F.explode(each).alias("x")).select(LABEL, "x.model", F.col("x.s").alias("score"))
    scores = metrics.binary_scores(tall, ["model"])
    return scores.select("model", *[F.round(c, 6).alias(c) for c in metrics.BINARY_SCORERS])


QUERIES["stacked"] = stacked


def isotonic(spark: SparkSession, sf: str) -> DataFrame:
    """Isotonic calibration of an out-of-fold ridge score by the other folds.

    Per fold its rows and base rate, whether the mean calibrated score is within the rows'
    chance error of that rate, and whether all calibrated scores are probabilities.
    """
    p = lines(spark, sf)
    oof, _ = evaluate.out_of_fold(p, lambda: REGISTRY["ridge"].build("classification", 2), THREADS)
    scored = materialise(oof.select(KEY, FOLD, LABEL, "score"))
    p.unpersist()
    return ensemble.isotonic_by_fold(scored, "score", range(p.folds)).groupBy(FOLD).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(LABEL), 6).alias("rate"),
        (F.abs(F.avg("calibrated") - F.avg(LABEL)) < 3 / F.sqrt(F.count(F.lit(1)))).alias("close"),
        F.bool_and(F.col("calibrated").between(0, 1)).alias("in_range"),
    )


QUERIES["isotonic"] = isotonic
ORACLE["isotonic"] = f"""SELECT {sql_fold(LINE_KEY, k=3)} AS fold, count(*) AS n,
  round(avg((l_returnflag = 'R')::INTEGER), 6) AS rate, TRUE AS close, TRUE AS in_range
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1"""


def log_target(spark: SparkSession, sf: str) -> DataFrame:
    """Prices fitted on their logarithm and predicted on their own scale."""
    p = order_prices(spark, sf)
    oof, _ = evaluate.out_of_fold(p, lambda: evaluate.LogTarget(Ridge(1.0)), THREADS)
    rows = evaluate.scores_of(p, oof).collect()
    p.unpersist()
    return _rounded(spark.createDataFrame(rows, "fold int, metric string, value double"))


QUERIES["log_target"] = log_target


def prepared_hand_off(spark: SparkSession, sf: str) -> DataFrame:
    """The prepared frame written for tuning and read back: rows and labels by fold."""
    p = lines(spark, sf, 5)
    path = sinks.write_prepared(p.frame, scratch_path(spark, "prepared"))
    p.unpersist()
    return spark.read.parquet(path).groupBy(FOLD).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(LABEL).cast("bigint").alias("n_returned"),
        F.round(F.sum("l_quantity"), 2).alias("quantity"),
    )


QUERIES["prepared_hand_off"] = prepared_hand_off
ORACLE["prepared_hand_off"] = f"""SELECT {sql_fold(LINE_KEY)} AS fold, count(*) AS n_rows,
  count(*) FILTER (l_returnflag = 'R') AS n_returned, round(sum(l_quantity), 2) AS quantity
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1"""


# --- unsupervised ---------------------------------------------------------------------
def clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Three clusterings of the embeddings with cluster sizes and silhouette."""
    df = unsupervised.dealt(unsupervised.as_vector(table(spark, sf, "embeddings"), "embedding"), "vec_id")
    out = None
    for kind, k in (("kmeans", 10), ("bisecting", 10), ("mixture", 3)):
        found = unsupervised.cluster(df, kind, k)
        width = unsupervised.silhouette(found)
        part = found.groupBy(F.col("prediction").alias("cluster")).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(kind).alias("kind"), "cluster", "n", F.lit(round(width, 6)).alias("silhouette")
        )
        out = part if out is None else out.unionByName(part)
    return out


QUERIES["clusters"] = clusters


def cluster_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that each clustering places, and whether its silhouette is one."""
    return clusters(spark, sf).groupBy("kind").agg(
        F.sum("n").alias("n"), F.bool_and(F.col("silhouette").between(-1, 1)).alias("in_range")
    )


QUERIES["cluster_sizes"] = cluster_sizes
ORACLE["cluster_sizes"] = """SELECT unnest(['kmeans', 'bisecting', 'mixture']) AS kind, (SELECT count(*) FROM embeddings) AS n, TRUE AS in_range"""


def projections(spark: SparkSession, sf: str) -> DataFrame:
    """Explained variance of the leading components and leading singular values."""
    df = unsupervised.dealt(unsupervised.as_vector(table(spark, sf, "embeddings"), "embedding"), "vec_id")
    shares = unsupervised.principal_components(df, 5).explainedVariance.toArray().tolist()
    values = unsupervised.singular_values(df, 5)
    rows = [(i, round(a, 6), round(b, 4)) for i, (a, b) in enumerate(zip(shares, values, strict=True))]
    return spark.createDataFrame(rows, "component int, explained double, singular_value double")


QUERIES["projections"] = projections


def topic_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Heaviest terms of four topics of the documents."""
    stop = [w for x in ("english", "french", "german", "spanish") for w in StopWordsRemover.loadDefaultStopWords(x)]
    model, _ = unsupervised.topics(table(spark, sf, "documents").select("text"), "text", 4, None, 3, stop)
    return unsupervised.describe_topics(model, 8).withColumn("weight", F.round("weight", 6))


QUERIES["topic_terms"] = topic_terms
