"""Statistics of all folds in one pass, against fits fold by fold."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from foldwise.operators import evaluate, folds, ordered, preprocess, tuning

FOLDS = range(4)


def frame(spark, by):
    """1,000 rows: a spread, a heavy tie, gaps, an empty column; folds by hash, by value or with one missing."""
    value = F.pmod(F.col("id") * 7919, F.lit(1000)).cast("double")
    df = spark.range(1000).select(
        "id", value.alias("x"), F.when(F.col("id") % 3 != 0, F.lit(5.0)).otherwise(value).alias("tie"),
        F.when(F.col("id") % 4 == 0, value).alias("gap"), F.lit(None).cast("double").alias("none"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("c"), F.col("id") % 6)).alias("word"),
    )
    if by == "hash":
        return folds.kfold(df, F.col("id"), 4)
    if by == "value":
        return df.withColumn("fold", F.floor(F.col("x") / 250).cast("int"))
    return folds.kfold(df, F.col("id"), 3)


@pytest.mark.parametrize("by", ["hash", "value", "missing"])
@pytest.mark.parametrize("limit", [None, 60])
def test_scaling_of_all_folds_equals_fits_fold_by_fold(spark, by, limit, monkeypatch):
    df = frame(spark, by).persist()
    if limit:
        whole = preprocess.medians_without_fold
        monkeypatch.setattr(preprocess, "medians_without_fold", lambda *a: whole(*a, exact_rows=limit))
    cols = ["x", "tie", "gap", "none"]
    found = preprocess.fit_scaling_by_fold(df, cols, impute="median", folds=FOLDS)
    for i in FOLDS:
        alone = preprocess.fit_scaling(df.where(F.col("fold") != i), cols)
        for c in cols:
            got, want = found[c][i], alone[c]
            assert got.fill == pytest.approx(want.fill)
            assert got.center == pytest.approx(want.center)
            assert got.scale == pytest.approx(want.scale)


@pytest.mark.parametrize("by", ["hash", "value", "missing"])
def test_categories_of_all_folds_equal_fits_fold_by_fold(spark, by):
    df = frame(spark, by).withColumn("empty", F.lit(None).cast("string"))
    found = preprocess.fit_categories_by_fold(df, ["word", "empty"], FOLDS)
    for i in FOLDS:
        train = df.where(F.col("fold") != i)
        words = sorted(r[0] for r in train.select("word").distinct().collect() if r[0])
        assert found[i]["word"] == (preprocess.fit_modes(train, ["word"])["word"], words)
        assert found[i]["empty"] == (None, [])


def test_stages_of_columns_with_unlike_numbers_of_categories(spark):
    df = spark.range(200).select(
        F.col("id").cast("string").alias("key"), (F.col("id") % 2).cast("double").alias("label"),
        (F.col("id") % 3).cast("int").alias("fold"), F.lit("only").alias("one"),
        F.element_at(F.array(*map(F.lit, "ab")), (F.col("id") % 2 + 1).cast("int")).alias("two"),
        F.element_at(F.array(*map(F.lit, "pqrst")), (F.col("id") % 5 + 1).cast("int")).alias("five"),
        F.lit(None).cast("string").alias("none"), F.col("id").cast("double").alias("x"),
    )
    p = evaluate.Prepared(df, "y", "classification", ["x"], ["one", "two", "five", "none"], [], [0, 1], 3)
    for i, stages in enumerate(evaluate.fit_by_fold(p)):
        train = df.where(F.col("fold") != i)
        model = Pipeline(stages=evaluate.preparation(p, fitted=stages)).fit(train)
        plain = Pipeline(stages=evaluate.preparation(p)).fit(train)
        got, want = (m.transform(df).orderBy("key").select("features").collect() for m in (model, plain))
        assert all(g.features.toArray() == pytest.approx(w.features.toArray()) for g, w in zip(got, want, strict=True))


def test_a_failing_preparation_is_a_row_of_errors(spark):
    df = spark.createDataFrame([("a", 1.0, 0, None), ("b", 0.0, 1, None)], "key string, label double, fold int, x double")
    p = evaluate.Prepared(df, "y", "classification", ["missing"], [], [], [0, 1], 2)
    rows = evaluate.leaderboard(p, ["ridge", "tree"]).collect()
    assert sorted(r.model for r in rows) == ["ridge", "tree"] and all(r.error for r in rows)


def test_fits_have_tasks_by_rows_not_by_shuffle_partitions(spark, monkeypatch):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 2).alias("y"), (F.col("id") / 7).alias("x"))
    most = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        small = evaluate.prepare(df, "y", F.col("k"), "classification", 3, drop=["k"])
        monkeypatch.setattr(evaluate, "CELLS", 300)
        split = evaluate.prepare(df, "y", F.col("k"), "classification", 3, drop=["k"])
        monkeypatch.setattr(evaluate, "CELLS", 3)
        bound = evaluate.prepare(df, "y", F.col("k"), "classification", 3, drop=["k"])
        assert [p.frame.rdd.getNumPartitions() for p in (small, split, bound)] == [1, 10, 40]
        assert {tuple(r) for r in small.frame.collect()} == {tuple(r) for r in bound.frame.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", most)


def test_tied_medians_read_no_rows(spark, monkeypatch):
    """Ties at a bracket's ends are counted, whatever their number; only values between are read."""
    df = folds.kfold(spark.range(5000).select("id", (F.col("id") % 3).cast("double").alias("x")), F.col("id"), 4)
    counts = {r["fold"]: {"x": r["n"]} for r in folds.fold_sizes(df).collect()}

    def no_reading(*_):
        raise AssertionError("rows were read off")

    monkeypatch.setattr(ordered, "_read_off_by_fold", no_reading)
    found = ordered.medians_without_fold(df, {"x": F.col("x")}, "fold", counts, range(4), exact_rows=100)
    for i in range(4):
        assert found["x"][i] == df.where(F.col("fold") != i).agg(F.percentile("x", 0.5)).first()[0]


def test_one_metric_is_scored_without_the_others(spark, monkeypatch):
    rows = [(i % 2, float(i % 2), float(i % 3 > 0), (i % 7) / 7, [1 - (i % 7) / 7, (i % 7) / 7]) for i in range(60)]
    oof = spark.createDataFrame(rows, "fold int, label double, prediction double, score double, probabilities array<double>")
    p = evaluate.Prepared(oof, "y", "classification", [], [], [], [0, 1], 2)
    every = {tuple(r) for r in evaluate.scores_of(p, oof).collect()}

    def unwanted(*_, **__):
        raise AssertionError("a metric that nobody asked for")

    monkeypatch.setattr(evaluate.metrics, "log_loss", unwanted)
    for metric, other in (("accuracy", "roc_auc"), ("f1", "roc_auc"), ("roc_auc", "binary_counts")):
        with monkeypatch.context() as m:
            m.setattr(evaluate.metrics, other, unwanted)
            found = {tuple(r) for r in evaluate.scores_of(p, oof, only=metric).collect()}
        assert found == {r for r in every if r[1] == metric}


def test_search_takes_a_fitted_preparation(spark, monkeypatch):
    df = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 2).alias("y"), (F.col("id") / 7).alias("x"))
    p = evaluate.prepare(df, "y", F.col("k"), "classification", 2, drop=["k"])
    fitted = evaluate.fit_by_fold(p)
    monkeypatch.setattr(tuning, "fit_by_fold", lambda _: pytest.fail("fitted again"))
    found = tuning.search(p, "tree", 1, space={"maxDepth": ("int", 2, 2)}, fitted=fitted).first()
    assert found["status"] == "ok"


def test_whole_table_preparation_comes_from_the_moments_of_the_folds(spark):
    df = folds.kfold(frame(spark, "hash").withColumnRenamed("id", "key").drop("fold"), F.col("key"), 3).withColumn("label", F.col("x"))
    p = evaluate.Prepared(df, "y", "regression", ["x", "tie", "gap", "none"], ["word"], [], [], 3)
    plain = Pipeline(stages=evaluate.preparation(p)).fit(df)
    (stages,) = evaluate.fit_by_fold(p, [evaluate.NO_FOLD])
    whole = Pipeline(stages=evaluate.preparation(p, fitted=stages)).fit(df)
    got, want = (m.transform(df).orderBy("key").select("features").collect() for m in (whole, plain))
    assert all(g.features.toArray() == pytest.approx(w.features.toArray()) for g, w in zip(got, want, strict=True))
