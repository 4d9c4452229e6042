"""Cross-fitted ensembles, binned calibration, ridge beyond the normal equations, log loss."""

from __future__ import annotations

import math

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from foldwise.operators import ensemble, metrics, ordered
from foldwise.operators.registry import Ridge


@pytest.fixture(scope="module")
def scored(spark):
    score = F.pmod(F.col("id") * 37, F.lit(101)) / 101.0
    return spark.range(600).select(
        "id", (F.col("id") % 3).cast("int").alias("fold"), score.alias("a"), (1 - score).alias("b"),
        (F.pmod(F.col("id") * 7, F.lit(97)) / 97.0 < score).cast("int").alias("label"),
    ).persist()


@pytest.mark.parametrize("kind", ["stack", "platt", "isotonic"])
def test_labels_of_a_fold_never_reach_its_own_scores(scored, kind):
    changed = scored.withColumn("label", F.when(F.col("fold") == 1, 1 - F.col("label")).otherwise(F.col("label")))

    def out(df):
        if kind == "stack":
            df = ensemble.stack_by_fold(df, ["a", "b"], range(3)).withColumn("s", F.col("score"))
        elif kind == "platt":
            df = ensemble.platt_by_fold(df, "a", range(3)).withColumn("s", F.col("a"))
        else:
            df = ensemble.isotonic_by_fold(df, "a", range(3)).withColumn("s", F.col("calibrated"))
        return {r["id"]: (r["fold"], r["s"]) for r in df.select("id", "fold", "s").collect()}

    before, after = out(scored), out(changed)
    assert len(before) == len(after) == 600
    assert all(after[i][1] == pytest.approx(s) for i, (fold, s) in before.items() if fold == 1)
    assert any(abs(after[i][1] - s) > 1e-3 for i, (fold, s) in before.items() if fold != 1)


def test_isotonic_takes_one_score_and_nulls(scored):
    flat = scored.select(F.lit(0.4).alias("a"), "label", "fold").unionByName(
        scored.limit(1).select(F.lit(None).cast("double").alias("a"), "label", "fold"))
    model = ensemble.isotonic(flat, "a")
    rate = scored.agg(F.avg("label")).first()[0]
    assert list(model.predictions) == pytest.approx([rate])


def test_iterated_ridge_equals_the_normal_equations(spark):
    df = spark.range(300).select(
        (F.col("id") % 17).cast("double").alias("u"), (F.col("id") % 5 * 100).cast("double").alias("v"),
        (F.col("id") % 17 * 3 + F.col("id") % 5 * 7 + F.col("id") % 11).cast("double").alias("label"),
    )
    df = VectorAssembler(inputCols=["u", "v"], outputCol="features").transform(df)
    normal, iterated = Ridge(50.0).fit(df), Ridge(50.0, widest=1).fit(df)
    assert iterated.coefficients.toArray() == pytest.approx(normal.coefficients.toArray(), rel=1e-3)
    assert iterated.intercept == pytest.approx(normal.intercept, rel=1e-3)


def test_log_loss_by_hand_and_null_without_probabilities(spark):
    df = spark.createDataFrame(
        [("m", 0.0, [0.8, 0.2]), ("m", 1.0, [0.5, 0.5]), ("raw", 1.0, [-3.0, 3.0]), ("none", 1.0, None)],
        "model string, label double, probabilities array<double>",
    )
    got = {r["model"]: r["neg_log_loss"] for r in metrics.log_loss(df, ["model"]).collect()}
    assert got["m"] == pytest.approx((math.log(0.8) + math.log(0.5)) / 2)
    assert got["raw"] is None and got["none"] is None


def test_lookup_join_splits_a_hot_key_that_the_table_lacks(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 4 != 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    table = spark.range(0, 2000, 8).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    got = ordered.lookup_join(df, table, ["k"], limit=10).collect()
    assert len(got) == 2000
    assert all(r["v"] == (r["id"] if r["id"] % 8 == 0 else None) for r in got)
