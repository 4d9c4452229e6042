"""Tables whose vectors are too many to be kept: the same rows, without a copy of the table a fold."""

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from foldwise.operators import evaluate
from foldwise.operators.registry import REGISTRY
from foldwise.plans import models


def prepared(spark, k=3):
    df = spark.range(600).select(
        F.col("id").cast("string").alias("k"), (F.col("id") % 2).alias("y"), (F.col("id") * 37 % 101).alias("x"),
        F.concat(F.lit("c"), F.col("id") % 4).alias("cat"), F.timestamp_seconds(F.col("id") * 86400).alias("t"),
    )
    return evaluate.prepare(df, "y", F.col("k"), "classification", k, drop=["k"], stratified=False).persist()


def rows(df):
    return sorted((r.key, r.fold, r.label, r.prediction, r.score, tuple(r.probabilities)) for r in df.collect())


def test_large_tables_keep_no_vectors_and_give_the_same_rows(spark, monkeypatch):
    def build():
        return REGISTRY["tree"].build("classification", 2, maxDepth=3)

    small = prepared(spark)
    assert small.cells == 600 * 7 and not small.large
    want = rows(evaluate.out_of_fold(small, build, 4)[0])
    monkeypatch.setattr(evaluate, "KEPT_CELLS", 100)
    large = prepared(spark)
    assert large.large
    with evaluate.fold_vectors(large, 0, evaluate.fit_by_fold(large, [0])[0]) as (_, train, valid):
        assert train.storageLevel == valid.storageLevel == StorageLevel.NONE
    monkeypatch.setattr(evaluate, "materialise", lambda _: pytest.fail("predictions were written row by row"))
    assert rows(evaluate.out_of_fold(large, build, 4)[0]) == want


def test_tasks_are_bounded_whatever_the_shuffle_partitions(spark, monkeypatch):
    most = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        monkeypatch.setattr(evaluate, "CELLS", 100)
        assert prepared(spark).frame.rdd.getNumPartitions() == 2
        monkeypatch.setattr(evaluate, "MOST_CELLS", 600)
        assert prepared(spark).frame.rdd.getNumPartitions() == 7
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", most)


def test_leaderboards_fit_the_registry_defaults(spark, folder, monkeypatch):
    """Neither rounds, trees nor iterations are cut."""
    asked = {}

    def board(p, names, params=None, parallelism=1, budget=None):
        asked[tuple(names)] = params
        return spark.createDataFrame([("ridge", 0, "accuracy", 1.0, None)], evaluate.BOARD_SCHEMA)

    monkeypatch.setattr(evaluate, "leaderboard", board)
    assert models.baseline_leaderboard(spark, folder).count() == models.further_models(spark, folder).count() == 1
    assert [len(names) for names in asked] == [5, 7] and not any(asked.values())
