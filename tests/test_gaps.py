"""NULL keys, single folds and failing models: no size and no gap in the data may change an answer."""

import pytest
from pyspark.sql import functions as F

from foldwise.operators import encode, folds, runlog, select


def gapped(spark):
    rows = [
        (None if i % 4 == 0 else f"e{i % 3}", None if i % 10 == 7 else i, None if i % 6 == 5 else float(i * 7 % 11))
        for i in range(40)
    ]
    return spark.createDataFrame(rows, "experiment string, iteration long, score double")


def test_policy_keeps_null_keys_at_any_chunk_size(spark):
    runs = gapped(spark).where("iteration IS NOT NULL")
    want = runlog.replay_policy(runs, 0.2)
    got = runlog.replay_policy(runs, 0.2, rows=5)
    names = ["experiment", "iteration", "best_before", "improved", "action", "crashes", "outside"]
    assert got.count() == want.count() == runs.count()
    assert want.select(names).exceptAll(got.select(names)).count() == 0


def test_policy_drops_no_run_without_an_order(spark):
    assert runlog.replay_policy(gapped(spark), 0.2, rows=5).count() == 40


@pytest.mark.parametrize("rows", [10_000, 20])
def test_null_class_is_dealt_evenly(spark, rows):
    df = spark.range(100).select("id", F.lit(None).cast("int").alias("y"))
    got = folds.stratified_kfold(df, "y", F.xxhash64("id"), 5, rows=rows).groupBy("fold").count().collect()
    counts = [r["count"] for r in got]
    assert sum(counts) == 100 and max(counts) - min(counts) <= 1


def test_target_encoding_with_one_fold(spark):
    df = spark.createDataFrame([("a", 0, 2, 1.0), ("b", 0, 2, 2.0)], "cat string, fold int, n long, s double")
    got = encode.encoding_by_fold(df, [], "cat", fold="fold", name="enc", smooth=1.0)
    assert sorted(r.enc for r in got.collect()) == [0.75, 0.75]


def test_f_of_one_row_per_class(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 4.0)], "y int, x double")
    assert select.anova_f(df, ["x"], "y").collect()[0]["score"] is None


def test_unknown_metric_is_rejected_before_any_fit():
    from types import SimpleNamespace

    from foldwise.operators import tuning

    with pytest.raises(ValueError, match="no_such_metric"):
        tuning.search(SimpleNamespace(task="classification", classes=[0, 1], frame=None), "lgb", metric="no_such_metric")
