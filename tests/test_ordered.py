"""Chunked order work equals the plain window, at any chunk size and partitioning."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwise.operators import folds, metrics, ordered, runlog


def hot_runs(spark, n=900):
    """One experiment holds a third of the rows; many are short."""
    rng = random.Random(7)
    rows = []
    for i in range(n):
        exp = 0 if i % 3 == 0 else 1 + rng.randrange(40)
        score = None if rng.random() < 0.25 else round(rng.choice([0.1, 0.5, 0.52, 0.9]) + i / 1e4, 4)
        rows.append((exp, i, score, None if score is not None else "Script Execution Timed Out"))
    return spark.createDataFrame(rows, "experiment bigint, iteration bigint, score double, error string")


def replay(rows, seed, margin, patience):
    """The policy, run by run."""
    best, crashes, outside, out = seed, 0, 0, []
    for score in rows:
        if score is None:
            crashes += 1
            action = "retry"
            if crashes >= 2:
                action, crashes, outside = "crash_rollback", 0, 0
        elif score > best:
            best, crashes, outside, action = score, 0, 0, "commit"
        elif best - score <= margin:
            crashes, outside, action = 0, 0, "explore"
        else:
            outside += 1
            action = "warn"
            if outside >= patience:
                action, crashes, outside = "rollback", 0, 0
        out.append((action, crashes, outside))
    return out


@pytest.mark.parametrize("rows", [10_000, 100, 7])
@pytest.mark.parametrize("patience", [1, 3])
def test_policy_matches_plain_loop(spark, rows, patience):
    runs = hot_runs(spark).repartition(5)
    got = runlog.replay_policy(runs, 0.2, 0.05, patience, rows=rows).collect()
    assert len(got) == 900
    for exp in {r["experiment"] for r in got}:
        mine = sorted((r for r in got if r["experiment"] == exp), key=lambda r: r["iteration"])
        want = replay([r["score"] for r in mine], 0.2, 0.05, patience)
        assert [(r["action"], r["crashes"], r["outside"]) for r in mine] == want


def test_policy_continues_from_state(spark):
    runs = hot_runs(spark)
    whole = runlog.replay_policy(runs, 0.2).select("experiment", "iteration", "action")
    early, late = runs.where("iteration < 500"), runs.where("iteration >= 500")
    first = runlog.replay_policy(early, 0.2)
    second = runlog.replay_policy(late, 0.2, state=runlog.final_state(first), rows=50)
    parts = first.select("experiment", "iteration", "action").unionByName(
        second.select("experiment", "iteration", "action"))
    assert whole.exceptAll(parts).count() == 0
    assert parts.count() == 900


@pytest.mark.parametrize("rows", [10_000, 40])
def test_previous_and_improved_match_window(spark, rows):
    runs = hot_runs(spark)
    w = Window.partitionBy("experiment").orderBy("iteration")
    want = runs.select(
        "iteration", F.lag("error").over(w).alias("before"),
        F.max("score").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("best_before"),
    )
    got = runlog.with_previous(runlog.with_improved(runs, None, rows=rows), "error", "before")
    got = got.select("iteration", "before", "best_before")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_position_with_ties(spark):
    df = spark.range(2000).select(
        (F.col("id") % 3).alias("g"), (F.col("id") % 11).cast("double").alias("t"), "id")
    w = Window.partitionBy("g").orderBy("t", "id")
    want = df.select("id", F.row_number().over(w).cast("bigint").alias("position"))
    got = ordered.row_number_in_group(df, ["g"], ["t", "id"], rows=150).select("id", "position")
    assert got.exceptAll(want).count() == 0 and got.count() == 2000


@pytest.mark.parametrize("exact_rows", [1 << 20, 50, 1])
def test_quantiles_with_heavy_ties(spark, exact_rows):
    """A third of the values are equal; ranks fall before, in and after the tie."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise((F.col("id") * 7919 % 2003) / 100.0).alias("a"),
        F.when(F.col("id") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("id").cast("double")).alias("b"),
        F.lit(None).cast("double").alias("c"),
    )
    probs = [0.0, 0.1, 0.24, 0.25, 0.3, 0.5, 0.75, 1.0]
    got = ordered.exact_quantiles(df, {c: F.col(c) for c in "abc"}, probs, exact_rows)
    for c in "ab":
        values = sorted(r[0] for r in df.select(c).collect() if r[0] is not None and not math.isnan(r[0]))
        for p, v in zip(probs, got[c], strict=True):
            at = p * (len(values) - 1)
            lo, hi = math.floor(at), math.ceil(at)
            assert v == pytest.approx(values[lo] + (at - lo) * (values[hi] - values[lo]))
    assert got["c"] == [None] * len(probs)


def test_dense_codes_by_range_equal_window(spark):
    df = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("v")).repartition(7)
    small, large = ordered.dense_codes(df, "v"), ordered.dense_codes(df, "v", rows=10)
    assert small.exceptAll(large).count() == 0 and large.count() == 500


@pytest.mark.parametrize("weight", ["n", None])
def test_lookup_join_splits_hot_keys(spark, weight):
    """A third of the rows share a key, some have none, and one hot key is not in the table."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, -1).when(
        F.col("id") % 10 != 7, F.col("id"))
    df = spark.range(3000).select("id", key.alias("k"))
    table = df.where("k is not null and k <> -1 and k <> 8").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = ordered.lookup_join(df, table, ["k"], weight, limit=5)
    want = df.join(table, "k", "left")
    assert got.count() == 3000
    assert got.select("id", "k", "n").exceptAll(want.select("id", "k", "n")).count() == 0


def test_first_rows_by_cut_equal_top_n(spark):
    df = spark.range(1000).select("id", (F.col("id") % 17).cast("double").alias("v"))
    got = ordered.first_rows(df, F.col("v"), "id", 400, exact_rows=20, small=10)
    want = df.orderBy("v", "id").limit(400)
    assert got.exceptAll(want).count() == 0 and got.count() == 400


@pytest.mark.parametrize("rows", [10_000, 30])
def test_auc_with_ties_equals_all_pairs(spark, rows):
    rng = random.Random(3)
    data = [(m, rng.randrange(2), rng.randrange(200) / 100) for m in ("a", "b") for _ in range(400)]
    df = spark.createDataFrame(data, "model string, label int, score double")
    got = {r["model"]: r["roc_auc"] for r in metrics.roc_auc(df, ["model"], rows=rows).collect()}
    for m in "ab":
        pos = [s for k, y, s in data if k == m and y]
        neg = [s for k, y, s in data if k == m and not y]
        wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
        assert got[m] == pytest.approx(wins / len(pos) / len(neg))


def test_stratified_folds_with_chunks(spark):
    df = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("c"), (F.col("id") % 2).cast("string"))).alias("y"))
    key = F.col("id").cast("string")
    plain = folds.stratified_kfold(df, "y", key)
    split = folds.stratified_kfold(df.repartition(9), "y", key, rows=50)
    assert plain.select("id", "fold").exceptAll(split.select("id", "fold")).count() == 0
    for r in plain.groupBy("y").pivot("fold").count().collect():
        sizes = [r[str(i)] for i in range(5)]
        assert max(sizes) - min(sizes) <= 1
