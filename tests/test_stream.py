"""The replay of a stream, its state and the replay's plan."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F
from test_ordered import hot_runs

from foldwise.operators import ordered, runlog
from foldwise.session import shared_dir
from foldwise.streaming import policy

KEPT = ["experiment", "iteration", "action", "crashes", "outside"]


@pytest.fixture
def base(spark):
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def actions(spark, base):
    return {(r["experiment"], r["iteration"]): tuple(r)[2:] for r in policy.read_actions(spark, f"{base}/out").select(KEPT).collect()}


def play(spark, base, runs, batches, every=2):
    for i in batches:
        part = runs.where(F.floor(F.col("iteration") / 180) == i)
        policy.replay_batch(part, i, f"{base}/out", f"{base}/state", 0.2, rows=60, snapshot_every=every)


@pytest.mark.parametrize("every", [2, 100])
def test_repeated_batches_and_snapshots_equal_the_batch_result(spark, base, every):
    runs = hot_runs(spark).persist()
    # Batch 2 ends, and is run again after a restart; then 3 and 4 follow.
    play(spark, base, runs, [0, 1, 2, 2, 3, 4], every)
    whole = runlog.replay_policy(runs, 0.2)
    want = {(r["experiment"], r["iteration"]): tuple(r)[2:] for r in whole.select(KEPT).collect()}
    assert actions(spark, base) == want
    state = policy.state_before(spark, f"{base}/state", 5)
    end = runlog.final_state(whole)
    assert state.exceptAll(end.select(state.columns)).count() == 0 and state.count() == end.count()


def test_late_runs_are_kept_and_change_nothing(spark, base):
    runs = hot_runs(spark).persist()
    held_back = F.col("iteration").isin(0, 3)
    play(spark, base, runs.where(~held_back), [0, 1])
    late = runs.where(held_back)
    policy.replay_batch(late, 2, f"{base}/out", f"{base}/state", 0.2, snapshot_every=2)
    got = actions(spark, base)
    assert [got[0, i] for i in (0, 3)] == [("late", None, None)] * 2
    want = runlog.replay_policy(runs.where(~held_back & (F.col("iteration") < 360)), 0.2)
    assert all(got[r[0], r[1]] == tuple(r)[2:] for r in want.select(KEPT).collect())
    before, after = (policy.state_before(spark, f"{base}/state", i).collect() for i in (2, 3))
    assert sorted(before) == sorted(after)


def test_a_batch_writes_the_state_of_its_own_experiments_only(spark, base):
    runs = hot_runs(spark)
    play(spark, base, runs, [0], every=100)
    one = runs.where((F.col("experiment") == 0) & (F.col("iteration") >= 180))
    policy.replay_batch(one, 1, f"{base}/out", f"{base}/state", 0.2, snapshot_every=100)
    assert spark.read.parquet(f"{base}/state/changes/batch=1").count() == 1
    assert policy.state_before(spark, f"{base}/state", 2).count() == 41


def test_replay_runs_no_python_on_executors(spark):
    plan = runlog.replay_policy(hot_runs(spark), 0.2, rows=50)._jdf.queryExecution().toString()
    assert "InArrow" not in plan and "InPandas" not in plan and "Python" not in plan


@pytest.mark.parametrize("patience", [1, 4])
def test_long_segments_and_ties_in_one_experiment(spark, patience):
    runs = spark.range(1500).select(
        F.lit("x").alias("experiment"), F.col("id").alias("iteration"),
        F.when(F.col("id") * 7919 % 13 < 4, None).otherwise(F.col("id") * 31 % 17 / 17.0).alias("score"),
    ).withColumn("error", F.lit(None).cast("string"))
    from test_ordered import replay

    got = runlog.replay_policy(runs, 0.0, 0.05, patience, rows=600).orderBy("iteration").collect()
    want = replay([r["score"] for r in got], 0.0, 0.05, patience)
    assert [(r["action"], r["crashes"], r["outside"]) for r in got] == want


@pytest.mark.parametrize("parts", [1, 7, 60])
def test_sketches_merge_in_groups_within_their_rank_error(spark, parts):
    df = spark.range(0, 400_000, 1, parts).select(
        ((F.col("id") * 7919) % 400_009).cast("double").alias("a"), F.lit(None).cast("double").alias("none"))
    probs = [0.0, 0.1, 0.5, 0.999, 1.0]
    n, (got, none) = ordered.sketched_quantiles(df, [(F.col("a"), probs), (F.col("none"), [0.5])])
    assert n == 400_000 and none is None
    # a takes nearly every number below 400,009 once, so a value is nearly its rank.
    assert all(abs(v - p * 400_009) <= 2 * ordered.RANK_ERROR * 400_009 for p, v in zip(probs, got, strict=True))


def test_sketches_of_an_empty_table(spark):
    assert ordered.sketched_quantiles(spark.range(0), [(F.col("id"), [0.5])]) == (0, [None])


def test_the_log_is_numbered_once(spark, folder, monkeypatch):
    from foldwise.plans import streams

    read = spark.sparkContext.accumulator(0)
    few = hot_runs(spark).where("experiment < 3 AND iteration < 70")

    def seen(i):
        read.add(1)
        return i

    def counted_runs(spark, sf):
        kept = few.withColumn("event_id", F.col("iteration"))
        kept = kept.withColumn("iteration", F.udf(seen, "bigint")(F.col("iteration") + 1))
        return kept.withColumn(ordered.CHUNK, F.lit(0))

    monkeypatch.setattr(streams, "runs", counted_runs)
    assert streams.run_policy_stream(spark, folder).count() == few.count()
    assert read.value == few.count()
