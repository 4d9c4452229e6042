"""The isotonic fit equals the least squares by its min-max formula, whatever the segments."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import isotonic


def brute(rows):
    """Fit at every distinct score: the highest over starts of the least mean over ends."""
    xs = sorted({x for x, _ in rows})
    s = np.array([sum(y for x, y in rows if x == v) for v in xs], float)
    w = np.array([sum(1 for x, _ in rows if x == v) for v in xs], float)
    S, W = np.concatenate([[0], s.cumsum()]), np.concatenate([[0], w.cumsum()])
    mean = lambda a, b: (S[b + 1] - S[a]) / (W[b + 1] - W[a])
    n = len(xs)
    return {xs[i]: max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)}


@pytest.mark.parametrize("pooled,chunk", [(1 << 18, 1 << 20), (9, 40)])
@pytest.mark.parametrize("shape", ["noise", "falling"])
def test_equals_brute_force(spark, pooled, chunk, shape):
    rng = random.Random(5)
    rows = [(rng.randrange(150) / 8, 0.0) for _ in range(400)]
    if shape == "noise":
        rows = [(x, float(rng.random() < x / 20)) for x, _ in rows]
    else:
        rows = [(x, -x if x < 10 else x) for x, _ in rows]
    want = brute(rows)
    noted = rows + [(None, 1.0), (3.0, None), (float("nan"), 1.0)]
    df = spark.createDataFrame(noted, "score double, label double").repartition(5)
    blocks = isotonic.fit(df, "score", "label", pooled=pooled, rows=chunk)
    got = isotonic.apply(df, blocks, "score", rows=chunk).collect()
    assert len(got) == len(noted)
    for r in got:
        if r["score"] is None or r["score"] != r["score"]:
            assert r["calibrated"] is None
        else:
            assert r["calibrated"] == pytest.approx(want[r["score"]], abs=1e-9)


def test_between_and_beyond_blocks(spark):
    blocks = spark.createDataFrame([(1.0, 2.0, 0.2), (4.0, 4.0, 0.6)], "low double, high double, value double")
    asked = spark.createDataFrame([(0.0,), (1.5,), (3.0,), (4.0,), (9.0,)], "s double")
    got = {r["s"]: r["calibrated"] for r in isotonic.apply(asked, blocks, "s").collect()}
    assert got == pytest.approx({0.0: 0.2, 1.5: 0.2, 3.0: 0.4, 4.0: 0.6, 9.0: 0.6})


def test_no_rows(spark):
    none = spark.range(0).select(F.col("id").cast("double").alias("score"), F.col("id").alias("label"))
    blocks = isotonic.fit(none, "score", "label")
    assert blocks.count() == 0
    asked = spark.range(2).select(F.col("id").cast("double").alias("score"))
    assert [r["calibrated"] for r in isotonic.apply(asked, blocks, "score").collect()] == [None, None]
