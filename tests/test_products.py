"""Gram sums by fold, leading singular values, and topics with a bounded vocabulary."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.operators import products, unsupervised

VECTORS = T.StructType([T.StructField("features", VectorUDT())])


def test_all_folds_and_penalties_of_one_scan_equal_single_fits(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(5, 2, (300, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(0, 1, 300) + 7
    fold = np.arange(300) % 4
    rows = [(*map(float, a), float(b), int(f)) for a, b, f in zip(x, y, fold, strict=True)]
    rows += [(None, 1.0, 1.0, 1.0, 0), (1.0, 1.0, 1.0, None, 1)]
    df = spark.createDataFrame(rows, "a double, b double, c double, label double, fold int").repartition(5)
    alphas = [0.0, 0.1, 1.0, 3.0, 10.0, 30.0, 100.0, 300.0, 1e3, 1e4]
    got = {(r["fold"], r["alpha"]): r for r in products.ridge_path(df, ["a", "b", "c"], "label", alphas).collect()}
    assert len(got) == 40
    for (f, alpha), r in got.items():
        tx, ty, hx, hy = x[fold != f], y[fold != f], x[fold == f], y[fold == f]
        mx, my = tx.mean(0), ty.mean()
        w = np.linalg.solve((tx - mx).T @ (tx - mx) + alpha * np.eye(3), (tx - mx).T @ (ty - my))
        assert r["weights"] == pytest.approx(w.tolist(), rel=1e-8)
        assert r["mse"] == pytest.approx(np.mean((hy - my - (hx - mx) @ w) ** 2), rel=1e-8)


def test_one_fold_has_no_training_rows(spark):
    df = spark.range(5).select(F.col("id").cast("double").alias("a"), F.col("id").alias("label"), F.lit(0).alias("fold"))
    assert products.ridge_path(df, ["a"], "label", [1.0]).count() == 0
    assert products.ridge_path(df.limit(0), ["a"], "label", [1.0]).count() == 0


def test_singular_values_of_twenty_thousand_sparse_columns(spark):
    rng = np.random.default_rng(2)
    width, n, rank = 20_000, 120, 12
    full = np.zeros((n, width))
    rows = []
    for i in range(n):
        at = np.sort(rng.choice(width, 40, replace=False))
        scale = 3.0 ** -(i // 10)
        full[i, at] = rng.normal(0, scale, 40)
        rows.append((Vectors.sparse(width, at.tolist(), full[i, at].tolist()) if i % 3 else Vectors.dense(full[i]),))
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    values, right = products.leading_singular(df, "features", rank, width, extra=20)
    want = np.linalg.svd(full, compute_uv=False)[:rank]
    assert values == pytest.approx(want, rel=1e-6)
    assert np.abs(right.T @ right - np.eye(rank)).max() < 1e-8
    assert np.linalg.norm(full @ right, axis=0) == pytest.approx(want, rel=1e-6)
    assert unsupervised.singular_values(df, 3) == pytest.approx(want[:3].tolist(), rel=1e-6)


def test_singular_values_of_no_rows(spark):
    values, right = products.leading_singular(spark.createDataFrame([], VECTORS), "features", 2, 5)
    assert len(values) == 0 and right.shape == (5, 0)


def test_terms_beyond_the_bound_share_weights(spark):
    docs = spark.createDataFrame([(f"rare{i} common{i % 5} common{i % 5}",) for i in range(200)], "text string")
    model, out = unsupervised.topics(docs, "text", 2, None, 1, ["und"], own=5, shared=16)
    assert {f"common{i}" for i in range(5)} == set(model.stages[2].vocabulary)
    sizes = out.select(F.col("features")).collect()
    assert all(r["features"].size == 21 and sum(r["features"].values) == 3 for r in sizes)
    assert model.stages[-1].vocabSize() == 21
    terms = {r["term"] for r in unsupervised.describe_topics(model, 21).collect()}
    assert "common0" in terms and any(t.startswith("#") for t in terms)
