"""Boosted trees: splits and growth against brute force, what each setting changes, classes and early stopping."""

import heapq
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from foldwise.operators import boosting
from foldwise.operators.boosting import Boosted, Settings


def frame(spark, x, y, parts=3):
    names = [f"x{i}" for i in range(x.shape[1])]
    rows = [(*map(float, r), float(t)) for r, t in zip(x, y)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in [*names, "label"]))
    return VectorAssembler(inputCols=names, outputCol="features").transform(df).select("label", "features").repartition(parts)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = np.stack([rng.normal(size=300).round(1), rng.integers(0, 4, 300), rng.integers(0, 2, 300)], 1).astype(float)
    y = (x[:, 0] + (x[:, 1] == 2) * 2 - x[:, 2] + rng.normal(size=300) / 2 > 0.5).astype(float)
    return x, y


def brute(x, g, h, s):
    """The first tree by trying every value of every feature, leaf by leaf: rows of its leaves, and the gains in order."""
    score = lambda rows: g[rows].sum() ** 2 / (h[rows].sum() + s.penalty)

    def best(rows):
        found = (-math.inf,)
        for f in range(x.shape[1]):
            for v in np.unique(x[rows, f])[:-1]:
                left, right = rows[x[rows, f] <= v], rows[x[rows, f] > v]
                fits = min(len(left), len(right)) >= s.min_rows and min(h[left].sum(), h[right].sum()) >= s.min_weight
                gain = score(left) + score(right) - score(rows)
                if fits and gain > found[0] + 1e-12:
                    found = (gain, left, right)
        return found

    heap, leaves, gains = [], [np.arange(len(x))], []

    def offer(rows, depth):
        b = best(rows)
        if b[0] > s.min_gain and (s.depth is None or depth < s.depth):
            heapq.heappush(heap, (-b[0], len(gains), min(rows), rows, b, depth))

    offer(leaves[0], 0)
    while heap and (s.leaves is None or len(leaves) < s.leaves):
        gain, _, _, rows, (_, left, right), depth = heapq.heappop(heap)
        gains.append(-gain)
        leaves = [r for r in leaves if r is not rows] + [left, right]
        offer(left, depth + 1), offer(right, depth + 1)
    return leaves, gains


@pytest.mark.parametrize("settings", [
    Settings(rounds=1, depth=3, bins=256, penalty=1.0, min_rows=5),
    Settings(rounds=1, depth=None, leaves=7, bins=256, penalty=0.5),
    Settings(rounds=1, depth=4, leaves=6, bins=256, penalty=0.0, min_weight=3.0),
])
def test_first_tree_equals_brute_force(spark, data, settings):
    x, y = data
    model = Boosted(settings, 2).fit(frame(spark, x, y))
    base = float(model.base[0])
    assert base == pytest.approx(math.log(y.mean() / (1 - y.mean())), abs=1e-4)
    p = 1 / (1 + math.exp(-base))
    g, h = p - y, np.full(len(y), p * (1 - p))
    leaves, gains = brute(x, g, h, settings)
    want = np.empty(len(y))
    for rows in leaves:
        want[rows] = -settings.rate * g[rows].sum() / (h[rows].sum() + settings.penalty)
    assert model.raw(x)[:, 0] - base == pytest.approx(want, abs=1e-5)
    tree = model.rounds[0][0]
    assert sorted(tree.gain[tree.feature >= 0]) == pytest.approx(sorted(gains), abs=1e-4)


def test_regression_equals_brute_force(spark, data):
    x, y = data
    y = y * 100 + x[:, 0] * 7
    s = Settings(rounds=2, depth=2, bins=256, penalty=3.0, rate=0.5)
    model = Boosted(s).fit(frame(spark, x, y))
    now = np.full(len(y), y.mean())
    for _ in range(2):
        g = now - y
        for rows in brute(x, g, np.ones(len(y)), s)[0]:
            now[rows] -= s.rate * g[rows].sum() / (len(rows) + s.penalty)
    assert model.raw(x)[:, 0] == pytest.approx(now, abs=1e-3)
    out = model.transform(frame(spark, x, y)).select("prediction").toPandas().prediction
    assert sorted(out) == pytest.approx(sorted(now), abs=1e-3)


def test_settings_change_the_fit_and_partitions_do_not(spark, data, monkeypatch):
    x, y = data
    fit = lambda parts=3, **s: Boosted(Settings(**{"rounds": 3, "depth": 4, "bins": 256} | s), 2).fit(frame(spark, x, y, parts)).raw(x)
    plain = fit()
    assert (fit(7) == plain).all() and (fit(1) == plain).all()
    changes = {
        "leaves": fit(leaves=3), "penalty": fit(penalty=20.0), "min_rows": fit(min_rows=60), "min_weight": fit(min_weight=20.0),
        "min_gain": fit(min_gain=5.0), "row_share": fit(row_share=0.5), "column_share": fit(column_share=0.4), "bins": fit(bins=4),
    }
    assert all(np.abs(raw - plain).max() > 1e-3 for raw in changes.values())
    assert np.abs(changes["penalty"]).max() < np.abs(plain).max()
    monkeypatch.setattr(boosting, "REMEMBERED", 1)
    monkeypatch.setattr(boosting, "CELLS", 3 * 256)
    assert (fit() == plain).all()


def test_several_classes_are_probabilities_and_beat_a_forest(spark):
    from pyspark.ml.classification import RandomForestClassifier

    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 4))
    y = np.digitize(x[:, 0] + x[:, 1] * x[:, 2], [-0.7, 0.2, 1.0])
    df = frame(spark, x, y)
    out = Boosted(Settings(rounds=15, depth=3, rate=0.3), 4).fit(df).transform(df)
    forest = RandomForestClassifier(numTrees=20, maxDepth=5, seed=1).fit(df).transform(df)

    def loss(scored):
        rows = scored.select("label", "probability", "prediction").collect()
        assert all(abs(sum(r.probability) - 1) < 1e-9 and r.probability[int(r.prediction)] == max(r.probability) for r in rows)
        return -np.mean([math.log(max(r.probability[int(r.label)], 1e-15)) for r in rows])

    assert loss(out) < loss(forest)


def test_growth_stops_early_and_edge_tables(spark, data):
    x, y = data
    noisy = np.where(np.arange(300) % 3 == 0, 1 - y, y)
    df = frame(spark, x, noisy).withColumn("held", F.xxhash64("features") % 3 == 0)
    model = Boosted(Settings(rounds=40, depth=5, rate=0.5, penalty=0.0), 2, held="held", patience=3).fit(df)
    assert 0 < model.getNumTrees < 40 and model.losses.index(min(model.losses)) == model.getNumTrees - 1
    assert len(model.losses) == model.getNumTrees + 3
    constant = frame(spark, np.zeros((20, 2)), np.arange(20) % 2)
    assert Boosted(Settings(rounds=3), 2).fit(constant).getNumTrees == 0
    assert Boosted(Settings(rounds=3)).fit(constant.limit(0)).raw(np.ones((2, 2))).tolist() == [[0.0], [0.0]]
    with pytest.raises(ValueError):
        Settings(bins=1)
    shares = Boosted(Settings(rounds=2, depth=2), 2).fit(frame(spark, x, y)).featureImportances.toArray()
    assert shares.sum() == pytest.approx(1) and (shares >= 0).all()


def test_rows_are_passed_in_blocks_to_a_task_a_core(spark):
    rows = [(Vectors.dense([float(i % 7), float(i)]), float(i % 2)) for i in range(300)]
    df = spark.createDataFrame(rows, ["features", "label"]).repartition(40)
    found = boosting.binned(df, [np.array([2.0, 4.0]), np.array([100.0])], "label", None)
    held = [boosting.Block(r.asDict(), 2) for r in found.collect()]
    assert len(held) <= 40 and sum(len(x.y) for x in held) == 300
    assert sorted(map(tuple, np.vstack([x.bins for x in held]).tolist())) == sorted(
        ((i % 7 > 2) + (i % 7 > 4), int(i > 100)) for i in range(300)
    )
    cores = spark.sparkContext.defaultParallelism
    assert boosting.shared_out(found, 600).rdd.getNumPartitions() == min(cores, 40)
    assert boosting.shared_out(found, 60 * boosting.SHARE).rdd.getNumPartitions() == 40


def test_siblings_and_features_are_added_alike(spark, data, monkeypatch):
    """Sums of a smaller sibling and its parent, of all nodes by feature, and in a tree of tasks make the same model."""
    x, y = data
    fit = lambda: Boosted(Settings(rounds=3, depth=4, bins=256), 2).fit(frame(spark, x, y)).raw(x)
    asked, sums = [], boosting.sums
    monkeypatch.setattr(boosting, "sums", lambda *a: asked.append(len(a[3])) or sums(*a))
    plain = fit()
    assert max(asked) <= 4  # of eight nodes of a level the smaller halves
    monkeypatch.setattr(boosting, "LEAST", 1)
    monkeypatch.setattr(boosting, "COLLECTED", 0)
    assert (fit() == plain).all()
    monkeypatch.setattr(boosting, "AT_ONCE", 0)
    assert (fit() == plain).all()
