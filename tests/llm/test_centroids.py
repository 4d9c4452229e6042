"""Centroid clustering against plain Lloyd rounds over all centroids, and against SQL."""

import hashlib

import numpy as np
import pytest
from oracle import canonical, connect

from foldwise.llm import centroids


def nearest(v, m):
    d = [sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in m]
    return min(range(len(m)), key=lambda c: (d[c], c)), min(d)


@pytest.mark.parametrize("k,dims,spread", [(1, 3, 5), (5, 2, 3), (8, 64, 400), (40, 6, 1 << 27), (9, 1, 4)])
def test_walk_finds_the_nearest_with_ties_to_the_smaller_number(k, dims, spread):
    rng = np.random.default_rng(k)
    m = rng.integers(-spread + 1, spread, (k, dims))
    m[k // 2] = m[0]
    vectors = np.concatenate([rng.integers(-spread + 1, spread, (300, dims)), m])
    number, distance = centroids.Lists(m).nearest(vectors)
    assert list(zip(number.tolist(), distance.tolist())) == [nearest(v, m) for v in vectors]


def test_walk_stops_before_it_has_met_all(monkeypatch):
    m = np.array([[i * 1000, i * 1000] for i in range(50)])
    found = []
    whole = np.einsum
    monkeypatch.setattr(centroids.np, "einsum", lambda s, a, b: found.append(len(a)) or whole(s, a, b))
    number, _ = centroids.Lists(m).nearest(m[[3, 40]] + 1)
    assert number.tolist() == [3, 40] and len(found) < 10


def test_clusters_equal_plain_rounds(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(i % 3, 1, 4)).tolist(), 7) for i in range(200)]
    rows += [(None, [0.5] * 4, None), (3, rows[3][1], 1), (500, None, 1), (501, [1.0, None, 1.0, 1.0], 1), (502, [1.0] * 5, 1),
             (503, [float("nan")] * 4, 1), (504, [float("-inf"), 0.0, 0.0, 0.0], 1), (505, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, __cluster int")
    kept = [(i, np.floor(np.array(v) * 16).astype(int).tolist()) for i, v, _ in rows if v and len(v) == 4 and None not in v and np.isfinite(v).all()]
    order = sorted((hashlib.sha256(f"9:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    m = [v for _, v in order[:6]]
    for _ in range(4):
        of = [nearest(v, m)[0] for _, v in kept]
        for c in range(6):
            mine = [v for (_, v), x in zip(kept, of) if x == c]
            if mine:
                m[c] = [sum(x) // len(mine) for x in zip(*mine)]
    want = [(i, *nearest(v, m)) for i, v in kept]
    inertia = {c: sum(d for _, x, d in want if x == c) for c in range(6)}
    want = sorted(((i, c, d, inertia[c], sum(inertia.values()), ",".join(map(str, m[c]))) for i, c, d in want), key=str)
    got = centroids.cluster(df.repartition(3), "vec_id", "embedding", 6, 4, 9, 4, 16)
    assert sorted(map(tuple, got.collect()), key=str) == want and len(want) == 202


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    got = centroids.cluster(df, "vec_id", "embedding", 8, 2, 3, 2, 4).collect()
    assert len(got) == 2 and len({r["__cluster"] for r in got}) == 1 and got[0]["__inertia"] == 0
    assert centroids.cluster(df, "vec_id", "embedding", 8, 2, 3, 5, 4).count() == 0
    with pytest.raises(Exception, match="exact distances"):
        centroids.whole(__import__("pyarrow").array([[1e300, 0.0]]), 2, 4)


def test_query_matches_sql(spark, folder):
    got = centroids.op12_centroid_clusters(spark, folder).toPandas()
    want = connect(folder).execute(centroids.ORACLE["op12_centroid_clusters"]).fetch_df()
    assert canonical(got) == canonical(want) and len(got) > 100
    assert {c: str(t) for c, t in got.dtypes.items()} == {c: str(t) for c, t in want.dtypes.items()}
