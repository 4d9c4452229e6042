"""Centroid clustering in whole numbers; the nearest centroid is found by the threshold algorithm."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from foldwise.llm.common import table

#: Of the registered query: components, steps of one, clusters, rounds and the seed of the first centroids.
DIMENSIONS, STEPS, CLUSTERS, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Whole components stay below this, so that a squared distance of 64 of them fits a bigint.
LARGEST = 1 << 27
#: Vectors whose lists are walked at once.
BLOCK = 2048
FAR = np.iinfo(np.int64).max


def whole(column: pa.Array, dimensions: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a list column are usable, and floor(steps * x) of the components of those."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    fitting = np.flatnonzero(lengths == dimensions)
    flat = column.take(pa.array(fitting)).flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    finite = np.isfinite(values).all(1)  # a null is NaN here
    scaled = np.floor(values[finite] * steps)
    if len(scaled) and np.abs(scaled).max() >= LARGEST:
        raise ValueError(f"a component of {LARGEST} steps or more leaves no room for exact distances")
    return fitting[finite], scaled.astype(np.int64)


class Lists:
    """Centroids (k x d) with a list a dimension, sorted by value."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.sorted = np.take_along_axis(centroids, self.order, 0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each vector's nearest centroid, ties to the smaller number.

        The lists of all dimensions are walked outward from the vector's own values in step, the
        nearer side first. A centroid met for the first time gets its exact distance. One not met
        yet is in every dimension at least as far as the walk has come, so the walk ends when the
        squares of those distances sum to strictly more than the best, or when all have been met.
        """
        parts = [self.walk(vectors[at : at + BLOCK]) for at in range(0, len(vectors), BLOCK)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def walk(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k, dims = self.centroids.shape
        best, distance = np.zeros(len(vectors), np.int64), np.full(len(vectors), FAR)
        active, met = np.arange(len(vectors)), np.zeros((len(vectors), k), bool)
        # The places in the lists below and above the walked stretch.
        above = np.zeros((len(vectors), dims), np.int64)
        for row in self.sorted:
            above += row < vectors
        below = above - 1
        dimension = np.arange(dims)
        for _ in range(k):
            low, high, v = below[active], above[active], vectors[active]
            down = np.where(low >= 0, v - self.sorted[np.maximum(low, 0), dimension], FAR)
            up = np.where(high < k, self.sorted[np.minimum(high, k - 1), dimension] - v, FAR)
            lower = down <= up
            frontier = np.where(lower, down, up)
            reached = self.order[np.where(lower, low, high), dimension]
            below[active], above[active] = low - lower, high + ~lower
            new = np.zeros((len(active), k), bool)
            new[np.arange(len(active))[:, None], reached] = True
            new &= ~met[active]
            met[active] |= new
            for c in np.flatnonzero(new.any(0)).tolist():
                at = active[new[:, c]]
                gap = vectors[at] - self.centroids[c]
                d = np.einsum("ij,ij->i", gap, gap)
                closer = (d < distance[at]) | ((d == distance[at]) & (c < best[at]))
                best[at[closer]], distance[at[closer]] = c, d[closer]
            beyond = np.einsum("ij,ij->i", frontier, frontier) > distance[active]
            active = active[~(beyond | met[active].all(1))]
            if not len(active):
                break
        return best, distance


def partial_sums(df: DataFrame, vector: str, lists: Lists, dimensions: int, steps: int) -> list:
    """Per cluster its number of vectors, the sum of their distances and of each component, exactly.

    A task keeps k rows of sums, and Spark adds the tasks' rows in decimals that can't overflow.
    """
    k = len(lists.centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, reach, sums = [0] * k, [0] * k, np.zeros((k, dimensions), object)
        for batch in batches:
            _, vectors = whole(batch.column(0), dimensions, steps)
            number, distance = lists.nearest(vectors)
            for c in np.unique(number).tolist():
                mine = vectors[number == c]
                counts[c] += len(mine)
                reach[c] += sum(distance[number == c].tolist())
                sums[c] += mine.sum(0).astype(object)
        kept = [c for c in range(k) if counts[c]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept, pa.int32()), pa.array([str(counts[c]) for c in kept], pa.string()),
             pa.array([str(reach[c]) for c in kept], pa.string()),
             pa.array([list(map(str, sums[c])) for c in kept], pa.list_(pa.string()))],
            ["cluster", "n", "reach", "sums"],
        )

    exact = lambda c: F.sum(c.cast("decimal(38,0)"))
    return (
        df.select(vector).mapInArrow(run, "cluster int, n string, reach string, sums array<string>")
        .groupBy("cluster").agg(
            exact(F.col("n")).alias("n"), exact(F.col("reach")).alias("reach"),
            F.array(*[exact(F.col("sums")[i]) for i in range(dimensions)]).alias("sums"),
        ).collect()  # k rows
    )


def first_centroids(df: DataFrame, key: str, vector: str, clusters: int, seed: int, dimensions: int, steps: int) -> np.ndarray:
    """The usable vectors of the ``clusters`` smallest sha256 of ``seed:key``, in that order.

    Rows without a key start no cluster; of rows with one key, that of the smaller vector comes first.
    """
    usable = (
        f"size(v) = {dimensions} AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) "
        "AND abs(x) < CAST('Infinity' AS DOUBLE))"
    )
    rows = (
        df.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256).alias("h"), F.col(vector).alias("v"))
        .where(F.col("h").isNotNull()).where(usable).orderBy("h", "v").limit(clusters).select("v").collect()
    )
    column = pa.array([r.v for r in rows], pa.list_(pa.float64()))
    return whole(column, dimensions, steps)[1]


def cluster(
    df: DataFrame, key: str, vector: str, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
    dimensions: int = DIMENSIONS, steps: int = STEPS,
) -> DataFrame:
    """``key``, ``__cluster``, ``__distance``, its cluster's and the whole ``__inertia`` and ``__centroid`` of each usable vector.

    A vector is usable if it holds exactly ``dimensions`` components, none null or non-finite;
    component x counts as floor(``steps`` * x). Each round gives every vector to the nearest
    centroid by squared distance, ties to the smaller number, and moves every centroid that has
    vectors to their componentwise floor(sum / count). Rows without a key are clustered too, but
    start no cluster; repeated rows count as often; other rows are left out. With fewer usable
    vectors than ``clusters`` there are as many centroids; an empty table gives an empty one. A
    component of LARGEST steps or more is an error, as distances would not be exact.

    A round is one pass over ``df`` that sends k sums a task, so nothing else is shuffled, and the
    driver sees the centroids alone; a lost executor costs its tasks' part of one pass.
    """
    df = df.select(F.col(key).alias(key), F.col(vector).alias("__vector"))
    centroids = first_centroids(df, key, "__vector", clusters, seed, dimensions, steps)
    kind = df.schema[key].dataType
    schema = f"`{key}` {kind.simpleString()}, __cluster int, __distance bigint"
    if not len(centroids):
        return with_totals(df.sparkSession.createDataFrame([], schema), [], centroids)
    for _ in range(rounds):
        for r in partial_sums(df, "__vector", Lists(centroids), dimensions, steps):
            centroids[r.cluster] = [int(s) // int(r.n) for s in r.sums]
    lists = Lists(centroids)
    totals = partial_sums(df, "__vector", lists, dimensions, steps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vectors = whole(batch.column(1), dimensions, steps)
            number, distance = lists.nearest(vectors)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(number, pa.int32()), pa.array(distance, pa.int64())],
                [key, "__cluster", "__distance"],
            )

    return with_totals(df.mapInArrow(run, schema), totals, centroids)


def with_totals(found: DataFrame, totals: list, centroids: np.ndarray) -> DataFrame:
    """``found`` with its cluster's and the whole inertia, and the centroid as text; literals, as there are k of each."""
    inertia = sum(int(r.reach) for r in totals)
    reach = {r.cluster: int(r.reach) for r in totals}
    pick = lambda values, kind: F.get(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("__cluster"))
    return found.withColumns({
        "__cluster_inertia": pick([reach.get(c, 0) for c in range(len(centroids))], "bigint"),
        "__inertia": F.lit(inertia).cast("bigint"),
        "__centroid": pick([",".join(map(str, c)) for c in centroids.tolist()], "string"),
    })


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable embeddings in 8 clusters after 10 rounds."""
    found = cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id", "embedding")
    return found.selectExpr(
        "vec_id", "__cluster AS cluster", "__distance AS distance", "__cluster_inertia AS cluster_inertia",
        "__inertia AS inertia", "sha2(__centroid, 256) AS centroid_sha256",
    )


def oracle() -> str:
    """The same in SQL: one pair of tables a round."""
    size = f"range(1, {DIMENSIONS + 1})"
    floor = "(s - ((s % n) + n) % n) // n"
    parts = [f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({STEPS} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), v) - 1 AS INTEGER) AS c, v AS m FROM kept
  WHERE vec_id IS NOT NULL QUALIFY c < {CLUSTERS}
)"""]
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, v, min_by(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT k.row, k.vec_id, k.v, c.c,
      CAST(list_sum(list_transform({size}, lambda i: (k.v[i] - c.m[i]) * (k.v[i] - c.m[i]))) AS BIGINT) AS d
    FROM (SELECT *, row_number() OVER () AS row FROM kept) k, c{r} c
  ) GROUP BY row, vec_id, v
)""")
        if r < ROUNDS:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(m.m, c.m) AS m FROM c{r} c LEFT JOIN (
    SELECT c, list({floor} ORDER BY i) AS m FROM (
      SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
        SELECT c, unnest(v) AS x, unnest({size}) AS i FROM a{r}) GROUP BY c, i
    ) GROUP BY c
  ) m ON m.c = c.c
)""")
    last = f"a{ROUNDS}"
    return f"""WITH {', '.join(parts)}
SELECT a.vec_id, a.c AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.m, ',')) AS centroid_sha256
FROM {last} a JOIN c{ROUNDS} m ON m.c = a.c"""


QUERIES = {"op12_centroid_clusters": op12_centroid_clusters}
ORACLE = {"op12_centroid_clusters": oracle()}
