"""Exact top-k by integer inner product: KD-trees per shard, searched best-first."""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from foldwise.llm.common import materialise, table

#: Vectors of a shard, on average; a shard is one KD-tree and fits a task many times over.
SHARD_ROWS = 8192
LEAF_ROWS = 256
#: Queries that are sent to all tasks at once: the proven bound of what is broadcast.
QUERY_BLOCK = 4096
#: Components beyond this many are refused, so that a block of queries stays small.
MAX_DIMENSIONS = 4096
K = 20


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and v (floor(64 x) of every component) of the rows that take part.

    NULL ids, NULL vectors and vectors with a NULL or non-finite component take no part.
    """
    v = F.col(vector).cast("array<double>")
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(vec_id).isNotNull() & v.isNotNull() & fine).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(v, lambda x: F.floor(x * 64).cast("double")).alias("v"),
    )


def matrix(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def build(ids: np.ndarray, points: np.ndarray, leaf_rows: int) -> dict[str, np.ndarray]:
    """A KD-tree as arrays: points in tree order and, per node, its range, children and box.

    A node is split at the median of the dimension in which its points spread most; its box is
    the tight bound of its own points.
    """
    order = np.arange(len(ids))
    start, stop, left, low, high = [], [], [], [], []

    def node(a: int, b: int) -> int:
        rows = points[order[a:b]]
        start.append(a), stop.append(b), left.append(-1)
        low.append(rows.min(0)), high.append(rows.max(0))
        return len(start) - 1

    todo = [node(0, len(ids))]
    while todo:
        n = todo.pop()
        a, b = start[n], stop[n]
        spread = high[n] - low[n]
        if b - a <= leaf_rows or not spread.size or spread.max() == 0:
            continue
        middle = (b - a) // 2
        axis = points[order[a:b], spread.argmax()]
        order[a:b] = order[a:b][np.argpartition(axis, middle)]
        left[n] = node(a, a + middle)
        node(a + middle, b)
        todo += [left[n], left[n] + 1]
    return {
        "ids": ids[order], "points": points[order], "start": np.array(start), "stop": np.array(stop),
        "left": np.array(left), "low": np.array(low), "high": np.array(high),
    }


def packed(tree: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **tree)
    return out.getvalue()


class Best:
    """The k best (score, vec_id) of one query so far; among equal scores smaller ids win."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0), np.empty(0, np.int64)
        self.kth = -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        near = scores >= self.kth
        if not near.any():
            return
        s, i = np.concatenate([self.scores, scores[near]]), np.concatenate([self.ids, ids[near]])
        first = np.lexsort((i, -s))[: self.k]
        self.scores, self.ids = s[first], i[first]
        if len(first) == self.k:
            self.kth = self.scores[-1]


def search(tree: dict[str, np.ndarray], query: np.ndarray, own: int, best: Best) -> None:
    """Best-first traversal: boxes by their upper bound of the inner product, until the bound is
    below the kth score that earlier boxes, and earlier shards, have set. A box that only ties
    is still opened, because a tie may hold a smaller id."""
    above, below = np.maximum(query, 0), np.minimum(query, 0)
    bounds = tree["high"] @ above + tree["low"] @ below
    heap = [(-bounds[0], 0)]
    left, start, stop = tree["left"], tree["start"], tree["stop"]
    while heap:
        bound, n = heapq.heappop(heap)
        if -bound < best.kth:
            return
        if left[n] >= 0:
            for child in (left[n], left[n] + 1):
                if bounds[child] >= best.kth:
                    heapq.heappush(heap, (-bounds[child], child))
            continue
        rows = slice(start[n], stop[n])
        scores, ids = tree["points"][rows] @ query, tree["ids"][rows]
        other = ids != own
        best.add(scores[other], ids[other])


def index(vectors: DataFrame, shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """One row (shard, tree) per KD-tree over ``vectors`` (vec_id, v), written once.

    Shards are dealt by hash of the id and hold ``shard_rows`` rows on average, however many
    rows there are; rows of one id meet in a shard, where only the smallest vector counts.
    """
    shards = max(1, -(-vectors.count() // shard_rows))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        group = group.assign(key=[tuple(v) for v in group["v"]]).sort_values(["vec_id", "key"])
        group = group.drop_duplicates("vec_id")
        points = matrix(group["v"].tolist(), max(map(len, group["v"])))
        tree = build(group["vec_id"].to_numpy(), points, leaf_rows)
        return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "tree": [packed(tree)]})

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return materialise(dealt.dropDuplicates().groupBy("shard").applyInPandas(grow, "shard int, tree binary"))


def blocks(queries: DataFrame, size: int) -> Iterator[list]:
    """Query rows by ascending id, ``size`` at a time, each block read by a range of ids."""
    after = None
    while True:
        rest = queries if after is None else queries.where(F.col("vec_id") > after)
        rows = rest.orderBy("vec_id").limit(size).collect()
        if not rows:
            return
        yield rows
        after = rows[-1].vec_id


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS,
    leaf_rows: int = LEAF_ROWS, block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` highest inner products per query.

    ``vectors`` and ``queries`` hold vec_id and v. A query's own id is no candidate; ties go to
    the smaller vec_id; fewer candidates give fewer rows. Vectors of unlike lengths meet on
    their common components. Of an id's repeated rows the smallest vector counts. Sums are exact
    below 2**53. An empty side gives no rows.

    Trees are built once and written; every block of at most ``block`` queries is sent to all
    tasks, which carry each query's kth score from shard to shard, and only k rows per query and
    task are merged.
    """
    trees = index(vectors, shard_rows, leaf_rows)
    asked = materialise(queries.groupBy("vec_id").agg(F.min("v").alias("v")))
    parts = []
    for rows in blocks(asked, block):
        if max(len(r.v) for r in rows) > MAX_DIMENSIONS:
            raise ValueError(f"a query has over {MAX_DIMENSIONS} components")
        own = np.array([r.vec_id for r in rows], np.int64)
        asks = matrix([np.array(r.v) for r in rows], max(len(r.v) for r in rows))
        sent = vectors.sparkSession.sparkContext.broadcast((own, asks))

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            own, asks = sent.value
            found = [Best(k) for _ in own]
            for batch in batches:
                for blob in batch["tree"]:
                    tree = dict(np.load(io.BytesIO(blob)))
                    width = tree["points"].shape[1]
                    fit = matrix([a[:width] for a in asks], width)
                    for i in range(len(own)):
                        search(tree, fit[i], own[i], found[i])
            for i in range(len(own)):
                yield pd.DataFrame({
                    "query_id": np.full(len(found[i].ids), own[i]), "vec_id": found[i].ids,
                    "score": found[i].scores.astype(np.int64),
                })

        parts.append(materialise(trees.mapInPandas(run, "query_id long, vec_id long, score long")))
    if not parts:
        return vectors.selectExpr("vec_id AS query_id", "0 AS rank", "vec_id", "0L AS score").limit(0)
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all embeddings for every embedding whose id is divisible by 20."""
    vectors = usable(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 20 = 0"))


ORACLE = {
    "op9_topk": f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= {K}""",
}
QUERIES = {"op9_topk": op9_topk}
