"""Mutual information of categories with a number, from distances to nearest neighbours."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwise.functions.numeric import to_number
from foldwise.operators.ordered import CHUNK, chunk_carry, lookup_join, with_chunks
from foldwise.session import materialise

NEIGHBOURS = 3
#: Counted values in a chunk, which one task holds in numpy.
POINTS = 1 << 18
#: The most different ends of intervals beyond their chunk that are sent to all tasks.
ENDS = 1 << 17
#: Steps that lift an argument before the asymptotic series of the digamma function applies.
LIFT = 8


def digamma(x: Column) -> Column:
    """The logarithmic derivative of the gamma function at 1 or above, to about 1e-12."""
    z = x + LIFT
    series = F.log(z) - 1 / (2 * z) - 1 / (12 * z * z) + 1 / (120 * F.pow(z, 4)) - 1 / (252 * F.pow(z, 6))
    return series - sum((1 / (x + i) for i in range(1, LIFT)), 1 / x)


SETTLED, EDGE, ASK = range(3)
FOUND = {
    "kind": pa.int32(), "column": pa.string(), "x": pa.string(), "y": pa.float64(), "n": pa.int64(), "size": pa.int64(),
    "d": pa.float64(), "low": pa.float64(), "high": pa.float64(), "m": pa.int64(), "open": pa.bool_(),
}


def _reach(y: np.ndarray, n: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distance to the k-th neighbour of the points ``at``, and the ends of the open interval it spans.

    ``y`` ascends inside a class, and ``at`` have k values of their class on both sides; ``n`` counts ties.
    """
    near = np.concatenate([at - j for j in range(1, k + 1)] + [at + j for j in range(1, k + 1)]).reshape(2 * k, -1).T
    away = np.abs(y[near] - y[at, None])
    order = np.argsort(away, axis=1, kind="stable")
    seen = (n[at] - 1)[:, None] + np.cumsum(np.take_along_axis(n[near], order, 1), axis=1)
    step = np.take_along_axis(order, np.argmax(seen >= k, axis=1)[:, None], 1)
    d, end = np.take_along_axis(away, step, 1)[:, 0], y[np.take_along_axis(near, step, 1)[:, 0]]
    tied, behind = n[at] > k, step[:, 0] >= k
    d = np.where(tied, 0.0, d)
    low = np.where(tied | behind, y[at] - d, end)
    return d, low, np.where(tied | ~behind, y[at] + d, end)


def _chunk_neighbours(k: int) -> Callable[[pa.Table], pa.Table]:
    """What a chunk of points settles by itself, and what it leaves.

    Points with k values of their class on both sides know their interval. Where it ends inside the chunk
    its rows are counted here, else it is an ``ASK``. The first and last 2k values of each class
    are ``EDGE`` rows, of which the outer k are open: their neighbours may be in other chunks.
    """
    def run(chunk: pa.Table) -> pa.Table:
        column, x = (chunk[c].combine_chunks().dictionary_encode() for c in ("column", "x"))
        of, value = np.asarray(column.indices), np.asarray(chunk["y"])
        group = of.astype(np.int64) * len(x.dictionary) + np.asarray(x.indices)
        order = np.lexsort((value, group))
        of, group, y = of[order], group[order], value[order]
        n, size = (np.asarray(chunk[c])[order] for c in ("n", "size"))
        bounds = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
        many = np.diff(bounds)
        rank = np.arange(len(y)) - np.repeat(bounds[:-1], many)
        left = np.repeat(many, many) - 1 - rank
        nearest = np.minimum(rank, left)
        at = np.flatnonzero(nearest >= k)
        d, low, high = _reach(y, n, at, k)
        inside = (low >= y.min()) & (high <= y.max())
        met = np.zeros(len(at), np.int64)
        for c in range(len(column.dictionary)):
            held = np.flatnonzero(of == c)
            held = held[np.argsort(y[held], kind="stable")]
            upto = np.concatenate([[0], np.cumsum(n[held])])
            mine = np.flatnonzero(of[at] == c)
            zero = d[mine] == 0

            def rows(v: np.ndarray, tied: np.ndarray, sorted_y=y[held], upto=upto) -> np.ndarray:
                return upto[np.where(tied, np.searchsorted(sorted_y, v, "right"), np.searchsorted(sorted_y, v, "left"))]

            met[mine] = rows(high[mine], zero) - rows(low[mine], ~zero)
        key = of[at[inside]] * (met.max(initial=0) + 1) + met[inside]
        keys, where = np.unique(key, return_inverse=True)
        weight = np.bincount(where, n[at[inside]], len(keys)).astype(np.int64)
        names, classes = column.dictionary, x.dictionary
        part = {"kind": SETTLED, "column": names.take(pa.array(keys // (met.max(initial=0) + 1))), "n": weight, "m": keys % (met.max(initial=0) + 1)}
        out = [_rows(part, len(keys))]
        for kind, i, more in (
            (EDGE, np.flatnonzero(nearest < 2 * k), {"open": (nearest < k)[nearest < 2 * k]}),
            (ASK, at[~inside], {"d": d[~inside], "low": low[~inside], "high": high[~inside]}),
        ):
            out.append(_rows({
                "kind": kind, "column": names.take(pa.array(of[i])), "x": classes.take(pa.array(group[i] % len(classes))),
                "y": y[i], "n": n[i], "size": size[i],
            } | more, len(i)))
        return pa.concat_tables(out)

    return run


def _rows(cells: dict, many: int) -> pa.Table:
    """A table of ``FOUND`` from some of its columns."""
    cells = cells | {"kind": np.full(many, cells["kind"])}
    return pa.table({c: pa.array(cells[c]).cast(t) if c in cells else pa.nulls(many, t) for c, t in FOUND.items()})


def _open_asks(edges: DataFrame, k: int) -> DataFrame:
    """The intervals of open points, from the edges of all chunks; a class has at most 4k of them a chunk."""
    value, ordered = F.struct("y", "n"), Window.partitionBy("column", "x").orderBy("y")
    steps = """array_sort(concat(array(struct(0D AS d, n - 1 AS n, CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high)),
      transform(before, p -> struct(y - p.y AS d, p.n AS n, p.y AS low, CAST(NULL AS DOUBLE) AS high)),
      transform(behind, p -> struct(p.y - y AS d, p.n AS n, CAST(NULL AS DOUBLE) AS low, p.y AS high))))"""
    reached = """aggregate(steps, struct(0L AS seen, CAST(NULL AS DOUBLE) AS d, CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high),
      (s, p) -> IF(s.seen >= k, s, struct(s.seen + p.n AS seen, p.d AS d, p.low AS low, p.high AS high)))"""
    near = edges.withColumns({
        "before": F.collect_list(value).over(ordered.rowsBetween(-k, -1)),
        "behind": F.collect_list(value).over(ordered.rowsBetween(1, k)),
    }).where("open").withColumn("k", F.least(F.lit(k), F.col("size") - 1)).withColumn("steps", F.expr(steps))
    return near.select("column", "x", "y", "n", F.expr(reached).alias("r")).select(
        "column", "x", "y", "n", F.col("r.d").alias("d"),
        F.coalesce("r.low", F.col("y") - F.col("r.d")).alias("low"), F.coalesce("r.high", F.col("y") + F.col("r.d")).alias("high"),
    )


def _held(points: DataFrame, asks: DataFrame, most: int) -> DataFrame:
    """``column``, ``y``, ``n``: the rows of every value; values that no end of an interval parts make one row.

    With more than ``most`` different ends every value keeps a row of its own.
    """
    ends = asks.select(F.explode(F.array("low", "high")).alias("v")).distinct().limit(most + 1).toPandas()["v"]
    if len(ends) > most:
        return points.groupBy("column", "y").agg(F.sum("n").alias("n"))
    cuts = np.sort(ends.to_numpy(float))

    @F.pandas_udf("long")
    def slot(y: pd.Series) -> pd.Series:  # odd: equal to an end, even: between two
        return pd.Series(np.searchsorted(cuts, y, "left") + np.searchsorted(cuts, y, "right"))

    return points.groupBy("column", slot("y").alias("slot")).agg(F.min("y").alias("y"), F.sum("n").alias("n")).drop("slot")


def mutual_information_nearest(
    df: DataFrame, cols: Sequence[str], target: str, k: int = NEIGHBOURS, rows: int = POINTS, ends: int = ENDS,
) -> DataFrame:
    """``column``, ``mi``: mutual information (nats) of categorical columns with a numeric target.

    For each row the distance to its k-th neighbour of the same category (or its last, in smaller
    ones) is found, and all rows nearer than that, the row itself included, are counted: at
    distance zero those of equal value. With N rows, N_x of the row's category and m counted,
    MI = psi(N) + mean(psi(k) - psi(N_x) - psi(m)), never below zero. Categories of one row are
    left out. A missing category is one of its own, and a target that is no number counts as 0.

    Rows are first counted by category and value, so ties cost one row. Chunks of about ``rows`` of these,
    cut by value, find neighbours and counts in numpy. What reaches over a chunk's border is finished
    afterwards: neighbours from the chunks' edges, counts by running sums over range partitions, in which
    a row asks twice. Up to ``ends`` different asked values the other rows are summed between them first.
    """
    y = F.coalesce(to_number(F.col(target)), F.lit(0.0)).cast("double")
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("Missing")).alias("x")) for c in cols
    ])
    counted = df.select((y + 0.0).alias("y"), F.explode(pairs).alias("p")).groupBy("p.column", "p.x", "y").agg(F.count(F.lit(1)).alias("n"))
    counted = materialise(counted)
    sizes = materialise(counted.groupBy("column", "x").agg(F.sum("n").alias("size")))
    points = lookup_join(with_chunks(counted, "y", rows), sizes, ["column", "x"], "size").where("size > 1")
    found = materialise(points.groupBy(CHUNK).applyInArrow(
        _chunk_neighbours(k), "kind int, column string, x string, y double, n long, size long, d double, low double, high double, m long, open boolean"
    ))
    asks = materialise(_open_asks(found.where(F.col("kind") == EDGE), k).unionByName(
        found.where(F.col("kind") == ASK).select("column", "x", "y", "n", "d", "low", "high")
    ))
    # Rows below the upper end less those up to the lower one; at distance zero both ends take in their ties.
    both = "inline(array(struct(low AS v, IF(d > 0, 2, 0) AS turn, -1 AS sign), struct(high AS v, IF(d > 0, 0, 2) AS turn, 1 AS sign)))"
    events = asks.selectExpr("column", "x", "y", "n AS weight", "0L AS n", both).unionByName(
        _held(points, asks, ends).selectExpr("column", "CAST(NULL AS STRING) AS x", "y", "0L AS weight", "n", "y AS v", "1 AS turn", "0 AS sign")
    )
    events = chunk_carry(
        with_chunks(materialise(events), "v", rows), ["column"], {"part": F.sum("n")},
        {"carried": ("part", F.sum)},
    )
    running = Window.partitionBy("column", CHUNK).orderBy("v", "turn").rowsBetween(Window.unboundedPreceding, 0)
    below = F.sum("n").over(running) + F.coalesce("carried", F.lit(0))
    met = events.withColumn("below", below).where("sign <> 0").groupBy("column", "x", "y").agg(
        F.sum(F.col("sign") * F.col("below")).alias("m"), F.first("weight").alias("n"),
    ).select("column", "m", "n").unionByName(found.where(F.col("kind") == SETTLED).select("column", "m", "n"))
    met = met.groupBy("column", "m").agg(F.sum("n").alias("n")).groupBy("column").agg(F.sum(F.col("n") * digamma(F.col("m"))).alias("near"))
    own = digamma(F.least(F.lit(k), F.col("size") - 1)) - digamma(F.col("size"))
    out = sizes.where("size > 1").groupBy("column").agg(F.sum("size").alias("rows"), F.sum(F.col("size") * own).alias("own")).join(met, "column")
    mi = digamma(F.col("rows")) + (F.col("own") - F.col("near")) / F.col("rows")
    known = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return known.join(F.broadcast(out), "column", "left").select("column", F.greatest(F.coalesce(mi, F.lit(0.0)), F.lit(0.0)).alias("mi"))
