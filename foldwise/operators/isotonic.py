"""Isotonic least squares over any number of points, without bins.

The fit is the slope of the greatest convex minorant of the running sums (weight, label). The
point of a segment that lies furthest below its chord is a corner of the minorant, so both
sides of it can be fitted on their own; a segment with no point below its chord is one block.
Large segments are cut that way, each round with plain aggregates for all of them, and what
fits one task is pooled there.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwise.operators.ordered import CHUNK, CHUNK_ROWS, chunk_carry, lookup_join, with_chunks
from foldwise.operators.runlog import with_previous
from foldwise.session import materialise

#: The most distinct scores that one task pools.
POOLED = 1 << 18
#: Depth below a chord, as a share of the segment's weight and sum, that counts as none.
FLAT = 1e-12


def _running(points: DataFrame, score: str, rows: int) -> DataFrame:
    """Sums and weights up to and with every score."""
    points = with_chunks(points, score, rows)
    carried = chunk_carry(
        points, [], {"_cs": F.sum("_s"), "_cw": F.sum("_w")}, {"_bs": ("_cs", F.sum), "_bw": ("_cw", F.sum)}
    )
    upto = Window.partitionBy(CHUNK).orderBy(score).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def total(below: str, own: str) -> Column:
        return F.coalesce(F.col(below), F.lit(0.0)) + F.sum(own).over(upto)

    return carried.select(
        F.col(score).alias("_x"), "_s", "_w", total("_bs", "_s").alias("_ts"), total("_bw", "_w").alias("_tw")
    )


def _pooled(points: pd.DataFrame) -> pd.DataFrame:
    """Blocks of one segment by pooling neighbours that violate the order."""
    points = points.sort_values("_x")
    low, high, sums, weights = [], [], [], []
    for x, s, w in zip(points["_x"].to_numpy(), points["_s"].to_numpy(), points["_w"].to_numpy(), strict=True):
        first = x
        while weights and sums[-1] * w >= s * weights[-1]:
            s, w, first = s + sums.pop(), w + weights.pop(), low.pop()
            high.pop()
        low.append(first)
        high.append(x)
        sums.append(s)
        weights.append(w)
    return pd.DataFrame({"low": low, "high": high, "value": np.array(sums) / np.array(weights)})


def fit(
    df: DataFrame, score: str, label: str, weight: str | None = None, pooled: int = POOLED, rows: int = CHUNK_ROWS
) -> DataFrame:
    """``(low, high, value)``: the blocks of the non-decreasing fit of ``label`` by ``score``.

    NULL and NaN scores, NULL labels and weights of 0 or less are left out; no row gives no
    block. Equal scores are one point. No round brings more than a few scalars to the driver.
    """
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    x, y = F.col(score).cast("double"), F.col(label).cast("double")
    known = df.select(x.alias("_x"), (y * w).alias("_s"), w.alias("_w")).where(
        F.col("_x").isNotNull() & ~F.isnan("_x") & F.col("_s").isNotNull() & (F.col("_w") > 0)
    )
    points = materialise(known.groupBy("_x").agg(F.sum("_s").alias("_s"), F.sum("_w").alias("_w")))
    schema, blocks = "low double, high double, value double", None
    if points.count() <= pooled:
        return materialise(points.withColumn("_cut", F.lit(0)).groupBy("_cut").applyInPandas(_pooled, schema))
    # A segment is named by the weight before it.
    rest = materialise(_running(points, "_x", rows).withColumn("_cut", F.lit(0.0)))
    while True:
        large = materialise(
            rest.groupBy("_cut").agg(
                F.count(F.lit(1)).alias("n"), F.min("_x").alias("low"), F.max("_x").alias("high"),
                F.min_by(F.struct((F.col("_ts") - F.col("_s")).alias("s"), (F.col("_tw") - F.col("_w")).alias("w")), "_tw").alias("a"),
                F.max_by(F.struct(F.col("_ts").alias("s"), F.col("_tw").alias("w")), "_tw").alias("b"),
            ).where(F.col("n") > pooled)
            .withColumn("value", (F.col("b.s") - F.col("a.s")) / (F.col("b.w") - F.col("a.w")))
        )
        if large.isEmpty():
            break
        inside = lookup_join(rest, large, ["_cut"]).where(F.col("a").isNotNull())
        below = (F.col("_ts") - F.col("a.s")) - F.col("value") * (F.col("_tw") - F.col("a.w"))
        corner = inside.groupBy("_cut").agg(F.min_by(F.struct("_tw", below.alias("depth")), F.struct(below, "_tw")).alias("c"))
        none = -FLAT * (F.abs(F.col("b.s") - F.col("a.s")) + F.col("b.w") - F.col("a.w"))
        judged = materialise(large.join(corner, "_cut").select(
            "_cut", "low", "high", "value", F.col("c._tw").alias("_at"), (F.col("c.depth") >= none).alias("_whole")
        ))
        whole = judged.where("_whole").select("low", "high", "value")
        blocks = whole if blocks is None else blocks.unionByName(whole)
        rest = materialise(
            lookup_join(rest, judged.select("_cut", "_at", "_whole"), ["_cut"])
            .where(~F.coalesce(F.col("_whole"), F.lit(False)))
            .withColumn("_cut", F.when(F.col("_tw") > F.col("_at"), F.col("_at")).otherwise(F.col("_cut")))
            .drop("_at", "_whole")
        )
    local = rest.select("_cut", "_x", "_s", "_w").groupBy("_cut").applyInPandas(lambda part: _pooled(part), schema)
    return materialise(local if blocks is None else local.unionByName(blocks))


def apply(df: DataFrame, blocks: DataFrame, score: str, name: str = "calibrated", rows: int = CHUNK_ROWS) -> DataFrame:
    """``df`` with the fitted value at ``score``: linear between blocks, level beyond the ends.

    NULL and NaN scores, or no block at all, give NULL. The value is found once a distinct
    score, from the last block's end at or below it, and joined back by measured size.
    """
    ends = F.array_distinct(F.array("low", "high"))
    knots = blocks.select(F.explode(ends).alias("_x"), F.col("value").alias("_y"))
    first = knots.agg(F.min_by("_y", "_x")).first()[0]
    knots = knots.select("*", F.lit(0).alias("_all"), (-F.col("_x")).alias("_down"), F.struct("_x", "_y").alias("_own"))
    # From the top down, the previous end is the next one above.
    knots = with_previous(knots, "_own", "_next", "_all", "_down", rows)
    knots = knots.select("_x", F.lit(0).alias("_kind"), F.struct("_x", "_y", "_next").alias("_knot"))
    asked = df.select(F.col(score).cast("double").alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x")).distinct()
    both = knots.unionByName(asked.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    both = with_chunks(materialise(both), "_x", rows)
    both = chunk_carry(
        both, [], {"_last": F.max_by("_knot", F.when(F.col("_knot").isNotNull(), F.col("_x")))},
        {"_before": ("_last", lambda c: F.last(c, ignorenulls=True))},
    )
    upto = Window.partitionBy(CHUNK).orderBy("_x", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = both.withColumn("_at", F.coalesce(F.last("_knot", ignorenulls=True).over(upto), F.col("_before")))
    low, high = F.col("_at"), F.col("_at._next")
    slope = F.try_divide(F.col("_x") - low["_x"], high["_x"] - low["_x"])
    value = (
        F.when(low.isNull(), F.lit(first).cast("double")).when(high.isNull(), low["_y"])
        .otherwise(low["_y"] + slope * (high["_y"] - low["_y"]))
    )
    values = at.where(F.col("_kind") == 1).select(F.col("_x").alias("_key"), value.alias(name))
    return lookup_join(df.withColumn("_key", F.col(score).cast("double")), values, ["_key"]).drop("_key")
