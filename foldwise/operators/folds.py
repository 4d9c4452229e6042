"""Reproducible folds. Every fold is a function of keys and data, never of partitioning."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.functions.hashing import SEED, digest, hash32, hash52
from foldwise.operators.ordered import (
    CHUNK, CHUNK_ROWS, MAX_CHUNKS, exact_quantiles, order_number, row_number_in_group,
)

FOLD = "fold"


def fold_of(key: Column, k: int = 5, seed: int = SEED) -> Column:
    return F.pmod(hash32(key, seed), F.lit(k)).cast("int")


def kfold(df: DataFrame, key: Column, k: int = 5, seed: int = SEED, name: str = FOLD) -> DataFrame:
    """Shuffled k-fold by key hash: no data movement, balanced in expectation."""
    return df.withColumn(name, fold_of(key, k, seed))


def group_kfold(df: DataFrame, group: str, k: int = 5, seed: int = SEED) -> DataFrame:
    """All rows of a group share a fold."""
    return df.withColumn(FOLD, fold_of(F.col(group).cast("string"), k, seed))


def _class_positions(df, label, key, seed, rows):
    """Position of each row in its class by key digest, with the class split by hash range."""
    total = df.agg(F.count(F.lit(1))).first()[0]
    chunks = max(1, min(MAX_CHUNKS, math.ceil(total / rows)))
    part = F.floor(F.col("_hash") / F.lit(2.0**52 / chunks)).cast("int")
    df = df.withColumns({"_hash": hash52(key, seed), "_digest": digest(key, seed), "_key": key})
    df = df.withColumn(CHUNK, part.alias(CHUNK, metadata={"chunks": chunks}))
    df = row_number_in_group(df, [label], ["_hash", "_digest", "_key"], "_position")
    return df.drop("_hash", "_digest", "_key", CHUNK)


def stratified_kfold(
    df: DataFrame, label: str, key: Column, k: int = 5, seed: int = SEED, rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Exactly stratified folds: class sizes per fold differ by at most one.

    A class with a third of the rows is split into hash ranges, so it is not one task.
    """
    placed = _class_positions(df, label, key, seed, rows)
    fold = F.pmod(F.col("_position") - 1, F.lit(k)).cast("int")
    return placed.withColumn(FOLD, fold).drop("_position")


def stratified_split(
    df: DataFrame, label: str, key: Column, test_share: float = 0.2, seed: int = SEED,
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Boolean ``is_test`` for ``floor(share * n)`` rows of every class."""
    share = round(test_share * 1000)
    placed = _class_positions(df, label, key, seed, rows)
    upto = F.floor(F.col("_position") * share / 1000)
    before = F.floor((F.col("_position") - 1) * share / 1000)
    return placed.withColumn("is_test", upto > before).drop("_position")


def time_blocks(df: DataFrame, time: str, splits: int = 5) -> DataFrame:
    """Column ``block`` 0..splits by time quantile.

    Split i trains on ``block < i`` and validates on ``block = i``, for i = 1..splits.
    """
    probs = [i / (splits + 1) for i in range(1, splits + 1)]
    # The number is computed once a pass, not once for each bracket and cut.
    numbered = df.withColumn("_number", order_number(df, time))
    cuts = exact_quantiles(numbered.select("_number"), {"t": F.col("_number")}, probs)["t"]
    later = F.filter(F.array(*[F.lit(c) for c in cuts if c is not None]).cast("array<double>"), lambda c: F.col("_number") > c)
    return numbered.withColumn("block", F.size(later)).drop("_number")


def split_fold(df: DataFrame, i: int, name: str = FOLD) -> tuple[DataFrame, DataFrame]:
    """Train and validation rows of fold ``i``: two filters, no join."""
    return df.where(F.col(name) != i), df.where(F.col(name) == i)


def fold_sizes(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(FOLD, *by).agg(F.count(F.lit(1)).alias("n"))
