"""Raw predictions and their final form."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators.metrics import argmax
from foldwise.operators.schema import is_fractional

log = logging.getLogger(__name__)

KINDS = ("prob", "0/1", "true/false", "multiclass_prob", "multiclass_class")


def raw_predictions(
    scored: DataFrame, key: str, target: str, value: str | None = None,
    probs: str | None = None, classes: int = 0,
) -> DataFrame:
    """Key first, then the target column, or ``class_i`` columns for several classes."""
    if probs and classes > 2:
        cols = [F.get(F.col(probs), F.lit(i)).alias(f"class_{i}") for i in range(classes)]
        return scored.select(key, *cols)
    return scored.select(key, F.col(value).alias(target))


def all_in_unit_range(df: DataFrame, col: str) -> bool:
    """Whether a fractional column lies in [0, 1] on every row; a missing value does not."""
    if not is_fractional(df.schema[col].dataType):
        return False
    inside = F.coalesce(F.col(col).between(0, 1), F.lit(False))
    return df.agg(F.bool_and(inside)).first()[0] is not False


def rename_to_example(df: DataFrame, example: Sequence[str] | None) -> DataFrame:
    """The first two columns take the example's names when both have more than one column."""
    if not example or len(example) < 2 or len(df.columns) < 2:
        return df
    return df.toDF(*example[:2], *df.columns[2:])


def format_predictions(
    raw: DataFrame, kind: str = "prob", example: Sequence[str] | None = None,
    target: str | None = None, classes: Sequence | None = None,
) -> DataFrame:
    """Shape raw predictions as required. ``classes`` are the sorted training classes."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}, expected one of {KINDS}")
    out = rename_to_example(raw, example)
    if kind == "multiclass_class":
        probs, names = out.columns[1:], list(classes or ())
        if len(names) < len(probs):
            raise ValueError(f"{len(probs)} probability columns but {len(names)} classes")
        name = example[1] if example and len(example) > 1 else target
        index = argmax(F.array(*[F.col(p).cast("double") for p in probs]))
        label = F.get(F.array(*[F.lit(c) for c in names]), index)
        return out.select(out.columns[0], label.alias(name))
    if kind == "multiclass_prob":
        if example and len(example) == len(out.columns):
            return out.toDF(*example)
        if example:
            log.warning("predictions have %d columns, example %d", len(out.columns), len(example))
        return out
    if len(out.columns) < 2 or kind == "prob":
        return out
    value = out.columns[1]
    if not all_in_unit_range(out, value):
        return out
    hit = F.col(value) >= 0.5
    return out.withColumn(value, hit.cast("int") if kind == "0/1" else hit)
