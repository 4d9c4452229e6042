"""Schema operators: names, roles, task inference, train/test alignment."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLASS_LIMIT = 20
PROBE_ROWS = 500


def require_column(df: DataFrame, col: str) -> DataFrame:
    if not col or col not in df.columns:
        raise ValueError(f"Target column '{col}' not found in dataset.")
    return df


def clean_names(names: Sequence[str]) -> list[str]:
    """Drop everything but word characters and blanks, blanks to ``_``; collisions get a suffix."""
    out: list[str] = []
    for name in names:
        base = re.sub(r"[^\w\s]", "", str(name)).replace(" ", "_")
        unique, n = base, 1
        while unique in out:
            n += 1
            unique = f"{base}_{n}"
        out.append(unique)
    return out


def clean_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_names(df.columns))


def is_fractional(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def normalise_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in every fractional column: one spelling of a missing number."""
    fixes = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema.fields if is_fractional(f.dataType)
    }
    return df.withColumns(fixes) if fixes else df


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    require_column(df, target)
    return df.dropna(subset=[target])


@dataclass
class Roles:
    """Feature columns by the way they are prepared."""

    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    boolean: list[str] = field(default_factory=list)
    temporal: list[str] = field(default_factory=list)
    other: list[str] = field(default_factory=list)


def infer_roles(df: DataFrame, exclude: Sequence[str] = ()) -> Roles:
    roles = Roles()
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.NumericType):
            roles.numeric.append(f.name)
        elif isinstance(f.dataType, (T.StringType, T.CharType, T.VarcharType)):
            roles.categorical.append(f.name)
        elif isinstance(f.dataType, T.BooleanType):
            roles.boolean.append(f.name)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            roles.temporal.append(f.name)
        else:
            roles.other.append(f.name)
    return roles


def select_role(df: DataFrame, role: str, exclude: Sequence[str] = ()) -> DataFrame:
    return df.select(*getattr(infer_roles(df, exclude), role))


def infer_tasks(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """``classification`` for columns with fewer than CLASS_LIMIT distinct present values.

    A few rows already prove that most columns have enough values: their hashes differ. Only
    columns they leave open are counted in full, all in one shuffle of their distinct values.
    """
    frame = normalise_nan(df.select(*cols))
    marks = [F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias(c) for c in cols]
    rows = frame.select(*marks).take(PROBE_ROWS)
    seen = {c: {r[c] for r in rows if r[c] is not None} for c in cols}
    tasks = {c: "regression" for c in cols if len(seen[c]) >= CLASS_LIMIT}
    unclear = [c for c in cols if c not in tasks]
    if unclear:
        counted = (
            frame.select(F.explode(F.array(*[
                F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                for c in unclear
            ])).alias("x")).select("x.*")
            .where(F.col("value").isNotNull()).distinct()
            .groupBy("column").count()
        )
        counts = {r["column"]: r["count"] for r in counted.collect()}
        for c in unclear:
            tasks[c] = "classification" if counts.get(c, 0) < CLASS_LIMIT else "regression"
    return tasks


def infer_task(df: DataFrame, target: str) -> str:
    require_column(df, target)
    return infer_tasks(df, [target])[target]


def align_to_train(test: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Train columns in train order, missing ones as 0, unknown ones dropped, ids kept."""
    have = set(test.columns)
    filled = [F.col(c) if c in have else F.lit(0).alias(c) for c in features if c not in keep]
    return test.select(*keep, *filled)


def common_columns(train: DataFrame, test: DataFrame) -> list[str]:
    have = set(test.columns)
    return [c for c in train.columns if c in have]
