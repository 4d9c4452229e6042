"""Readers. Schemas come from the files or the caller; a header read touches metadata only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.functions.hashing import SEED, hash52
from foldwise.operators.ordered import first_rows
from foldwise.session import materialise

MAX_ROWS = 100_000
FORMATS = {"csv": "csv", "tsv": "csv", "json": "json", "orc": "orc", "parquet": "parquet"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def format_of(path: str) -> str:
    parts = path.rstrip("/").lower().split(".")
    parts = parts[:-1] if parts[-1] in ("gz", "bz2", "zst", "zip") else parts
    return FORMATS.get(parts[-1], "parquet")


def read_table(
    spark: SparkSession, path: str, kind: str | None = None,
    schema: T.StructType | str | None = None, columns: Sequence[str] | None = None,
) -> DataFrame:
    """Read CSV, JSON, ORC or Parquet. Give a schema for large CSV: inference is a full scan."""
    kind = kind or format_of(path)
    reader = spark.read.format(kind)
    if schema is not None:
        reader = reader.schema(schema)
    if kind == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
        if path.rstrip("/").lower().endswith("tsv"):
            reader = reader.option("sep", "\t")
    df = reader.load(path)
    return df.select(*columns) if columns else df


def read_if_present(spark: SparkSession, path: str | None, **kwargs) -> DataFrame | None:
    """The table, or None without a path or without files behind it."""
    if not path:
        return None
    try:
        return read_table(spark, path, **kwargs)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def column_names(spark: SparkSession, path: str, kind: str | None = None) -> list[str]:
    """Column names without reading rows: the header of a CSV, the schema of other formats."""
    kind = kind or format_of(path)
    reader = spark.read.format(kind)
    if kind == "csv":
        reader = reader.option("header", True)
    return reader.load(path).columns


def first_n(df: DataFrame, key: str, n: int = MAX_ROWS) -> DataFrame:
    """The first ``n`` rows by a numeric key."""
    return first_rows(df, F.col(key), key, n)


def hashed_n(df: DataFrame, key: Column, n: int = MAX_ROWS, seed: int = SEED) -> DataFrame:
    """``n`` rows by key hash: the same on every partitioning.

    Hashes are uniform, so a filter a little above the expected cut leaves hardly more than
    ``n`` rows; the exact cut is made among those, or among all if they are too few.
    """
    hashed = df.withColumn("_key", key).withColumn("_hash", hash52(F.col("_key"), seed))
    total = df.agg(F.count(F.lit(1))).first()[0]
    if n >= total:
        return df
    share = (n + 8 * math.sqrt(n) + 8) / total
    near = hashed
    if share < 1:
        near = materialise(hashed.where(F.col("_hash") < F.lit(int(share * (1 << 52)))))
        near = near if near.count() >= n else hashed
    return first_rows(near, F.col("_hash"), "_key", n).drop("_key", "_hash")


def hashed_share(df: DataFrame, key: Column, share: float, seed: int = SEED) -> DataFrame:
    """About ``share`` of the rows by key hash, as a plain filter."""
    return df.where(F.pmod(hash52(key, seed), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))


def assert_unique(df: DataFrame, key: Column) -> DataFrame:
    """Raise when rows share a key: samples and out-of-fold coverage need one row per key."""
    twice = df.groupBy(key.alias("key")).count().where(F.col("count") > 1).limit(1).count()
    if twice:
        raise ValueError("row keys are not unique")
    return df
