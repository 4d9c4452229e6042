"""What several operators of this subpackage share."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foldwise.session import materialise

__all__ = ["bytes_within", "hash_sample", "labelled_sample", "materialise", "release", "remainder", "table", "unsigned"]


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now.

    Its cleaner follows the driver's garbage collection, which a driver of little work may not
    need for many steps, while the executors' disks fill.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table; all others are pruned in the scan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key's text, modulo ``modulus``; NULL for a NULL key."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(modulus))


def unsigned(column: str) -> str:
    """SQL for the 16 hexadecimal digits of a bigint's bits."""
    return f"lpad(lower(hex({column})), 16, '0')"


def bytes_within(df: DataFrame, limit: int) -> bool:
    """Whether the rows of ``df``, as text, hold at most ``limit`` bytes: the check before a broadcast."""
    size = df.select(F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0)).alias("n"))
    return size.first().n <= limit


def labelled_sample(labels: DataFrame, column: str, modulus: int, held_out: int, per_class: int) -> DataFrame:
    """doc_id and ``label`` of at most ``per_class`` learnable rows of each class of ``labels``.

    Rows whose crc32 remainder is ``held_out``, NULL ids and labels other than 0 and 1 are left
    out; the rest is taken by :func:`hash_sample`. Of an id's repeated rows the largest label counts.
    """
    known = labels.select(F.col("doc_id"), F.col(column).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (remainder(F.col("doc_id"), modulus) != held_out)
    )
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    parts = [hash_sample(known.where(F.col("label") == c), per_class, "doc_id") for c in (0, 1)]
    return parts[0].unionByName(parts[1])


def hash_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """All of ``df``, or about nine tenths of ``rows`` rows whose keys' hash is below a bound, never over ``rows``.

    Rows are judged one by one, so no task gathers more than the sample, and the same rows give the
    same sample (but for repeated keys that alone pass the bound, of which some are taken).
    """
    n = df.count()
    if n > rows:
        bound = int((1 << 30) * 0.9 * rows / n)
        df = df.where(F.pmod(F.xxhash64(F.lit("sample"), *keys), F.lit(1 << 30)) < bound)
    return df.limit(rows)
