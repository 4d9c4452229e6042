"""Session helpers: a local session for tests, and reliable materialisation for clusters."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and local benches. Clusters bring their own configuration."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("foldwise")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="foldwise-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset it is the folder of the context's checkpoints, or one in the warehouse,
    which the executors share too; never a machine's own temporary folder.
    """
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return known or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, never used twice."""
    return f"{shared_dir(spark).rstrip('/')}/foldwise/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` reliably: the rows survive the loss of any executor."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared folder: as safe as :func:`materialise` and smaller, but its partitioning is lost."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "rows")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
