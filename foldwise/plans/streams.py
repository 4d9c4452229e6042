"""Queries over streams of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators.ordered import CHUNK
from foldwise.plans.fixtures import runs
from foldwise.plans.runlogs import BASE, ORACLE as BATCH_ORACLE
from foldwise.session import materialise, scratch_path
from foldwise.streaming.policy import read_actions, replay_stream

QUERIES, ORACLE = {}, {}

ARRIVALS = 4


def run_policy_stream(spark: SparkSession, sf: str) -> DataFrame:
    """All runs arrive in four rounds of files; the stream resumes from its checkpoint each time."""
    base = scratch_path(spark, "stream")
    # Numbered once: every round reads it.
    log = materialise(runs(spark, sf).drop(CHUNK))
    last = log.agg(F.max("iteration")).first()[0]
    step = -(-last // ARRIVALS)
    for i in range(ARRIVALS):
        arrived = log.where((F.col("iteration") > i * step) & (F.col("iteration") <= (i + 1) * step))
        arrived.write.mode("append").parquet(f"{base}/in")
        files = spark.readStream.schema(log.schema).parquet(f"{base}/in")
        replay_stream(
            files, f"{base}/out", f"{base}/state", f"{base}/checkpoint", BASE
        ).awaitTermination()
    return read_actions(spark, f"{base}/out").select(
        "event_id", "experiment", "iteration", "action", "crashes", "outside"
    )


QUERIES["run_policy_stream"] = run_policy_stream
ORACLE["run_policy_stream"] = BATCH_ORACLE["run_policy"]
