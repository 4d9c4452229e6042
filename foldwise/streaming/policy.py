"""The exploration policy over a stream of runs.

Every micro-batch is replayed by the batch operator from the state that earlier batches
left. A long experiment is therefore cut in chunks inside a batch as in batch mode, while a
keyed streaming state would pull all its rows into one task. A batch writes the state of its
own experiments only; a snapshot of all is written every ``SNAPSHOT_EVERY`` batches. All
tables are written per batch number, so a batch that is run again after a failure replaces
its own output.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foldwise.operators.ordered import CHUNK_ROWS, lookup_join
from foldwise.operators.runlog import MARGIN, PATIENCE, final_state, replay_policy

BATCH = "batch"
LATE = "late"
CHANGES, WHOLE = "changes", "whole"
#: Batches after which the state of all experiments is written anew, so that few changes are read.
SNAPSHOT_EVERY = 32


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def state_before(spark: SparkSession, path: str, batch_id: int, group: str = "experiment") -> DataFrame | None:
    """State of every experiment before ``batch_id``.

    It is the last snapshot before that batch and the changes after it, the latest one of each
    experiment; batches are directories, so the rest is pruned.
    """
    whole, changes = _read(spark, f"{path}/{WHOLE}"), _read(spark, f"{path}/{CHANGES}")
    if changes is None:
        return None
    changes, since = changes.where(F.col(BATCH) < batch_id), None
    if whole is not None:
        since = whole.where(F.col(BATCH) < batch_id).agg(F.max(BATCH)).first()[0]
    if since is not None:
        # A snapshot holds the changes of its own batch.
        changes = whole.where(F.col(BATCH) == since).unionByName(changes.where(F.col(BATCH) > since))
    kept = [c for c in changes.columns if c not in (group, BATCH)]
    latest = changes.groupBy(group).agg(F.max_by(F.struct(*kept), BATCH).alias("x")).select(group, "x.*")
    return None if latest.isEmpty() else latest


def replay_batch(
    batch: DataFrame, batch_id: int, out: str, states: str, seed: float = 0.0,
    margin: float = MARGIN, patience: int = PATIENCE, group: str = "experiment",
    order: str = "iteration", rows: int = CHUNK_ROWS, snapshot_every: int = SNAPSHOT_EVERY,
) -> None:
    """Replay one batch, write its actions, then the new state of the experiments that it holds.

    A run that is not after its experiment's last known one is kept with the action ``late``
    and changes nothing.
    """
    spark = batch.sparkSession
    state = state_before(spark, states, batch_id, group)
    if state is not None:
        known = state.select(group, F.col("last_iteration").alias("_last"))
        batch = lookup_join(batch, known, [group])
        late = F.coalesce(F.col(order) <= F.col("_last"), F.lit(False))
        delayed, batch = batch.where(late).drop("_last"), batch.where(~late).drop("_last")
    replayed = replay_policy(batch, seed, margin, patience, group, order, state, rows)
    if state is not None:
        replayed = replayed.unionByName(
            delayed.withColumn("action", F.lit(LATE)), allowMissingColumns=True
        )
    target = f"{out}/{BATCH}={batch_id}"
    replayed.write.mode("overwrite").parquet(target)
    done = spark.read.schema(replayed.schema).parquet(target).where(F.col("action") != LATE)
    final_state(done, group, order).write.mode("overwrite").parquet(f"{states}/{CHANGES}/{BATCH}={batch_id}")
    if batch_id % snapshot_every == snapshot_every - 1:
        now = state_before(spark, states, batch_id + 1, group)
        if now is not None:
            now.write.mode("overwrite").parquet(f"{states}/{WHOLE}/{BATCH}={batch_id}")


def replay_stream(
    runs: DataFrame, out: str, states: str, checkpoint: str, seed: float = 0.0,
    margin: float = MARGIN, patience: int = PATIENCE, group: str = "experiment",
    order: str = "iteration", rows: int = CHUNK_ROWS, available_now: bool = True,
    snapshot_every: int = SNAPSHOT_EVERY,
) -> StreamingQuery:
    """Start the replay of a stream of runs that arrive in order per experiment."""
    writer = runs.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: replay_batch(
            batch, batch_id, out, states, seed, margin, patience, group, order, rows, snapshot_every
        )
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_actions(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).drop(BATCH)
