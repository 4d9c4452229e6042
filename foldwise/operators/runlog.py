"""Analytics over a table of experiment runs: ``experiment, iteration, score, error, ...``.

Every ordered step is cut in chunks of the order, so one long experiment spreads over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from foldwise.functions import text
from foldwise.operators.ordered import (
    CHUNK, CHUNK_ROWS, chunk_carry, chunk_count, join_null_safe, lookup_join, rows_before, with_chunks,
)
from foldwise.session import materialise

# Names of modes and placeholder phrases of the run log.
MODE_TIMEOUT = "DEBUG MODE (TIMEOUT)"
MODE_SYNTAX = "DEBUG MODE (SYNTAX)"
MODE_FEATURE = "FEATURE ENGINEERING MODE"
MODE_TUNING = "ARCHITECTURE & TUNING MODE"
EMPTY_REASONING = (
    "", "No reasoning provided by LLM.", "Execution failed before logic extraction",
)
NEAR_MISS = -0.01
MARGIN = 0.05
PATIENCE = 3
KEEP_FAILED = 7
KEEP_CRASHED = 3

RUN_SCHEMA = T.StructType([
    T.StructField("experiment", T.StringType()), T.StructField("iteration", T.LongType()),
    T.StructField("commit", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("improved", T.BooleanType()), T.StructField("error", T.StringType()),
    T.StructField("agent_reasoning", T.StringType()), T.StructField("mode", T.StringType()),
    T.StructField("prompt", T.StringType()), T.StructField("response", T.StringType()),
])


def chunked(runs: DataFrame, order: str = "iteration", rows: int = CHUNK_ROWS) -> DataFrame:
    return runs if CHUNK in runs.columns else with_chunks(runs, order, rows)


def with_improved(
    runs: DataFrame, seed: float | Column | None = None, group: str = "experiment",
    order: str = "iteration", rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Best score before each run and whether the run beats it; ``seed`` is the first best."""
    runs = chunked(runs, order, rows)
    runs = chunk_carry(
        runs, [group], {"_top": F.max("score")}, {"_carried": ("_top", F.max)}
    )
    seed = seed if isinstance(seed, Column) else F.lit(seed).cast("double")
    best = F.greatest(
        seed, F.col("_carried"), F.max("score").over(rows_before([group], [order]))
    )
    return runs.withColumn("best_before", best).withColumn(
        "improved",
        F.coalesce(F.col("score") > F.col("best_before"), F.col("score").isNotNull()),
    ).drop("_carried")


def with_previous(
    runs: DataFrame, col: str, name: str, group: str = "experiment", order: str = "iteration",
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Value of ``col`` in the previous run of the experiment."""
    runs = chunked(runs, order, rows)
    last = F.max_by(F.struct(F.col(col).alias("v")), order)
    runs = chunk_carry(
        runs, [group], {"_last": last}, {"_carried": ("_last", F.last)}
    )
    inside = Window.partitionBy(group, CHUNK).orderBy(order)
    first = F.row_number().over(inside) == 1
    value = F.when(first, F.col("_carried.v")).otherwise(F.lag(col).over(inside))
    return runs.withColumn(name, value).drop("_carried")


def outcome(score: Column, improved: Column, error: Column) -> Column:
    return (
        F.when(improved, "worked").when(score.isNotNull(), "failed")
        .when(F.coalesce(error, F.lit("")) != "", "crashed")
    )


def delta_note(score: Column, best: Column) -> Column:
    """Distance to the current best, with its band."""
    delta = score - best
    return (
        F.when(delta > 0, F.format_string("Δ=+%.4f", delta))
        .when((delta < 0) & (delta >= NEAR_MISS), F.format_string("Δ=%.4f NEAR MISS", delta))
        .when(delta < NEAR_MISS, F.format_string("Δ=%.4f CATASTROPHIC", delta))
    )


def best_scores(
    runs: DataFrame, seed: float | None = None, group: str = "experiment"
) -> DataFrame:
    """Best score per experiment, combined map-side."""
    top = F.max("score") if seed is None else F.greatest(F.lit(float(seed)), F.max("score"))
    return runs.groupBy(group).agg(top.alias("best"))


def run_memory(
    runs: DataFrame, seed: float | None = None, group: str = "experiment",
    order: str = "iteration",
) -> DataFrame:
    """All successes, the last failed and the last crashed runs of every experiment.

    Needs ``improved`` and ``agent_reasoning``. The rank filters limit each task before the
    shuffle, so a long experiment sends only a few rows per task.
    """
    reasoning = text.one_line(F.coalesce(F.col("agent_reasoning"), F.lit("")))
    kept = lookup_join(runs, best_scores(runs, seed, group), [group])
    kept = kept.select(
        group, order, "score", reasoning.alias("reasoning"),
        outcome(F.col("score"), F.col("improved"), F.col("error")).alias("outcome"),
        delta_note(F.col("score"), F.col("best")).alias("note"),
    ).where(~F.col("reasoning").isin(*EMPTY_REASONING) & F.col("outcome").isNotNull())
    latest = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(order)))
    out = kept.where(F.col("outcome") == "worked")
    for kind, keep in (("failed", KEEP_FAILED), ("crashed", KEEP_CRASHED)):
        part = kept.where(F.col("outcome") == kind).withColumn("_rank", latest)
        out = out.unionByName(part.where(F.col("_rank") <= keep).drop("_rank"))
    return out


def with_mode(
    runs: DataFrame, feature_iterations: int = 5, group: str = "experiment",
    order: str = "iteration", rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Mode of each run, from the previous run's error and the iteration."""
    runs = with_previous(runs, "error", "_error", group, order, rows)
    failed = F.coalesce(F.col("_error"), F.lit("")) != ""
    mode = (
        F.when(failed & text.is_timeout(F.col("_error")), MODE_TIMEOUT)
        .when(failed, MODE_SYNTAX)
        .when(F.col(order) <= feature_iterations, MODE_FEATURE).otherwise(MODE_TUNING)
    )
    return runs.withColumn("mode", mode).drop("_error")


def should_submit(policy: Column, improved: Column) -> Column:
    """``always``/``true`` submit every scored run, ``best`` only improvements."""
    policy = F.lower(policy.cast("string"))
    return policy.isin("always", "true") | ((policy == "best") & improved)


def summary(runs: DataFrame, seed: float | None = None, group: str = "experiment",
            order: str = "iteration") -> DataFrame:
    """Runs, failures, whether all failed, the final best and where it was reached."""
    failed = F.col("error").isNotNull()
    top = F.max("score")
    return runs.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_runs"), F.count_if(failed).alias("n_failed"),
        F.bool_and(failed).alias("all_failed"),
        (top if seed is None else F.greatest(F.lit(float(seed)), top)).alias("best_score"),
        F.min_by(
            F.when(F.col("score").isNotNull(), F.col(order)),
            F.when(F.col("score").isNotNull(), F.struct((-F.col("score")).alias("s"), F.col(order))),
        ).alias("best_iteration"),
    )


def with_code_change(
    runs: DataFrame, response: str = "response", group: str = "experiment",
    order: str = "iteration", rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Whether the code of a run differs from that of the run before."""
    runs = runs.withColumn("_code", text.extract_code(F.col(response)))
    runs = with_previous(runs, "_code", "_earlier", group, order, rows)
    changed = F.col("_earlier").isNotNull() & ~F.col("_earlier").eqNullSafe(F.col("_code"))
    return runs.withColumn("code_changed", changed).drop("_code", "_earlier")


# --- exploration policy ---------------------------------------------------------------
# A run is a crash, a reset (it improved or stayed within the margin) or outside the margin.
# What happens next depends on two bounded counters, crashes (0..1) and outside
# (0..patience-1), packed in one small state.
CRASH, RESET, OUTSIDE = 0, 1, 2
#: Runs whose maps are folded in one array.
SEGMENT_ROWS = 256


def policy_steps(patience: int) -> list[list[int]]:
    """``steps[symbol][state]`` is the next state."""
    crash, reset, outside = [], [], []
    for state in range(2 * patience):
        crashes, away = divmod(state, patience)
        crash.append(0 if crashes else patience + away)
        reset.append(0)
        outside.append(0 if away + 1 >= patience else state + 1)
    return [crash, reset, outside]


def _composed(maps: Column, states: int) -> Column:
    """One map from state to state for an array of them, applied from first to last."""
    same = F.array(*[F.lit(s) for s in range(states)])
    return F.aggregate(maps, same, lambda m, step: F.transform(m, lambda s: F.get(step, s)))


def _visited(start: Column, maps: Column) -> Column:
    """The states on the way through an array of maps: ``start`` and the one after each map."""
    return F.aggregate(
        maps, F.array(start), lambda seen, step: F.array_append(seen, F.get(step, F.element_at(seen, -1)))
    )


def _entries(df: DataFrame, keys: Sequence[str], parts: str, start: str) -> DataFrame:
    """``(keys, parts' first field, _entry)``: the state in which each of the ordered ``parts`` is entered."""
    ways = F.arrays_zip(F.col(parts).alias("part"), _visited(F.col(start), F.col(f"{parts}._map")).alias("state"))
    # There is one state more than parts: the exit.
    return df.select(*keys, F.explode(ways).alias("x")).where("x.part is not null").select(
        *keys, "x.part.*", F.col("x.state").alias("_entry")
    ).drop("_map")


def replay_policy(
    runs: DataFrame, seed: float = 0.0, margin: float = MARGIN, patience: int = PATIENCE,
    group: str = "experiment", order: str = "iteration", state: DataFrame | None = None,
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Action of the exploration policy on every run, in order, per experiment.

    Adds ``best_before, improved, action, crashes, outside`` (the counters after the run).
    ``state`` may give ``(group, best, crashes, outside)`` to continue from.

    The best score before a run is a running maximum. The counters are a small state machine:
    a segment of ``SEGMENT_ROWS`` runs is a map from entry state to exit state, folded from its
    runs' maps. The maps of a chunk are folded in turn, the chunks of an experiment are chained,
    and states are handed down again: to chunks, to segments, to runs. So no array holds more
    than a segment's rows, a chunk's segments or an experiment's chunks, and a long experiment
    spreads over tasks. Runs without an order come first or last in it; equal ones in any order.
    """
    if state is not None:
        known = state.select(
            group, F.col("best").alias("_best"),
            (F.col("crashes") * patience + F.col("outside")).cast("int").alias("_start"),
        )
        runs = lookup_join(runs, known, [group])
    else:
        runs = runs.withColumns({"_best": F.lit(None).cast("double"), "_start": F.lit(0)})
    runs = runs.withColumn("_start", F.coalesce(F.col("_start"), F.lit(0)))
    runs = chunked(runs, order, rows)
    runs = with_improved(runs, F.coalesce(F.col("_best"), F.lit(float(seed))), group, order)
    gap = F.col("best_before") - F.col("score")
    kept = [c for c in runs.columns if c not in (CHUNK, "_best", "_start")]
    keys, states = [group, CHUNK], 2 * patience
    steps = F.array(*[F.array(*map(F.lit, to)) for to in policy_steps(patience)])
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    symbol = (
        F.when(F.col("score").isNull(), CRASH)
        .when(F.col("improved") | (gap <= margin), RESET).otherwise(OUTSIDE)
    )
    rows_of = F.collect_list(F.struct("_at", "_symbol", F.struct(*kept).alias("row")))
    segments = (
        runs.withColumns({"_at": at, "_symbol": symbol})
        .groupBy(*keys, F.floor((F.col("_at") - 1) / SEGMENT_ROWS).cast("int").alias("_segment"))
        .agg(F.array_sort(rows_of, lambda a, b: a["_at"] - b["_at"]).alias("_rows"), F.first("_start").alias("_start"))
    )
    maps = F.transform("_rows", lambda r: F.get(steps, r["_symbol"]))
    segments = materialise(segments.withColumn("_map", _composed(maps, states)))
    chunks = segments.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("_segment", "_map"))).alias("_parts"), F.first("_start").alias("_entry")
    )
    if chunk_count(runs) > 1:
        chunks = materialise(chunks.withColumn("_map", _composed(F.col("_parts._map"), states)))
        chains = chunks.groupBy(group).agg(
            F.array_sort(F.collect_list(F.struct(CHUNK, "_map"))).alias("_parts"), F.first("_entry").alias("_start")
        )
        chunks = join_null_safe(chunks.drop("_entry", "_map"), _entries(chains, [group], "_parts", "_start"), keys)
    entries = _entries(chunks, keys, "_parts", "_entry")
    entered = join_null_safe(segments, entries, [*keys, "_segment"])
    after = F.slice(_visited(F.col("_entry"), maps), F.lit(2), F.size("_rows"))
    out = entered.select(
        F.explode(F.arrays_zip(F.col("_rows").alias("of"), after.alias("state"))).alias("x")
    ).select("x.of.row.*", F.col("x.of._symbol").alias("_symbol"), F.col("x.state").alias("_state"))
    cleared = F.col("_state") == 0
    return out.withColumns({
        "action": F.when(F.col("_symbol") == CRASH, F.when(cleared, "crash_rollback").otherwise("retry"))
        .when(F.col("_symbol") == OUTSIDE, F.when(cleared, "rollback").otherwise("warn"))
        .when(F.col("improved"), "commit").otherwise("explore"),
        "crashes": F.floor(F.col("_state") / patience).cast("int"),
        "outside": (F.col("_state") % patience).cast("int"),
    }).drop("_symbol", "_state")


def final_state(
    replayed: DataFrame, group: str = "experiment", order: str = "iteration"
) -> DataFrame:
    """State of each experiment after its last run, to continue from."""
    last = F.max_by(F.struct("crashes", "outside"), order)
    return replayed.groupBy(group).agg(
        F.greatest(F.max("best_before"), F.max("score")).alias("best"),
        last.alias("x"), F.max(order).alias("last_iteration"),
    ).select(group, "best", "x.crashes", "x.outside", "last_iteration")
