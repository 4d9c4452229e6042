"""Queries over the log of experiment runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators import runlog
from foldwise.plans.fixtures import RUNS, runs

QUERIES, ORACLE = {}, {}

BASE = 0.0


def judged(spark: SparkSession, sf: str) -> DataFrame:
    return runlog.with_improved(runs(spark, sf), BASE)


QUERIES["run_improved"] = lambda spark, sf: judged(spark, sf).select(
    "event_id", "experiment", "iteration", F.round("best_before", 6).alias("best_before"), "improved",
    runlog.outcome(F.col("score"), F.col("improved"), F.col("error")).alias("outcome"),
)
ORACLE["run_improved"] = f"""WITH {RUNS}
SELECT event_id, experiment, iteration, round(best_before, 6) AS best_before, improved,
  CASE WHEN improved THEN 'worked' WHEN score IS NOT NULL THEN 'failed' ELSE 'crashed' END AS outcome
FROM improved"""

QUERIES["run_memory"] = lambda spark, sf: runlog.run_memory(judged(spark, sf), BASE).select(
    "experiment", "iteration", "outcome", "reasoning", "note"
)
ORACLE["run_memory"] = f"""WITH {RUNS},
best AS (SELECT experiment, greatest(0.0::DOUBLE, max(score)) AS best FROM runs GROUP BY 1),
d AS (
  SELECT i.*, score - best AS delta, CASE WHEN improved THEN 'worked' WHEN score IS NOT NULL THEN 'failed'
    ELSE 'crashed' END AS outcome FROM improved i JOIN best USING (experiment)),
r AS (SELECT *, row_number() OVER (PARTITION BY experiment, outcome ORDER BY iteration DESC) AS rn FROM d)
SELECT experiment, iteration, outcome, agent_reasoning AS reasoning,
  CASE WHEN delta > 0 THEN printf('Δ=+%.4f', delta)
       WHEN delta < 0 AND delta >= -0.01::DOUBLE THEN printf('Δ=%.4f NEAR MISS', delta)
       WHEN delta < -0.01::DOUBLE THEN printf('Δ=%.4f CATASTROPHIC', delta) END AS note
FROM r WHERE outcome = 'worked' OR (outcome = 'failed' AND rn <= 7) OR (outcome = 'crashed' AND rn <= 3)"""

QUERIES["run_mode"] = lambda spark, sf: runlog.with_mode(runs(spark, sf)).select(
    "event_id", "experiment", "iteration", "mode"
)
ORACLE["run_mode"] = f"""WITH {RUNS},
l AS (SELECT *, lag(error) OVER (PARTITION BY experiment ORDER BY iteration) AS e FROM runs)
SELECT event_id, experiment, iteration, CASE WHEN e LIKE '%Timed Out%' THEN 'DEBUG MODE (TIMEOUT)'
  WHEN e IS NOT NULL THEN 'DEBUG MODE (SYNTAX)' WHEN iteration <= 5 THEN 'FEATURE ENGINEERING MODE'
  ELSE 'ARCHITECTURE & TUNING MODE' END AS mode FROM l"""

QUERIES["run_policy"] = lambda spark, sf: runlog.replay_policy(runs(spark, sf), BASE).select(
    "event_id", "experiment", "iteration", "action", "crashes", "outside"
)
ORACLE["run_policy"] = f"""WITH RECURSIVE {RUNS},
replay AS (
  SELECT experiment, 0::BIGINT AS iteration, 0.0::DOUBLE AS best, 0 AS crashes, 0 AS outside,
         NULL::VARCHAR AS action, NULL::BIGINT AS event_id FROM (SELECT DISTINCT experiment FROM runs)
  UNION ALL
  SELECT n.experiment, n.iteration,
    CASE WHEN n.score > r.best THEN n.score ELSE r.best END,
    CASE WHEN n.score IS NULL THEN CASE WHEN r.crashes + 1 >= 2 THEN 0 ELSE r.crashes + 1 END
         WHEN n.score > r.best OR r.best - n.score <= 0.05::DOUBLE THEN 0
         WHEN r.outside + 1 >= 3 THEN 0 ELSE r.crashes END,
    CASE WHEN n.score IS NULL THEN CASE WHEN r.crashes + 1 >= 2 THEN 0 ELSE r.outside END
         WHEN n.score > r.best OR r.best - n.score <= 0.05::DOUBLE THEN 0
         WHEN r.outside + 1 >= 3 THEN 0 ELSE r.outside + 1 END,
    CASE WHEN n.score IS NULL THEN CASE WHEN r.crashes + 1 >= 2 THEN 'crash_rollback' ELSE 'retry' END
         WHEN n.score > r.best THEN 'commit' WHEN r.best - n.score <= 0.05::DOUBLE THEN 'explore'
         WHEN r.outside + 1 >= 3 THEN 'rollback' ELSE 'warn' END,
    n.event_id
  FROM replay r JOIN runs n ON n.experiment = r.experiment AND n.iteration = r.iteration + 1)
SELECT event_id, experiment, iteration, action, crashes::INTEGER AS crashes, outside::INTEGER AS outside
FROM replay WHERE iteration > 0"""

QUERIES["run_summary"] = lambda spark, sf: runlog.summary(runs(spark, sf), BASE).withColumn(
    "best_score", F.round("best_score", 6)
)
ORACLE["run_summary"] = f"""WITH {RUNS}
SELECT experiment, count(*) AS n_runs, count(error) AS n_failed, bool_and(error IS NOT NULL) AS all_failed,
  round(greatest(0.0::DOUBLE, max(score)), 6) AS best_score,
  any_value(top) AS best_iteration
FROM (SELECT *, first_value(CASE WHEN score IS NOT NULL THEN iteration END) OVER (
        PARTITION BY experiment ORDER BY score DESC NULLS LAST, iteration) AS top FROM runs)
GROUP BY experiment"""

QUERIES["run_submit"] = lambda spark, sf: judged(spark, sf).select(
    "event_id", *[
        F.coalesce(
            F.col("score").isNotNull() & runlog.should_submit(F.lit(p), F.col("improved")), F.lit(False)
        ).alias(f"submit_{p}") for p in ("always", "best", "never")
    ]
)
ORACLE["run_submit"] = f"""WITH {RUNS}
SELECT event_id, score IS NOT NULL AS submit_always, coalesce(improved, FALSE) AS submit_best,
  FALSE AS submit_never FROM improved"""


def run_code_change(spark: SparkSession, sf: str) -> DataFrame:
    """Replies whose code is the event type: it changes when the type does."""
    reply = F.concat(
        F.lit("Run.\n```python\nuse = '"), F.col("agent_reasoning"), F.lit("'\n```\nNr. "),
        F.col("iteration").cast("string"),
    )
    log = runs(spark, sf).withColumn("response", reply)
    return runlog.with_code_change(log).select("event_id", "iteration", "code_changed")


QUERIES["run_code_change"] = run_code_change
ORACLE["run_code_change"] = f"""WITH {RUNS},
l AS (SELECT *, lag(agent_reasoning) OVER (PARTITION BY experiment ORDER BY iteration) AS p FROM runs)
SELECT event_id, iteration, p IS NOT NULL AND p <> agent_reasoning AS code_changed FROM l"""

QUERIES["run_final_state"] = lambda spark, sf: runlog.final_state(
    runlog.replay_policy(runs(spark, sf), BASE)
).withColumn("best", F.round("best", 6))
ORACLE["run_final_state"] = ORACLE["run_policy"][: ORACLE["run_policy"].rindex("SELECT event_id")] + """
SELECT experiment, round(best, 6) AS best, crashes::INTEGER AS crashes, outside::INTEGER AS outside,
  iteration AS last_iteration FROM replay
QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY iteration DESC) = 1"""
