"""Queries that shape predictions as an output requires."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators import encode, folds, metrics, output
from foldwise.plans.fixtures import CLASS_RATES, class_list, class_predictions, sql_fold
from foldwise.sources import tables
from foldwise.sources.sinks import write_csv
from foldwise.session import scratch_path
from foldwise.sources.tables import table

QUERIES, ORACLE = {}, {}


def raw_binary(spark: SparkSession, sf: str) -> DataFrame:
    """Out-of-fold probability by user that an event is a purchase or a sign-up."""
    events = folds.kfold(table(spark, sf, "events"), F.col("event_id")).select(
        "event_id", "fold", F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type").isin("purchase", "signup", "click").cast("int").alias("label"),
    )
    scored = encode.target_encode_oof(events, "user_id", "label", name="p")
    return output.raw_predictions(scored, "event_id", "label", "p")


RAW_SQL = f"""e AS (
  SELECT event_id, {sql_fold('event_id')} AS fold, user_id,
         (event_type IN ('purchase', 'signup', 'click'))::INT AS y FROM events),
cf AS (SELECT user_id, fold, count(*) AS n, sum(y) AS s FROM e GROUP BY ALL),
c AS (SELECT user_id, sum(n) AS n, sum(s) AS s FROM cf GROUP BY ALL),
f AS (SELECT fold, sum(n) AS n, sum(s) AS s FROM cf GROUP BY ALL),
a AS (SELECT sum(n) AS n, sum(s) AS s FROM cf),
raw AS (
  SELECT e.event_id, ((c.s - cf.s)::DOUBLE + 10.0::DOUBLE * ((a.s - f.s)::DOUBLE / (a.n - f.n)::DOUBLE))
    / ((c.n - cf.n)::DOUBLE + 10.0::DOUBLE) AS p
  FROM e JOIN cf USING (user_id, fold) JOIN c USING (user_id) JOIN f USING (fold) CROSS JOIN a)"""

EXAMPLE = ["id", "target"]

QUERIES["format_prob"] = lambda spark, sf: output.format_predictions(
    raw_binary(spark, sf), "prob", EXAMPLE
).select("id", F.round("target", 6).alias("target"))
ORACLE["format_prob"] = f"WITH {RAW_SQL} SELECT event_id AS id, round(p, 6) AS target FROM raw"

QUERIES["format_01"] = lambda spark, sf: output.format_predictions(
    raw_binary(spark, sf), "0/1", EXAMPLE
)
ORACLE["format_01"] = f"WITH {RAW_SQL} SELECT event_id AS id, (p >= 0.5)::INTEGER AS target FROM raw"

QUERIES["format_bool"] = lambda spark, sf: output.format_predictions(
    raw_binary(spark, sf), "true/false"
)
ORACLE["format_bool"] = f"WITH {RAW_SQL} SELECT event_id, p >= 0.5 AS label FROM raw"


def format_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Values outside [0, 1] are no probabilities and stay as they are."""
    raw = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("target"))
    return output.format_predictions(raw, "0/1", EXAMPLE)


QUERIES["format_guard"] = format_guard
ORACLE["format_guard"] = "SELECT c_custkey AS id, c_acctbal AS target FROM customer"


def raw_classes(spark: SparkSession, sf: str) -> DataFrame:
    rows = class_predictions(spark, sf)
    names = class_list(table(spark, sf, "events"), "event_type")
    return output.raw_predictions(rows, "event_id", "event_type", None, "probabilities", len(names))


CLASSES = ("click", "error", "purchase", "signup", "view")
PICK = ", ".join(
    f"round(max(rate) FILTER (class = '{c}'), 6) AS {{{i}}}" for i, c in enumerate(CLASSES)
)


def _wide_sql(*names: str) -> str:
    return f"""wide AS (SELECT cat, fold, {PICK.format(*names)} FROM rates GROUP BY cat, fold)"""


QUERIES["raw_predictions"] = lambda spark, sf: raw_classes(spark, sf).select(
    "event_id", *[F.round(f"class_{i}", 6).alias(f"class_{i}") for i in range(len(CLASSES))]
)
ORACLE["raw_predictions"] = f"""WITH {CLASS_RATES}, {_wide_sql(*[f'class_{i}' for i in range(5)])}
SELECT event_id, {', '.join(f'class_{i}' for i in range(5))} FROM src JOIN wide USING (cat, fold)"""

QUERIES["format_multi_prob"] = lambda spark, sf: output.format_predictions(
    raw_classes(spark, sf), "multiclass_prob", ["id", *CLASSES]
).select("id", *[F.round(c, 6).alias(c) for c in CLASSES])
ORACLE["format_multi_prob"] = f"""WITH {CLASS_RATES}, {_wide_sql(*CLASSES)}
SELECT event_id AS id, {', '.join(CLASSES)} FROM src JOIN wide USING (cat, fold)"""

QUERIES["format_multi_class"] = lambda spark, sf: output.format_predictions(
    raw_classes(spark, sf), "multiclass_class", EXAMPLE, "event_type",
    class_list(table(spark, sf, "events"), "event_type"),
)
ORACLE["format_multi_class"] = f"""WITH {CLASS_RATES}
SELECT event_id AS id, prediction AS target FROM predicted"""


def row_argmax(spark: SparkSession, sf: str) -> DataFrame:
    """Position of the first largest component of every embedding."""
    return table(spark, sf, "embeddings").select(
        "vec_id", metrics.argmax(F.col("embedding")).alias("best")
    )


QUERIES["row_argmax"] = row_argmax
ORACLE["row_argmax"] = """SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS best
FROM embeddings"""


def formatted_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Formatted predictions through a CSV output and its header."""
    out = output.format_predictions(raw_binary(spark, sf), "true/false", EXAMPLE)
    path = write_csv(out, scratch_path(spark, "output") + ".csv")
    names = tables.column_names(spark, path)
    return tables.read_table(spark, path, schema="id BIGINT, target BOOLEAN").select(*names)


QUERIES["formatted_csv"] = formatted_csv
ORACLE["formatted_csv"] = f"WITH {RAW_SQL} SELECT event_id AS id, p >= 0.5 AS target FROM raw"
