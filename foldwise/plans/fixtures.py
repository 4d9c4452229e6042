"""Inputs that Spark derives from the given tables, with the same derivation as SQL text.

``lineitem`` has no natural key; the five columns of its key identify a row at every scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.functions.hashing import hash32, row_key
from foldwise.operators import encode, folds, ordered
from foldwise.session import materialise
from foldwise.sources.tables import table

FOLDS = 5


def line_key() -> Column:
    return row_key(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(F.col("l_extendedprice") * 100).cast("bigint"),
    )


LINE_KEY = (
    "(l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey || '|' || "
    "CAST(round(l_extendedprice * 100) AS BIGINT))"
)


def sql_hash(key: str, salt: object = 42) -> str:
    return f"('0x' || substr(md5('{salt}|' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT"


def sql_fold(key: str, k: int = FOLDS) -> str:
    return f"CAST({sql_hash(key)} % {k} AS INTEGER)"


def lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").withColumn("key", line_key())


# --- missing values -------------------------------------------------------------------
def gaps(col: str, key: str, every: int) -> Column:
    return F.when(F.pmod(hash32(F.col(key), col), F.lit(every)) != 0, F.col(col)).alias(col)


def sql_gaps(col: str, key: str, every: int) -> str:
    return f"CASE WHEN {sql_hash(key, col)} % {every} <> 0 THEN {col} END AS {col}"


def sparse_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", gaps("o_orderstatus", "o_orderkey", 11),
        gaps("o_totalprice", "o_orderkey", 7), "o_orderdate",
        gaps("o_orderpriority", "o_orderkey", 11),
    )


SPARSE_ORDERS = f"""sparse AS (
  SELECT o_orderkey, o_custkey, {sql_gaps('o_orderstatus', 'o_orderkey', 11)},
         {sql_gaps('o_totalprice', 'o_orderkey', 7)}, o_orderdate,
         {sql_gaps('o_orderpriority', 'o_orderkey', 11)}
  FROM orders)"""


# --- binary predictions ---------------------------------------------------------------
def scored_counts(spark: SparkSession, sf: str) -> DataFrame:
    """``(model, fold, cat, label, score, n)``: two out-of-fold predictors of a returned line.

    A prediction depends on the category and the fold only, so lines are counted once by
    both categories and everything after works on the counts.
    """
    lines = lineitem(spark, sf).dropna(subset=["l_returnflag"])
    cells = lines.groupBy(
        folds.fold_of(F.col("key"), FOLDS).alias("fold"),
        F.col("l_linestatus").alias("status"), F.month("l_shipdate").cast("string").alias("month"),
    ).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("s"))
    models = F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(c).alias("cat"))
        for m, c in (("line_status", "status"), ("ship_month", "month"))
    ])
    counts = (
        cells.select(F.explode(models).alias("x"), "fold", "n", "s").select("x.*", "fold", "n", "s")
        .groupBy("model", "cat", "fold").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    )
    scored = materialise(encode.encoding_by_fold(counts, ["model"], "cat", "fold", name="score"))
    labels = F.array(
        F.struct(F.lit(1).alias("label"), F.col("s").alias("n")),
        F.struct(F.lit(0).alias("label"), (F.col("n") - F.col("s")).alias("n")),
    )
    return (
        scored.select("model", "fold", "cat", "score", F.explode(labels).alias("x"))
        .select("model", "fold", "cat", "score", "x.label", "x.n").where(F.col("n") > 0)
    )


SCORED_ROWS = f"""lines AS (
  SELECT {sql_fold(LINE_KEY)} AS fold, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
         l_linestatus AS status, CAST(month(l_shipdate) AS VARCHAR) AS ship_month
  FROM lineitem WHERE l_returnflag IS NOT NULL),
tall AS (
  SELECT 'line_status' AS model, status AS cat, fold, label FROM lines
  UNION ALL SELECT 'ship_month', ship_month, fold, label FROM lines),
cells AS (SELECT model, cat, fold, count(*) AS n, sum(label) AS s FROM tall GROUP BY ALL),
cats AS (SELECT model, cat, sum(n) AS n, sum(s) AS s FROM cells GROUP BY ALL),
by_fold AS (SELECT model, fold, sum(n) AS n, sum(s) AS s FROM cells GROUP BY ALL),
whole AS (SELECT model, sum(n) AS n, sum(s) AS s FROM cells GROUP BY ALL),
encoded AS (
  SELECT c.model, c.cat, c.fold,
         ((t.s - c.s)::DOUBLE + 10.0::DOUBLE * ((w.s - f.s)::DOUBLE / (w.n - f.n)::DOUBLE))
         / ((t.n - c.n)::DOUBLE + 10.0::DOUBLE) AS score
  FROM cells c JOIN cats t USING (model, cat) JOIN by_fold f USING (model, fold)
  JOIN whole w USING (model)),
scored AS (
  SELECT t.model, t.fold, t.cat, t.label, e.score FROM tall t JOIN encoded e USING (model, cat, fold))"""


# --- multi-class predictions ----------------------------------------------------------
def class_list(df: DataFrame, target: str, limit: int = 1000) -> list:
    """Sorted classes of a target; a class target with more than ``limit`` of them is an error."""
    rows = df.select(target).where(F.col(target).isNotNull()).distinct().take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"{target} has more than {limit} classes")
    return sorted(r[0] for r in rows)


def class_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """``(event_id, fold, label, probabilities, prediction)``: class rates by hour, out of fold."""
    events = table(spark, sf, "events").select(
        "event_id", F.hour("ts").alias("cat"), F.col("event_type").alias("label"),
        folds.fold_of(F.col("event_id"), FOLDS).alias("fold"),
    )
    names = class_list(events, "label")
    cells = materialise(events.groupBy("cat", "fold").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("label") == c).alias(f"s{i}") for i, c in enumerate(names)],
    ))
    each = F.array(*[
        F.struct(F.lit(i).alias("class"), F.col(f"s{i}").alias("s")) for i in range(len(names))
    ])
    counts = cells.select("cat", "fold", "n", F.explode(each).alias("x")).select(
        "cat", "fold", "n", "x.*"
    )
    rates = encode.encoding_by_fold(counts, ["class"], "cat", "fold", name="rate")
    ordered_rates = F.array_sort(F.collect_list(F.struct("class", "rate")))
    rates = rates.groupBy("cat", "fold").agg(
        F.transform(ordered_rates, lambda x: x["rate"]).alias("probabilities"),
        F.max("n").alias("n"),
    )
    out = ordered.lookup_join(events, rates, ["cat", "fold"], "n")
    best = F.array_position("probabilities", F.array_max("probabilities")) - 1
    return out.select(
        "event_id", "fold", "label", "probabilities",
        F.get(F.array(*[F.lit(c) for c in names]), best.cast("int")).alias("prediction"),
    )


CLASS_RATES = f"""src AS (
  SELECT event_id, hour(ts) AS cat, event_type AS label, {sql_fold('event_id')} AS fold FROM events),
names AS (SELECT DISTINCT label AS class FROM src),
cell_n AS (SELECT cat, fold, count(*) AS n FROM src GROUP BY ALL),
cell_s AS (SELECT cat, fold, label AS class, count(*) AS s FROM src GROUP BY ALL),
grid AS (
  SELECT n.cat, n.fold, c.class, n.n, coalesce(s.s, 0) AS s
  FROM cell_n n CROSS JOIN names c LEFT JOIN cell_s s
    ON s.cat = n.cat AND s.fold = n.fold AND s.class = c.class),
cat_t AS (SELECT class, cat, sum(n) AS n, sum(s) AS s FROM grid GROUP BY ALL),
fold_t AS (SELECT class, fold, sum(n) AS n, sum(s) AS s FROM grid GROUP BY ALL),
all_t AS (SELECT class, sum(n) AS n, sum(s) AS s FROM grid GROUP BY ALL),
rates AS (
  SELECT g.cat, g.fold, g.class,
         ((t.s - g.s)::DOUBLE + 10.0::DOUBLE * ((a.s - f.s)::DOUBLE / (a.n - f.n)::DOUBLE))
         / ((t.n - g.n)::DOUBLE + 10.0::DOUBLE) AS rate
  FROM grid g JOIN cat_t t USING (class, cat) JOIN fold_t f USING (class, fold)
  JOIN all_t a USING (class)),
best AS (
  SELECT cat, fold, class AS prediction FROM rates
  QUALIFY row_number() OVER (PARTITION BY cat, fold ORDER BY rate DESC, class) = 1),
predicted AS (
  SELECT s.event_id, s.fold, s.label, b.prediction, s.cat
  FROM src s JOIN best b USING (cat, fold))"""


# --- regression predictions -----------------------------------------------------------
def price_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """``(o_orderkey, fold, label, prediction)``: out-of-fold price mean by priority."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("cat"), F.col("o_totalprice").alias("label"),
        folds.fold_of(F.col("o_orderkey"), FOLDS).alias("fold"),
    )
    out = encode.target_encode_oof(orders, "cat", "label", name="prediction")
    return out.select("o_orderkey", "fold", "label", "prediction")


PRICE_ROWS = f"""src AS (
  SELECT o_orderkey, o_orderpriority AS cat, o_totalprice AS label,
         {sql_fold('o_orderkey')} AS fold FROM orders),
cells AS (SELECT cat, fold, count(*) AS n, sum(label) AS s FROM src GROUP BY ALL),
cats AS (SELECT cat, sum(n) AS n, sum(s) AS s FROM cells GROUP BY ALL),
by_fold AS (SELECT fold, sum(n) AS n, sum(s) AS s FROM cells GROUP BY ALL),
whole AS (SELECT sum(n) AS n, sum(s) AS s FROM cells),
encoded AS (
  SELECT c.cat, c.fold, ((t.s - c.s) + 10.0::DOUBLE * ((w.s - f.s) / (w.n - f.n)))
         / ((t.n - c.n) + 10.0::DOUBLE) AS prediction
  FROM cells c JOIN cats t USING (cat) JOIN by_fold f USING (fold) CROSS JOIN whole w),
priced AS (
  SELECT s.o_orderkey, s.fold, s.label, e.prediction FROM src s JOIN encoded e USING (cat, fold))"""


# --- run log --------------------------------------------------------------------------
TIMED_OUT, FAILED = "Script Execution Timed Out", "Script Execution Failed"


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Events as experiment runs of a user, numbered by time."""
    events = table(spark, sf, "events")
    failed = F.col("event_type") == "error"
    kind = F.when(F.pmod("event_id", F.lit(2)) == 1, TIMED_OUT).otherwise(FAILED)
    numbered = ordered.row_number_in_group(
        events.withColumn("experiment", F.col("user_id")), ["experiment"], ["ts", "event_id"],
        "iteration",
    )
    return numbered.select(
        "experiment", "iteration", "event_id", F.when(~failed, F.col("value") / 100).alias("score"),
        F.when(failed, kind).alias("error"), F.col("event_type").alias("agent_reasoning"),
        ordered.CHUNK,
    )


RUNS = f"""runs AS (
  SELECT user_id AS experiment, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
           AS iteration, event_id,
         CASE WHEN event_type <> 'error' THEN value / 100::DOUBLE END AS score,
         CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 1 THEN '{TIMED_OUT}'
              ELSE '{FAILED}' END END AS error,
         event_type AS agent_reasoning
  FROM events),
judged AS (
  SELECT *, greatest(0.0::DOUBLE, max(score) OVER (
           PARTITION BY experiment ORDER BY iteration
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS best_before
  FROM runs),
improved AS (
  SELECT *, coalesce(score > best_before, score IS NOT NULL) AS improved FROM judged)"""
