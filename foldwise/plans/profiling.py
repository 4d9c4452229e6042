"""Queries that scan, shape and profile tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.functions import numeric
from foldwise.operators import profile, schema
from foldwise.operators.neighbours import mutual_information_nearest
from foldwise.operators.registry import in_parallel
from foldwise.plans.fixtures import LINE_KEY, SPARSE_ORDERS, line_key, sparse_orders
from foldwise.session import scratch_path
from foldwise.sources import sinks, tables
from foldwise.sources.tables import table

QUERIES, ORACLE = {}, {}

# Columns of the given tables; arrays have no task.
COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


# --- scans, shapes, tasks -------------------------------------------------------------
def table_shapes(spark: SparkSession, sf: str) -> DataFrame:
    out = None
    for name in COLUMNS:
        shape = profile.table_shape(table(spark, sf, name)).select(
            F.lit(name).alias("table"), "n_rows", "n_columns"
        )
        out = shape if out is None else out.unionByName(shape)
    return out


QUERIES["table_shapes"] = table_shapes
ORACLE["table_shapes"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", count(*) AS n_rows,
        {len(c) + (t == 'embeddings')}::INTEGER AS n_columns FROM {t}"""
    for t, c in COLUMNS.items()
)


def task_inference(spark: SparkSession, sf: str) -> DataFrame:
    found = in_parallel([
        lambda n=n, c=c: [(n, *x) for x in schema.infer_tasks(table(spark, sf, n), c).items()]
        for n, c in COLUMNS.items()
    ], 4)
    rows = [row for part in found for row in part]
    return spark.createDataFrame(rows, "`table` STRING, column STRING, task STRING")


QUERIES["task_inference"] = task_inference
ORACLE["task_inference"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{c}' AS "column", CASE WHEN count(DISTINCT {c}) < 20
        THEN 'classification' ELSE 'regression' END AS task FROM {t}"""
    for t, cols in COLUMNS.items() for c in cols
)

QUERIES["pruned_target_scan"] = lambda spark, sf: (
    schema.drop_null_target(sparse_orders(spark, sf), "o_orderpriority")
    .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
)
ORACLE["pruned_target_scan"] = f"""WITH {SPARSE_ORDERS}
SELECT o_orderpriority, count(*) AS n FROM sparse WHERE o_orderpriority IS NOT NULL GROUP BY 1"""

QUERIES["row_capped_scan"] = lambda spark, sf: tables.first_n(
    table(spark, sf, "orders"), "o_orderkey", 12_000
).select("o_orderkey", "o_totalprice", "o_orderstatus")
ORACLE["row_capped_scan"] = """SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders
ORDER BY o_orderkey LIMIT 12000"""

QUERIES["hashed_scan"] = lambda spark, sf: tables.hashed_n(
    tables.table(spark, sf, "lineitem"), line_key(), 20_000
).select("l_orderkey", "l_linenumber", "l_extendedprice")
ORACLE["hashed_scan"] = f"""SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY substr(md5('42|' || {LINE_KEY}), 1, 13), {LINE_KEY} LIMIT 20000"""

QUERIES["hashed_share"] = lambda spark, sf: tables.hashed_share(
    table(spark, sf, "customer"), F.col("c_custkey"), 0.25
).select("c_custkey")
ORACLE["hashed_share"] = """SELECT c_custkey FROM customer
WHERE ('0x' || substr(md5('42|' || c_custkey), 1, 13))::BIGINT % 1000000 < 250000"""

ORDERS_SCHEMA = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderpriority STRING"
)


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with gaps written as CSV and read back with a schema; empty cells are NULL."""
    orders = sparse_orders(spark, sf).drop("o_orderdate")
    path = sinks.write_csv(orders, scratch_path(spark, "orders") + ".csv")
    return tables.read_table(spark, path, schema=ORDERS_SCHEMA)


QUERIES["csv_round_trip"] = csv_round_trip
ORACLE["csv_round_trip"] = f"""WITH {SPARSE_ORDERS}
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM sparse"""


def csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """Types that a CSV scan infers, seen through a profile of the columns."""
    path = sinks.write_csv(table(spark, sf, "part"), scratch_path(spark, "part") + ".csv")
    names = tables.column_names(spark, path)
    df = tables.read_table(spark, path)
    roles = schema.infer_roles(df)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("p_retailprice"), 2).alias("price")) \
        .withColumns({
            "names": F.lit(",".join(names)), "numeric": F.lit(",".join(roles.numeric)),
            "categorical": F.lit(",".join(roles.categorical)),
        })


QUERIES["csv_inferred"] = csv_inferred
ORACLE["csv_inferred"] = f"""SELECT count(*) AS n_rows, round(sum(p_retailprice), 2) AS price,
  '{','.join(COLUMNS['part'])}' AS names, 'p_partkey,p_size,p_retailprice' AS numeric,
  'p_name,p_brand,p_type' AS categorical FROM part"""


def run_log_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends with different columns land in one log."""
    events = table(spark, sf, "events")
    path = scratch_path(spark, "runs")
    log = events.select(
        F.col("user_id").cast("string").alias("experiment"), F.col("event_id").alias("iteration"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("score"),
        F.when(F.col("event_type") == "error", "failed").alias("error"),
    )
    sinks.append_runs(log.where(F.col("error").isNull()).drop("error"), path)
    sinks.append_runs(log.where(F.col("error").isNotNull()).drop("score"), path)
    return sinks.read_runs(spark, path).select("experiment", "iteration", "score", "error", "commit")


QUERIES["run_log_append"] = run_log_append
ORACLE["run_log_append"] = """SELECT user_id::VARCHAR AS experiment, event_id AS iteration,
  CASE WHEN event_type <> 'error' THEN value END AS score,
  CASE WHEN event_type = 'error' THEN 'failed' END AS error, NULL::VARCHAR AS "commit" FROM events"""


def metrics_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Mean order value as a score record per priority: written, appended and read back."""
    path = scratch_path(spark, "metrics")
    orders = table(spark, sf, "orders")
    means = orders.groupBy("o_orderpriority").agg(F.round(F.avg("o_totalprice"), 2).alias("m"))
    for row in means.orderBy("o_orderpriority").collect():
        sinks.write_metrics(spark, path, row["o_orderpriority"], row["m"])
    return sinks.read_metrics(spark, path)


QUERIES["metrics_round_trip"] = metrics_round_trip
ORACLE["metrics_round_trip"] = """SELECT o_orderpriority AS run,
  round(avg(o_totalprice), 2) AS cv_score, 'ok' AS status FROM orders GROUP BY 1"""


# --- schema ---------------------------------------------------------------------------
def cleaned_names(spark: SparkSession, sf: str) -> DataFrame:
    """Odd names cleaned, with a collision resolved by a suffix."""
    odd = table(spark, sf, "nation").toDF("n key", "n-name!", "nname")
    return schema.clean_columns(odd)


QUERIES["cleaned_names"] = cleaned_names
ORACLE["cleaned_names"] = """SELECT n_nationkey AS n_key, n_name AS nname, n_regionkey AS nname_2
FROM nation"""

SPLIT = "2000-01-01"


def aligned_test(spark: SparkSession, sf: str) -> DataFrame:
    """Later orders with a renamed, a dropped and an added column, shaped like earlier ones."""
    orders = table(spark, sf, "orders")
    train = orders.where(F.col("o_orderdate") < SPLIT)
    test = orders.where(F.col("o_orderdate") >= SPLIT).select(
        "o_orderkey", F.col("o_custkey").alias("customer"), "o_orderstatus",
        F.lit("x").alias("extra"), "o_orderpriority",
    )
    features = [c for c in train.columns if c not in ("o_orderdate", "o_orderkey")]
    return schema.align_to_train(test, features, keep=["o_orderkey"])


QUERIES["aligned_test"] = aligned_test
ORACLE["aligned_test"] = f"""SELECT o_orderkey, 0::INTEGER AS o_custkey, o_orderstatus,
  0::INTEGER AS o_totalprice, o_orderpriority FROM orders WHERE o_orderdate >= '{SPLIT}'"""


def common_projection(spark: SparkSession, sf: str) -> DataFrame:
    train = table(spark, sf, "orders")
    test = train.withColumnRenamed("o_custkey", "customer").drop("o_totalprice", "o_orderdate")
    return test.select(*schema.common_columns(train, test))


QUERIES["common_projection"] = common_projection
ORACLE["common_projection"] = "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders"

QUERIES["numeric_columns"] = lambda spark, sf: schema.select_role(
    table(spark, sf, "part"), "numeric", exclude=["p_partkey"]
)
ORACLE["numeric_columns"] = "SELECT p_size, p_retailprice FROM part"


def coerced_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Mixed text as numbers: what does not parse, and what is missing, becomes 0."""
    mixed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise(
        F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    )
    return sparse_orders(spark, sf).select(
        "o_orderkey", numeric.to_number(mixed).alias("number"),
        F.coalesce(F.col("o_orderpriority").cast("string"), F.lit("Missing")).alias("filled"),
    )


QUERIES["coerced_numbers"] = coerced_numbers
ORACLE["coerced_numbers"] = f"""WITH {SPARSE_ORDERS}
SELECT o_orderkey, coalesce(try_cast(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority
    ELSE o_totalprice::DECIMAL(18,2)::VARCHAR END AS DOUBLE), 0) AS number,
  coalesce(o_orderpriority, 'Missing') AS filled FROM sparse"""


# --- profiles -------------------------------------------------------------------------
QUERIES["profile_missing"] = lambda spark, sf: profile.missing_profile(sparse_orders(spark, sf))
ORACLE["profile_missing"] = f"WITH {SPARSE_ORDERS}, m AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_missing FROM sparse"""
    for c in COLUMNS["orders"]
) + """) SELECT *, round(n_missing * 100.0::DOUBLE / n_rows, 2) AS pct_missing FROM m
WHERE n_missing * 100.0 / n_rows >= 0.005"""

QUERIES["target_profile_class"] = lambda spark, sf: profile.class_distribution(
    table(spark, sf, "events"), "event_type"
)
ORACLE["target_profile_class"] = """WITH c AS (
  SELECT event_type AS class, count(*) AS n FROM events GROUP BY 1),
p AS (SELECT *, round(n * 100.0::DOUBLE / (SELECT sum(n) FROM c), 2) AS pct FROM c)
SELECT class, n, pct, printf('%d (%.2f%%)', n, pct) AS text FROM p"""

QUERIES["target_profile_number"] = lambda spark, sf: profile.target_stats(
    sparse_orders(spark, sf), "o_totalprice"
)
ORACLE["target_profile_number"] = f"""WITH {SPARSE_ORDERS}
SELECT min(o_totalprice) AS min, max(o_totalprice) AS max, round(avg(o_totalprice), 4) AS mean,
  round(skewness(o_totalprice), 4) AS skew FROM sparse"""

LINE_NUMBERS = ("l_quantity", "l_discount", "l_tax", "l_linenumber", "l_orderkey", "l_partkey",
                "l_suppkey")


def _corr_sql(target: str, source: str, cols) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", corr({c}::DOUBLE, {target}) AS corr FROM {source}""" for c in cols
    )


QUERIES["corr_to_target"] = lambda spark, sf: profile.correlations(
    table(spark, sf, "lineitem"), "l_extendedprice"
).select("column", F.round("corr", 6).alias("corr"))
ORACLE["corr_to_target"] = f"""WITH c AS ({_corr_sql('l_extendedprice', 'lineitem', LINE_NUMBERS)})
SELECT "column", round(corr, 6) AS corr FROM c"""


def corr_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Pairwise-complete correlation; a constant column has none."""
    orders = sparse_orders(spark, sf).withColumns({
        "constant": F.lit(1.0), "key_gaps": F.when(F.col("o_orderstatus").isNotNull(), F.col("o_custkey")),
    })
    return profile.correlations(orders, "o_totalprice").select(
        "column", F.round("corr", 6).alias("corr")
    )


QUERIES["corr_with_gaps"] = corr_with_gaps
ORACLE["corr_with_gaps"] = f"""WITH {SPARSE_ORDERS},
g AS (SELECT *, CASE WHEN o_orderstatus IS NOT NULL THEN o_custkey END AS key_gaps FROM sparse),
c AS ({_corr_sql('o_totalprice', 'g', ('o_orderkey', 'o_custkey', 'key_gaps'))})
SELECT "column", round(corr, 6) AS corr FROM c UNION ALL SELECT 'constant', NULL"""

QUERIES["corr_encoded_target"] = lambda spark, sf: profile.correlations(
    sparse_orders(spark, sf), "o_orderpriority"
).select("column", F.round("corr", 6).alias("corr"))
ORACLE["corr_encoded_target"] = f"""WITH {SPARSE_ORDERS},
top AS (SELECT o_orderpriority AS m FROM sparse WHERE o_orderpriority IS NOT NULL GROUP BY 1
        ORDER BY count(*) DESC, 1 LIMIT 1),
f AS (SELECT * REPLACE (coalesce(o_orderpriority, (SELECT m FROM top)) AS o_orderpriority) FROM sparse),
e AS (SELECT *, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::DOUBLE AS code FROM f),
c AS ({_corr_sql('code', 'e', ('o_orderkey', 'o_custkey', 'o_totalprice'))})
SELECT "column", round(corr, 6) AS corr FROM c"""

QUERIES["corr_top_bottom"] = lambda spark, sf: profile.top_bottom(
    profile.correlations(table(spark, sf, "lineitem"), "l_extendedprice"), "corr"
).withColumn("corr", F.round("corr", 4))
ORACLE["corr_top_bottom"] = f"""WITH c AS ({_corr_sql('l_extendedprice', 'lineitem', LINE_NUMBERS)}),
r AS (
  SELECT 'top' AS side, row_number() OVER (ORDER BY corr DESC, "column") AS rank, * FROM c
  UNION ALL
  SELECT 'bottom', row_number() OVER (ORDER BY corr, "column" DESC), * FROM c)
SELECT side, rank::INTEGER AS rank, "column", round(corr, 4) AS corr,
  CASE WHEN corr > 0 THEN 'positive' WHEN corr < 0 THEN 'negative' ELSE 'zero' END AS sign
FROM r WHERE rank <= 5"""


def _mi_sql(parts: str) -> str:
    return f"""tall AS ({parts}),
n AS (SELECT "column", count(*)::DOUBLE AS n FROM tall GROUP BY 1),
xy AS (SELECT "column", value, y, count(*)::DOUBLE AS c FROM tall GROUP BY ALL),
x AS (SELECT "column", value, sum(c) AS c FROM xy GROUP BY ALL),
y_ AS (SELECT "column", y, sum(c) AS c FROM xy GROUP BY ALL),
mi AS (
  SELECT xy."column", sum(xy.c / n.n * ln((xy.c / n.n) / ((x.c / n.n) * (y_.c / n.n)))) AS mi
  FROM xy JOIN n USING ("column") JOIN x ON x."column" = xy."column" AND x.value = xy.value
  JOIN y_ ON y_."column" = xy."column" AND y_.y = xy.y GROUP BY 1)
SELECT "column", round(mi, 6) AS mi FROM mi ORDER BY mi DESC, "column" LIMIT 10"""


def _top_mi(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("mi"), "column").limit(10).select("column", F.round("mi", 6).alias("mi"))


def mutual_info_class(spark: SparkSession, sf: str) -> DataFrame:
    """Categorical columns of documents against a text label with gaps."""
    labels = table(spark, sf, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "good").otherwise("poor").alias("quality")
    )
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source").join(
        labels, "doc_id", "left"
    )
    return _top_mi(profile.mutual_information(docs, ["lang", "source"], "quality"))


QUERIES["mutual_info_class"] = mutual_info_class
ORACLE["mutual_info_class"] = f"""WITH d AS (
  SELECT lang, source, CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END AS q
  FROM documents LEFT JOIN labels USING (doc_id)),
top AS (SELECT q FROM d WHERE q IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
f AS (SELECT lang, source, coalesce(q, (SELECT q FROM top)) AS y FROM d),
""" + _mi_sql("""SELECT 'lang' AS "column", lang AS value, y FROM f
  UNION ALL SELECT 'source', source, y FROM f""")

QUERIES["mutual_info_number"] = lambda spark, sf: _top_mi(profile.mutual_information(
    sparse_orders(spark, sf), ["o_orderstatus", "o_orderpriority"], "o_totalprice"
))
ORACLE["mutual_info_number"] = f"""WITH {SPARSE_ORDERS},
f AS (SELECT * REPLACE (coalesce(o_totalprice, 0) AS o_totalprice) FROM sparse),
q AS (SELECT quantile_cont(o_totalprice, [{', '.join(f'{i / 10}::DOUBLE' for i in range(1, 10))}]) AS q FROM f),
b AS (SELECT f.*, list_sum(list_transform(list_distinct(q.q), lambda v: (o_totalprice >= v)::INT)) AS y
      FROM f, q),
""" + _mi_sql("""SELECT 'o_orderstatus' AS "column", coalesce(o_orderstatus, 'Missing') AS value, y FROM b
  UNION ALL SELECT 'o_orderpriority', coalesce(o_orderpriority, 'Missing'), y FROM b""")

def mutual_info_nearest(spark: SparkSession, sf: str) -> DataFrame:
    """Categories against the price in whole cents, by nearest neighbours."""
    cents = sparse_orders(spark, sf).withColumn("o_totalprice", F.round(F.col("o_totalprice") * 100))
    found = mutual_information_nearest(cents, ["o_orderstatus", "o_orderpriority"], "o_totalprice")
    return found.withColumn("mi", F.round("mi", 6))


def _psi(x: str) -> str:
    """SQL for the digamma function: lifted by 8, then its asymptotic series."""
    z = f"({x} + 8)::DOUBLE"
    lift = " - ".join(f"1 / ({x} + {i})::DOUBLE" for i in range(8))
    return f"(ln({z}) - 1 / (2 * {z}) - 1 / (12 * pow({z}, 2)) + 1 / (120 * pow({z}, 4)) - 1 / (252 * pow({z}, 6)) - {lift})"


QUERIES["mutual_info_nearest"] = mutual_info_nearest
ORACLE["mutual_info_nearest"] = f"""WITH {SPARSE_ORDERS},
f AS (SELECT coalesce(o_orderstatus, 'Missing') AS s, coalesce(o_orderpriority, 'Missing') AS p,
  coalesce(round(o_totalprice * 100), 0) AS y FROM sparse),
tall AS (SELECT 'o_orderstatus' AS "column", s AS x, y FROM f UNION ALL SELECT 'o_orderpriority', p, y FROM f),
near AS (SELECT "column", x, y, count(*) OVER (PARTITION BY "column", x) AS size,
  [y - lag(y, 1) OVER w, y - lag(y, 2) OVER w, y - lag(y, 3) OVER w, lead(y, 1) OVER w - y, lead(y, 2) OVER w - y, lead(y, 3) OVER w - y] AS ds
  FROM tall WINDOW w AS (PARTITION BY "column", x ORDER BY y)),
reach AS (SELECT "column", x, y, size, least(3, size - 1) AS k,
  list_sort(list_filter(ds, lambda v: v IS NOT NULL))[least(3, size - 1)] AS d FROM near WHERE size > 1),
held AS (SELECT "column", y, count(*) AS n FROM reach GROUP BY ALL),
asked AS (SELECT "column", x, y, d, size, k, count(*) AS w FROM reach GROUP BY ALL),
met AS (SELECT a."column", a.x, a.y, a.d, a.size, a.k, a.w, sum(h.n) AS m FROM asked a JOIN held h
  ON h."column" = a."column" AND h.y >= a.y - a.d AND h.y <= a.y + a.d
  WHERE abs(h.y - a.y) < a.d OR h.y = a.y GROUP BY ALL)
SELECT "column", round(greatest(0, {_psi('sum(w)')} + sum(w * ({_psi('k')} - {_psi('size')} - {_psi('m')})) / sum(w)), 6) AS mi
FROM met GROUP BY "column" """

QUERIES["category_samples"] = lambda spark, sf: profile.value_samples(
    table(spark, sf, "part"), ["p_name", "p_brand", "p_type"]
)
ORACLE["category_samples"] = """WITH tall AS (
  SELECT 'p_name' AS "column", p_name AS value FROM part
  UNION ALL SELECT 'p_brand', p_brand FROM part UNION ALL SELECT 'p_type', p_type FROM part),
c AS (SELECT "column", value, count(*) AS n FROM tall GROUP BY ALL)
SELECT *, (row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value))::INTEGER AS rank FROM c
QUALIFY rank <= 5"""

QUERIES["seeded_sample"] = lambda spark, sf: profile.seeded_sample(
    table(spark, sf, "customer"), F.col("c_custkey")
)
ORACLE["seeded_sample"] = "SELECT * FROM customer ORDER BY md5('42|' || c_custkey), c_custkey LIMIT 5"


def profile_report(spark: SparkSession, sf: str) -> DataFrame:
    """The long-form profile of customers with the segment as target."""
    customers = table(spark, sf, "customer").withColumn(
        "c_nationkey", F.when(F.pmod(F.col("c_custkey"), F.lit(8)) != 0, F.col("c_nationkey"))
    )
    return profile.profile_report(customers, "c_mktsegment", F.col("c_custkey"))


QUERIES["profile_report"] = profile_report
ORACLE["profile_report"] = f"""WITH t AS (
  SELECT * REPLACE (CASE WHEN c_custkey % 8 <> 0 THEN c_nationkey END AS c_nationkey) FROM customer),
classes AS (SELECT c_mktsegment AS class, count(*) AS n FROM t GROUP BY 1),
coded AS (SELECT *, (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::DOUBLE AS code FROM t),
c AS ({_corr_sql('code', 'coded', ('c_custkey', 'c_nationkey', 'c_acctbal'))}),
ends AS (
  SELECT 'top' AS side, row_number() OVER (ORDER BY corr DESC, "column") AS rank, * FROM c
  UNION ALL SELECT 'bottom', row_number() OVER (ORDER BY corr, "column" DESC), * FROM c),
names AS (
  SELECT c_name AS value, count(*) AS n,
    row_number() OVER (ORDER BY count(*) DESC, c_name) AS rank FROM t GROUP BY 1),
size AS (SELECT count(*) AS n FROM t),
mi AS (
  SELECT (SELECT -sum(n::DOUBLE / (SELECT n FROM size) * ln(n::DOUBLE / (SELECT n FROM size)))
          FROM classes) AS mi)
SELECT 'overview' AS section, 'rows' AS item, count(*)::VARCHAR AS value FROM t
UNION ALL SELECT 'overview', 'columns', '5'
UNION ALL SELECT 'overview', 'target', 'c_mktsegment'
UNION ALL SELECT 'target', 'task', 'classification'
UNION ALL SELECT 'target', class, printf('%d (%.2f%%)', n,
  round(n * 100.0::DOUBLE / (SELECT n FROM size), 2)) FROM classes
UNION ALL SELECT 'correlation', side || ' ' || rank || ' ' || "column", printf('%.4f', round(corr, 4))
  FROM ends WHERE rank <= 5
UNION ALL SELECT 'mutual_info', 'c_name', printf('%.4f', round(mi, 4)) FROM mi
UNION ALL SELECT 'samples', 'c_name ' || rank, value FROM names WHERE rank <= 5
UNION ALL SELECT 'missing', 'c_nationkey',
  printf('%.2f', round(count(*) FILTER (c_nationkey IS NULL) * 100.0::DOUBLE / count(*), 2)) FROM t
UNION ALL SELECT * FROM (SELECT 'sample', c_custkey::VARCHAR, '{{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"'
  || CASE WHEN c_nationkey IS NULL THEN '' ELSE ',"c_nationkey":' || c_nationkey END
  || ',"c_acctbal":' || c_acctbal || ',"c_mktsegment":"' || c_mktsegment || '"}}'
  FROM t ORDER BY md5('42|' || c_custkey), c_custkey LIMIT 5)"""
