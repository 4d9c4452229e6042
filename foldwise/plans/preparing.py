"""Queries that assign folds and prepare features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators import encode, folds, preprocess, select
from foldwise.plans.fixtures import (
    FOLDS, LINE_KEY, SPARSE_ORDERS, lineitem, sparse_orders, sql_fold,
)
from foldwise.sources.tables import table

QUERIES, ORACLE = {}, {}


def _round(df: DataFrame, cols, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


# --- folds ----------------------------------------------------------------------------
QUERIES["kfold"] = lambda spark, sf: folds.kfold(lineitem(spark, sf), F.col("key")).select("key", "fold")
ORACLE["kfold"] = f"SELECT {LINE_KEY} AS key, {sql_fold(LINE_KEY)} AS fold FROM lineitem"

QUERIES["kfold_three_sizes"] = lambda spark, sf: folds.fold_sizes(
    folds.kfold(lineitem(spark, sf), F.col("key"), 3), ["l_returnflag"]
)
ORACLE["kfold_three_sizes"] = f"""SELECT {sql_fold(LINE_KEY, 3)} AS fold, l_returnflag, count(*) AS n
FROM lineitem GROUP BY ALL"""

QUERIES["stratified_kfold"] = lambda spark, sf: folds.stratified_kfold(
    table(spark, sf, "events"), "event_type", F.col("event_id").cast("string")
).select("event_id", "event_type", "fold")
ORACLE["stratified_kfold"] = """SELECT event_id, event_type,
  ((row_number() OVER (PARTITION BY event_type ORDER BY md5('42|' || event_id), event_id::VARCHAR) - 1)
   % 5)::INTEGER AS fold FROM events"""

QUERIES["group_kfold"] = lambda spark, sf: folds.group_kfold(
    table(spark, sf, "events"), "user_id"
).select("event_id", "user_id", "fold")
ORACLE["group_kfold"] = f"SELECT event_id, user_id, {sql_fold('user_id')} AS fold FROM events"

QUERIES["time_split"] = lambda spark, sf: folds.time_blocks(
    lineitem(spark, sf), "l_shipdate"
).groupBy("block").agg(
    F.count(F.lit(1)).alias("n"), F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("first_day"),
    F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("last_day"),
)
ORACLE["time_split"] = f"""WITH q AS (
  SELECT quantile_cont(epoch_us(l_shipdate)::DOUBLE,
    [{', '.join(f'{i}::DOUBLE / 6' for i in range(1, 6))}]) AS q FROM lineitem),
b AS (SELECT l_shipdate, list_sum(list_transform(q, lambda v: (epoch_us(l_shipdate)::DOUBLE > v)::INT))
        ::INTEGER AS block FROM lineitem, q)
SELECT block, count(*) AS n, strftime(min(l_shipdate), '%Y-%m-%d') AS first_day,
  strftime(max(l_shipdate), '%Y-%m-%d') AS last_day FROM b GROUP BY block"""

QUERIES["stratified_split"] = lambda spark, sf: folds.stratified_split(
    table(spark, sf, "orders"), "o_orderpriority", F.col("o_orderkey").cast("string"), 0.2
).select("o_orderkey", "is_test")
ORACLE["stratified_split"] = """WITH p AS (SELECT o_orderkey, row_number() OVER (
  PARTITION BY o_orderpriority ORDER BY md5('42|' || o_orderkey), o_orderkey::VARCHAR) AS p FROM orders)
SELECT o_orderkey, (p * 200) // 1000 > ((p - 1) * 200) // 1000 AS is_test FROM p"""

# --- imputation -----------------------------------------------------------------------
QUERIES["impute_median"] = lambda spark, sf: preprocess.NumericPreparer(
    ["o_totalprice"], "median", None
).fit(sparse_orders(spark, sf)).transform(sparse_orders(spark, sf)).select(
    "o_orderkey", F.round("o_totalprice", 4).alias("o_totalprice")
)
ORACLE["impute_median"] = f"""WITH {SPARSE_ORDERS}
SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM sparse)), 4)
  AS o_totalprice FROM sparse"""

QUERIES["impute_mean"] = lambda spark, sf: preprocess.NumericPreparer(
    ["o_totalprice"], "mean", None
).fit(sparse_orders(spark, sf)).transform(sparse_orders(spark, sf)).select(
    "o_orderkey", F.round("o_totalprice", 4).alias("o_totalprice")
)
ORACLE["impute_mean"] = f"""WITH {SPARSE_ORDERS}
SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM sparse)), 4)
  AS o_totalprice FROM sparse"""

QUERIES["impute_mode"] = lambda spark, sf: preprocess.CategoryImputer(
    ["o_orderstatus", "o_orderpriority"]
).fit(sparse_orders(spark, sf)).transform(sparse_orders(spark, sf)).select(
    "o_orderkey", "o_orderstatus", "o_orderpriority"
)
ORACLE["impute_mode"] = f"""WITH {SPARSE_ORDERS},
a AS (SELECT o_orderstatus AS v FROM sparse WHERE o_orderstatus IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
b AS (SELECT o_orderpriority AS v FROM sparse WHERE o_orderpriority IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT o_orderkey, coalesce(o_orderstatus, (SELECT v FROM a)) AS o_orderstatus,
  coalesce(o_orderpriority, (SELECT v FROM b)) AS o_orderpriority FROM sparse"""


def impute_constant(spark: SparkSession, sf: str) -> DataFrame:
    orders = sparse_orders(spark, sf)
    flags = {f"{c}_missing": preprocess.missing_indicator(c) for c in ("o_totalprice", "o_orderstatus")}
    filled = preprocess.CategoryImputer(["o_orderstatus"], "constant").fit(orders)
    return filled.transform(orders.withColumns(flags)).select("o_orderkey", "o_orderstatus", *flags)


QUERIES["impute_constant"] = impute_constant
ORACLE["impute_constant"] = f"""WITH {SPARSE_ORDERS}
SELECT o_orderkey, coalesce(o_orderstatus, 'missing') AS o_orderstatus,
  (o_totalprice IS NULL)::INTEGER AS o_totalprice_missing,
  (o_orderstatus IS NULL)::INTEGER AS o_orderstatus_missing FROM sparse"""

# --- scaling --------------------------------------------------------------------------
SCALED = ("l_quantity", "l_extendedprice", "l_discount")


def _scaled(kind):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        lines = lineitem(spark, sf)
        model = preprocess.NumericPreparer(SCALED, None, kind).fit(lines)
        return _round(model.transform(lines).select("key", *SCALED), SCALED)
    return query


def _scaled_sql(center: str, spread: str) -> str:
    stats = ", ".join(
        f"{center.format(c=c)} AS a_{c}, {spread.format(c=c)} AS b_{c}" for c in SCALED
    )
    cols = ", ".join(f"round(({c} - a_{c}) / coalesce(nullif(b_{c}, 0), 1), 6) AS {c}" for c in SCALED)
    return f"WITH s AS (SELECT {stats} FROM lineitem) SELECT {LINE_KEY} AS key, {cols} FROM lineitem, s"


QUERIES["scale_standard"] = _scaled("standard")
ORACLE["scale_standard"] = _scaled_sql("avg({c})", "stddev_pop({c})")
QUERIES["scale_minmax"] = _scaled("minmax")
ORACLE["scale_minmax"] = _scaled_sql("min({c})", "max({c}) - min({c})")
QUERIES["scale_robust"] = _scaled("robust")
ORACLE["scale_robust"] = _scaled_sql(
    "quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"
)


def scale_standard_oof(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with gaps, mean-filled and scaled by the statistics of the other folds."""
    orders = folds.kfold(sparse_orders(spark, sf), F.col("o_orderkey"))
    fitted = preprocess.fit_scaling_by_fold(orders, ["o_totalprice"])
    return preprocess.scale_by_fold(orders, fitted).select(
        "o_orderkey", "fold", F.round("o_totalprice", 6).alias("o_totalprice")
    )


QUERIES["scale_standard_oof"] = scale_standard_oof
ORACLE["scale_standard_oof"] = f"""WITH {SPARSE_ORDERS},
f AS (SELECT *, {sql_fold('o_orderkey')} AS fold FROM sparse),
ids AS (SELECT DISTINCT fold AS held FROM f),
m AS (SELECT held, avg(o_totalprice) AS mean FROM ids JOIN f ON f.fold <> held GROUP BY 1),
s AS (SELECT held, any_value(mean) AS mean, stddev_pop(coalesce(o_totalprice, mean)) AS std
      FROM m JOIN f ON f.fold <> held GROUP BY 1)
SELECT o_orderkey, fold, round((coalesce(o_totalprice, mean) - mean) / std, 6) AS o_totalprice
FROM f JOIN s ON s.held = f.fold"""


def impute_median_oof(spark: SparkSession, sf: str) -> DataFrame:
    """Training median of every fold in one search: a fold's median is a masked column."""
    from foldwise.operators.ordered import exact_quantiles

    orders = folds.kfold(sparse_orders(spark, sf), F.col("o_orderkey"))
    masks = {str(i): F.when(F.col("fold") != i, F.col("o_totalprice")) for i in range(FOLDS)}
    medians = exact_quantiles(orders, masks, [0.5])
    fill = F.lit(None).cast("double")
    for i in range(FOLDS):
        fill = F.when(F.col("fold") == i, F.lit(medians[str(i)][0])).otherwise(fill)
    return orders.select(
        "o_orderkey", "fold", F.round(F.coalesce("o_totalprice", fill), 4).alias("o_totalprice")
    )


QUERIES["impute_median_oof"] = impute_median_oof
ORACLE["impute_median_oof"] = f"""WITH {SPARSE_ORDERS},
f AS (SELECT *, {sql_fold('o_orderkey')} AS fold FROM sparse),
ids AS (SELECT DISTINCT fold AS held FROM f),
m AS (SELECT held, quantile_cont(o_totalprice, 0.5) AS mid FROM ids JOIN f ON f.fold <> held GROUP BY 1)
SELECT o_orderkey, fold, round(coalesce(o_totalprice, mid), 4) AS o_totalprice
FROM f JOIN m ON held = fold"""

QUERIES["normalize_rows"] = lambda spark, sf: table(spark, sf, "embeddings").select(
    "vec_id", F.posexplode(preprocess.normalise_rows(F.col("embedding"))).alias("pos", "v")
).select("vec_id", "pos", F.round("v", 5).alias("v"))
ORACLE["normalize_rows"] = """WITH e AS (
  SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1)::INTEGER - 1 AS pos
  FROM embeddings),
n AS (SELECT vec_id, sqrt(sum(v * v)) AS n FROM e GROUP BY 1)
SELECT vec_id, pos, round(v / n, 5) AS v FROM e JOIN n USING (vec_id)"""

# --- encoding -------------------------------------------------------------------------
HELD = "Brand#13"


def onehot_unseen(spark: SparkSession, sf: str) -> DataFrame:
    """Brands fitted without one of them: its parts get only zeros. Active cells, long form."""
    part = table(spark, sf, "part")
    model = encode.OneHot(["p_brand", "p_type"]).fit(part.where(F.col("p_brand") != HELD))
    cells = F.array(*[
        F.struct(F.lit(n).alias("feature"), c.alias("value")) for n, c in model.columns().items()
    ])
    return part.select("p_partkey", F.explode(cells).alias("x")).select("p_partkey", "x.*").where(
        F.col("value") == 1
    )


QUERIES["onehot_unseen"] = onehot_unseen
ORACLE["onehot_unseen"] = f"""WITH train AS (SELECT * FROM part WHERE p_brand <> '{HELD}')
SELECT p_partkey, 'p_brand_' || p_brand AS feature, 1::INTEGER AS value FROM part
WHERE p_brand IN (SELECT p_brand FROM train)
UNION ALL SELECT p_partkey, 'p_type_' || p_type, 1 FROM part WHERE p_type IN (SELECT p_type FROM train)"""


def ordinal_unseen(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    return encode.ordinal_encode(
        part.where(F.col("p_brand") != HELD), part, ["p_brand", "p_type"]
    ).select("p_partkey", "p_brand_code", "p_type_code")


QUERIES["ordinal_unseen"] = ordinal_unseen
ORACLE["ordinal_unseen"] = f"""WITH train AS (SELECT * FROM part WHERE p_brand <> '{HELD}'),
b AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS code
      FROM (SELECT DISTINCT p_brand FROM train)),
t AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS code
      FROM (SELECT DISTINCT p_type FROM train))
SELECT p_partkey, coalesce(b.code, -1)::INTEGER AS p_brand_code, coalesce(t.code, -1)::INTEGER AS p_type_code
FROM part LEFT JOIN b USING (p_brand) LEFT JOIN t USING (p_type)"""


def ordinal_names(spark: SparkSession, sf: str) -> DataFrame:
    """Codes of a column with one value per row."""
    customers = table(spark, sf, "customer")
    return encode.ordinal_encode(customers, customers, ["c_name"]).select("c_custkey", "c_name_code")


QUERIES["ordinal_names"] = ordinal_names
ORACLE["ordinal_names"] = """SELECT c_custkey, (dense_rank() OVER (ORDER BY c_name) - 1)::INTEGER
  AS c_name_code FROM customer"""

QUERIES["label_encode"] = lambda spark, sf: encode.encode_label(
    table(spark, sf, "events"), "event_type"
).select("event_id", "label")
ORACLE["label_encode"] = """SELECT event_id, (dense_rank() OVER (ORDER BY event_type) - 1)::DOUBLE AS label
FROM events"""


def label_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Codes derived from the event number, decoded by the class table."""
    events = table(spark, sf, "events")
    coded = events.select("event_id", F.pmod("event_id", F.lit(5)).alias("predicted"))
    classes = encode.class_table(events, "event_type")
    return encode.decode_label(coded, classes, "predicted", "event_type").select("event_id", "event_type")


QUERIES["label_decode"] = label_decode
ORACLE["label_decode"] = """WITH c AS (
  SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS code
  FROM (SELECT DISTINCT event_type FROM events))
SELECT e.event_id, c.event_type FROM events e JOIN c ON c.code = e.event_id % 5"""


def target_encode_oof(spark: SparkSession, sf: str) -> DataFrame:
    """Purchase rate by user, out of fold, on every event."""
    events = folds.kfold(table(spark, sf, "events"), F.col("event_id")).select(
        "event_id", "fold", F.col("user_id").cast("string").alias("user_id"),
        (F.col("event_type") == "purchase").cast("int").alias("label"),
    )
    return encode.target_encode_oof(events, "user_id", "label").select(
        "event_id", "fold", F.round("encoded", 6).alias("encoded")
    )


QUERIES["target_encode_oof"] = target_encode_oof
ORACLE["target_encode_oof"] = f"""WITH e AS (
  SELECT event_id, {sql_fold('event_id')} AS fold, user_id, (event_type = 'purchase')::INT AS y FROM events),
cf AS (SELECT user_id, fold, count(*) AS n, sum(y) AS s FROM e GROUP BY ALL),
c AS (SELECT user_id, sum(n) AS n, sum(s) AS s FROM cf GROUP BY ALL),
f AS (SELECT fold, sum(n) AS n, sum(s) AS s FROM cf GROUP BY ALL),
a AS (SELECT sum(n) AS n, sum(s) AS s FROM cf)
SELECT e.event_id, e.fold, round(((c.s - cf.s) + 10 * ((a.s - f.s)::DOUBLE / (a.n - f.n)))
  / (c.n - cf.n + 10), 6) AS encoded
FROM e JOIN cf USING (user_id, fold) JOIN c USING (user_id) JOIN f USING (fold) CROSS JOIN a"""


def target_encode_test(spark: SparkSession, sf: str) -> DataFrame:
    """Encoding fitted on early orders and applied to late ones; unseen customers get the prior."""
    orders = table(spark, sf, "orders").withColumn("o_custkey", F.col("o_custkey").cast("string"))
    train = orders.where(F.col("o_orderdate") < "2000-01-01")
    test = orders.where(F.col("o_orderdate") >= "2000-01-01")
    model = encode.TargetEncoder(["o_custkey"], "o_totalprice").fit(train)
    return model.transform(test).select(
        "o_orderkey", F.round("o_custkey_target", 3).alias("o_custkey_target")
    )


QUERIES["target_encode_test"] = target_encode_test
ORACLE["target_encode_test"] = """WITH train AS (SELECT * FROM orders WHERE o_orderdate < '2000-01-01'),
p AS (SELECT avg(o_totalprice) AS mu FROM train),
t AS (SELECT o_custkey, (sum(o_totalprice) + 10 * any_value(mu)) / (count(*) + 10) AS v
      FROM train, p GROUP BY 1)
SELECT o_orderkey, round(coalesce(v, mu), 3) AS o_custkey_target
FROM orders LEFT JOIN t USING (o_custkey), p WHERE o_orderdate >= '2000-01-01'"""


def cardinality_routes(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["c_name", "c_mktsegment"]
    routes = encode.route_by_cardinality(table(spark, sf, "customer"), cols)
    return spark.createDataFrame(sorted(routes.items()), "column STRING, route STRING")


QUERIES["cardinality_routes"] = cardinality_routes
ORACLE["cardinality_routes"] = """SELECT 'c_name' AS "column",
  CASE WHEN count(DISTINCT c_name) <= 100 THEN 'one_hot' ELSE 'target' END AS route FROM customer
UNION ALL SELECT 'c_mktsegment',
  CASE WHEN count(DISTINCT c_mktsegment) <= 100 THEN 'one_hot' ELSE 'target' END FROM customer"""


# --- features -------------------------------------------------------------------------
def poly_terms(spark: SparkSession, sf: str) -> DataFrame:
    terms = preprocess.polynomial_terms(["l_quantity", "l_discount", "l_tax"])
    lines = lineitem(spark, sf).withColumns(terms).select("key", *terms)
    return _round(lines, list(terms))


QUERIES["poly_terms"] = poly_terms
ORACLE["poly_terms"] = f"""SELECT {LINE_KEY} AS key, round(l_quantity, 6) AS l_quantity,
  round(l_discount, 6) AS l_discount, round(l_tax, 6) AS l_tax,
  round(l_quantity * l_quantity, 6) AS l_quantity_sq, round(l_discount * l_discount, 6) AS l_discount_sq,
  round(l_tax * l_tax, 6) AS l_tax_sq, round(l_quantity * l_discount, 6) AS l_quantity_x_l_discount,
  round(l_quantity * l_tax, 6) AS l_quantity_x_l_tax, round(l_discount * l_tax, 6) AS l_discount_x_l_tax
FROM lineitem"""


def binning(spark: SparkSession, sf: str) -> DataFrame:
    """Price of orders with gaps in quartiles and in five even ranges."""
    orders = sparse_orders(spark, sf)
    quantile = preprocess.fit_quantile_cuts(orders, ["o_totalprice"], 4)["o_totalprice"]
    uniform = preprocess.fit_uniform_cuts(orders, ["o_totalprice"], 5)["o_totalprice"]
    c = F.col("o_totalprice")
    return orders.select(
        "o_orderkey", F.coalesce(preprocess.bin_by_cuts(c, quantile), F.lit(-1)).alias("quantile_bin"),
        F.coalesce(preprocess.bin_by_cuts(c, uniform), F.lit(-1)).alias("uniform_bin"),
    )


QUERIES["binning"] = binning
ORACLE["binning"] = f"""WITH {SPARSE_ORDERS},
q AS (SELECT list_distinct(quantile_cont(o_totalprice, [0.25, 0.5, 0.75])) AS q,
             min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM sparse),
u AS (SELECT q, list_transform([1, 2, 3, 4], lambda j: lo + (hi - lo) * j / 5) AS u FROM q)
SELECT o_orderkey, coalesce(list_sum(list_transform(q, lambda v: (o_totalprice >= v)::INT)), -1)::INTEGER
  AS quantile_bin, coalesce(list_sum(list_transform(u, lambda v: (o_totalprice >= v)::INT)), -1)::INTEGER
  AS uniform_bin FROM sparse, u"""

QUERIES["string_features"] = lambda spark, sf: table(spark, sf, "documents").withColumns(
    preprocess.string_features("text")
).select("doc_id", "text_length", "text_digits", "text_has_digit")
ORACLE["string_features"] = r"""SELECT doc_id, length(coalesce(text, ''))::INTEGER AS text_length,
  (length(text) - length(regexp_replace(text, '[0-9]', '', 'g')))::INTEGER AS text_digits,
  regexp_matches(text, '[0-9]')::INTEGER AS text_has_digit FROM documents"""

QUERIES["date_parts"] = lambda spark, sf: table(spark, sf, "events").select(
    "event_id", *[c.alias(n) for n, c in preprocess.date_parts("ts").items()]
)
ORACLE["date_parts"] = """SELECT event_id, year(ts)::INTEGER AS ts_year, month(ts)::INTEGER AS ts_month,
  day(ts)::INTEGER AS ts_day, isodow(ts)::INTEGER AS ts_weekday, hour(ts)::INTEGER AS ts_hour FROM events"""

# --- selection ------------------------------------------------------------------------
FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

QUERIES["select_variance"] = lambda spark, sf: select.variances(
    table(spark, sf, "lineitem"), FEATURES
).where(F.col("variance") > 0.0009).select("column", F.round("variance", 4).alias("variance"))
ORACLE["select_variance"] = "WITH v AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", var_pop({c}) AS variance FROM lineitem""" for c in FEATURES
) + """) SELECT "column", round(variance, 4) AS variance FROM v WHERE variance > 0.0009"""

QUERIES["select_f_classif"] = lambda spark, sf: select.best_columns(
    select.anova_f(table(spark, sf, "lineitem"), FEATURES, "l_returnflag"), 3
).select("column", F.round("score", 5).alias("score"))
ORACLE["select_f_classif"] = "WITH t AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", l_returnflag AS y, {c} AS x FROM lineitem""" for c in FEATURES
) + """), g AS (SELECT "column", avg(x) AS m, count(*) AS n FROM t GROUP BY 1),
k AS (SELECT "column", y, avg(x) AS mk, count(*) AS nk, var_pop(x) * count(*) AS wk FROM t GROUP BY ALL),
f AS (SELECT "column", (sum(nk * (mk - m) ** 2) / (count(*) - 1)) / (sum(wk) / (any_value(n) - count(*))) AS score
      FROM k JOIN g USING ("column") GROUP BY 1)
SELECT "column", round(score, 5) AS score FROM f ORDER BY f.score DESC, "column" LIMIT 3"""

QUERIES["select_f_regression"] = lambda spark, sf: select.f_regression(
    table(spark, sf, "lineitem"), ["l_discount", "l_tax", "l_partkey", "l_suppkey"], "l_extendedprice"
).select("column", F.round("score", 5).alias("score"))
ORACLE["select_f_regression"] = "WITH r AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", corr({c}::DOUBLE, l_extendedprice) AS r, count(*) AS n FROM lineitem"""
    for c in ("l_discount", "l_tax", "l_partkey", "l_suppkey")
) + """) SELECT "column", round(r * r * (n - 2) / (1 - r * r), 5) AS score FROM r"""

QUERIES["select_chi2"] = lambda spark, sf: select.chi_square(
    table(spark, sf, "lineitem"), FEATURES, "l_returnflag"
).select("column", F.round("score", 4).alias("score"))
ORACLE["select_chi2"] = "WITH t AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", l_returnflag AS y, {c} AS x FROM lineitem""" for c in FEATURES
) + """), g AS (SELECT "column", sum(x) AS total, count(*)::DOUBLE AS n FROM t GROUP BY 1),
k AS (SELECT "column", y, sum(x) AS o, count(*) AS nk FROM t GROUP BY ALL)
SELECT "column", round(sum((o - nk / n * total) ** 2 / (nk / n * total)), 4) AS score
FROM k JOIN g USING ("column") GROUP BY 1"""


def select_best(spark: SparkSession, sf: str) -> DataFrame:
    """Lines projected on the column that separates the return flags best, summed by flag."""
    lines = table(spark, sf, "lineitem").select(*FEATURES, "l_returnflag")
    scores = select.anova_f(lines, FEATURES, "l_returnflag")
    kept = select.select_best(lines, scores, 1, keep=["l_returnflag"])
    name = kept.columns[1]
    return kept.groupBy("l_returnflag").agg(
        F.lit(name).alias("column"), F.round(F.avg(name), 4).alias("mean")
    )


QUERIES["select_best"] = select_best
ORACLE["select_best"] = ORACLE["select_f_classif"].replace(
    """SELECT "column", round(score, 5) AS score FROM f ORDER BY f.score DESC, "column" LIMIT 3""",
    """SELECT y AS l_returnflag, "column", round(avg(x), 4) AS mean FROM t
WHERE "column" = (SELECT "column" FROM f ORDER BY score DESC, "column" LIMIT 1) GROUP BY ALL""",
)


# --- ridge in closed form -------------------------------------------------------------
ALPHA = 1.0


def ridge_by_fold(spark: SparkSession, sf: str) -> DataFrame:
    """Price on quantity: ridge slope and intercept of every training fold, and held-out MSE."""
    from foldwise.operators.evaluate import ridge_closed_form

    lines = folds.kfold(lineitem(spark, sf), F.col("key"))
    out = ridge_closed_form(lines, "l_quantity", "l_extendedprice", ALPHA)
    return out.select(
        "fold", F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"),
        F.round("mse", 0).alias("mse"),
    )


QUERIES["ridge_by_fold"] = ridge_by_fold
ORACLE["ridge_by_fold"] = f"""WITH f AS (
  SELECT {sql_fold(LINE_KEY)} AS fold, l_quantity AS x, l_extendedprice AS y FROM lineitem),
ids AS (SELECT DISTINCT fold AS held FROM f),
s AS (SELECT held, covar_pop(y, x) * count(*) / (var_pop(x) * count(*) + {ALPHA}::DOUBLE) AS w,
             avg(x) AS mx, avg(y) AS my FROM ids JOIN f ON f.fold <> held GROUP BY 1),
m AS (SELECT held, w, my - w * mx AS b FROM s)
SELECT fold, round(any_value(w), 4) AS slope, round(any_value(b), 3) AS intercept,
  round(avg((y - (w * x + b)) ** 2), 0) AS mse FROM f JOIN m ON held = fold GROUP BY fold"""


PENALTIES = (0.1, 1.0, 10.0, 100.0, 1000.0)


def ridge_penalties(spark: SparkSession, sf: str) -> DataFrame:
    """Price on quantity and discount: every fold and penalty from one scan, with held-out MSE."""
    from foldwise.operators.products import ridge_path

    lines = folds.kfold(lineitem(spark, sf), F.col("key"))
    out = ridge_path(lines, ["l_quantity", "l_discount"], "l_extendedprice", PENALTIES)
    return out.select(
        "fold", "alpha", F.round(F.get("weights", F.lit(0)), 4).alias("by_quantity"),
        F.round(F.get("weights", F.lit(1)), 2).alias("by_discount"), F.round("mse", 0).alias("mse"),
    )


QUERIES["ridge_penalties"] = ridge_penalties
ORACLE["ridge_penalties"] = f"""WITH f AS (
  SELECT {sql_fold(LINE_KEY)} AS fold, l_quantity AS x, l_discount AS z, l_extendedprice AS y FROM lineitem
  WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL AND l_extendedprice IS NOT NULL),
a AS (SELECT unnest([{', '.join(map(str, PENALTIES))}])::DOUBLE AS alpha),
s AS (SELECT held, avg(x) AS mx, avg(z) AS mz, avg(y) AS my, var_pop(x) * count(*) AS xx, var_pop(z) * count(*) AS zz,
        covar_pop(x, z) * count(*) AS xz, covar_pop(x, y) * count(*) AS xy, covar_pop(z, y) * count(*) AS zy
      FROM (SELECT DISTINCT fold AS held FROM f) JOIN f ON f.fold <> held GROUP BY held),
w AS (SELECT held, alpha, mx, mz, my, (xy * (zz + alpha) - zy * xz) / ((xx + alpha) * (zz + alpha) - xz * xz) AS u,
        (zy * (xx + alpha) - xy * xz) / ((xx + alpha) * (zz + alpha) - xz * xz) AS v FROM s, a)
SELECT fold, alpha, round(any_value(u), 4) AS by_quantity, round(any_value(v), 2) AS by_discount,
  round(avg((y - my - u * (x - mx) - v * (z - mz)) ** 2), 0) AS mse
FROM f JOIN w ON held = fold GROUP BY fold, alpha"""
