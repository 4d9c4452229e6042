"""Queries that extract, clean and cut text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.functions import numeric, text
from foldwise.sources.tables import table

QUERIES, ORACLE = {}, {}

WS = "chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"


# --- names and paths ------------------------------------------------------------------
QUERIES["slugify"] = lambda spark, sf: table(spark, sf, "pages").select(
    "page_id", text.slug(F.col("url")).alias("slug"),
    text.slug(F.when(F.pmod("page_id", F.lit(2)) == 0, " main ").otherwise("..--")).alias("reserved"),
)


def _slug_sql(c: str) -> str:
    cut = f"trim(regexp_replace(trim({c}, {WS}), '[^a-zA-Z0-9._-]+', '-', 'g'), '-.')"
    return f"CASE WHEN {cut} IN ('', 'main') THEN 'default' ELSE {cut} END"


ORACLE["slugify"] = f"""SELECT page_id, {_slug_sql('url')} AS slug, 'default' AS reserved FROM pages"""


def paths(spark: SparkSession, sf: str) -> DataFrame:
    """Dataset paths of several shapes made of the host of each page address."""
    rest = F.regexp_replace("url", "^[a-z]+://", "")
    host, leaf = F.regexp_extract(rest, "^([^/?#]*)", 1), F.col("page_id").cast("string")
    form = F.pmod("page_id", F.lit(5))
    path = (
        F.when(form == 0, F.concat(F.lit("data/"), host, F.lit("/train.csv")))
        .when(form == 1, F.concat(F.lit("data/"), host, F.lit(".csv")))
        .when(form == 2, F.concat(F.lit("/mnt//"), host, F.lit("/./part.csv")))
        .when(form == 3, F.concat(F.lit("/srv/data/"), host, F.lit("/x/"), leaf))
        .otherwise(F.concat(host, F.lit(".tar.gz")))
    )
    return table(spark, sf, "pages").select("page_id", path.alias("path"), host.alias("host"))


QUERIES["dataset_from_path"] = lambda spark, sf: paths(spark, sf).select(
    "page_id", text.dataset_name(F.col("path")).alias("dataset"),
    text.segment_after(F.col("path")).alias("after_data"),
)
HOST = "regexp_extract(regexp_replace(url, '^[a-z]+://', ''), '^([^/?#]*)', 1)"
ORACLE["dataset_from_path"] = f"""WITH h AS (SELECT page_id, page_id % 5 AS form, {HOST} AS host FROM pages),
n AS (SELECT *, CASE form WHEN 3 THEN 'x' WHEN 4 THEN host || '.tar' ELSE host END AS name FROM h)
SELECT page_id, {_slug_sql('name')} AS dataset,
  CASE form WHEN 0 THEN host WHEN 1 THEN host || '.csv' WHEN 3 THEN host END AS after_data FROM n"""

# --- replies --------------------------------------------------------------------------
def replies(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations whose even turns hold two fenced code blocks."""
    fenced = F.concat(
        F.lit("Plan:\n"), F.col("text"), F.lit("\n```python\n  x = "),
        F.col("conv_id").cast("string"), F.lit("\n\n```\nThen.\n```python\ny = 2\n```\n"),
    )
    body = F.when(F.pmod("turn", F.lit(2)) == 0, fenced).otherwise(F.col("text"))
    return table(spark, sf, "conversations").select("conv_id", "turn", body.alias("reply"))


REPLIES = """replies AS (SELECT conv_id, turn, text, CASE WHEN turn % 2 = 0 THEN 'Plan:' || chr(10) || text
  || chr(10) || '```python' || chr(10) || '  x = ' || conv_id || chr(10) || chr(10) || '```' || chr(10)
  || 'Then.' || chr(10) || '```python' || chr(10) || 'y = 2' || chr(10) || '```' || chr(10)
  ELSE text END AS reply FROM conversations)"""

QUERIES["extract_code"] = lambda spark, sf: replies(spark, sf).select(
    "conv_id", "turn", text.extract_code(F.col("reply")).alias("code")
)
ORACLE["extract_code"] = f"""WITH {REPLIES}
SELECT conv_id, turn, nullif(trim(CASE WHEN turn % 2 = 0 THEN 'x = ' || conv_id ELSE reply END, {WS}), '')
  AS code FROM replies"""

QUERIES["remove_code"] = lambda spark, sf: replies(spark, sf).select(
    "conv_id", "turn", text.without_code(F.col("reply")).alias("prose")
)
ORACLE["remove_code"] = f"""WITH {REPLIES},
p AS (SELECT conv_id, turn, trim(regexp_replace(reply, '(?s)```python.*?```', '', 'g'), {WS}) AS prose FROM replies)
SELECT conv_id, turn, CASE WHEN prose = '' THEN 'No reasoning provided by LLM.' ELSE prose END AS prose FROM p"""

QUERIES["one_line"] = lambda spark, sf: table(spark, sf, "documents").select(
    "doc_id", text.one_line(F.col("text")).alias("line")
)
ORACLE["one_line"] = f"SELECT doc_id, trim(replace(text, chr(10), ' '), {WS}) AS line FROM documents"

QUERIES["truncate_head_tail"] = lambda spark, sf: table(spark, sf, "documents").select(
    "doc_id", text.truncate_head(F.col("text")).alias("head"), text.truncate_tail(F.col("text")).alias("tail")
)
ORACLE["truncate_head_tail"] = """SELECT doc_id, CASE WHEN length(text) > 8000
    THEN left(text, 8000) || chr(10) || '... [TRUNCATED FOR BREVITY] ...' ELSE text END AS head,
  CASE WHEN length(text) > 1500 THEN '...[TRUNCATED]...' || chr(10) || right(text, 1500) ELSE text END AS tail
FROM documents"""

# --- records --------------------------------------------------------------------------
def json_metric(spark: SparkSession, sf: str) -> DataFrame:
    """Event properties, some cut short and some without the key; every row keeps a status."""
    form = F.pmod("event_id", F.lit(10))
    record = (
        F.when(form == 0, F.expr("left(props, length(props) - 1)"))
        .when(form == 1, F.replace(F.col("props"), F.lit('"k"'), F.lit('"other"')))
        .otherwise(F.col("props"))
    )
    parsed = text.json_number(record, "k")
    return table(spark, sf, "events").select("event_id", parsed.alias("x")).select("event_id", "x.*")


QUERIES["json_metric"] = json_metric
ORACLE["json_metric"] = """SELECT event_id,
  CASE WHEN event_id % 10 > 1 THEN json_extract_string(props, '$.k')::DOUBLE END AS value,
  CASE event_id % 10 WHEN 0 THEN 'malformed' WHEN 1 THEN 'missing_key' ELSE 'ok' END AS status FROM events"""

QUERIES["short_ids"] = lambda spark, sf: table(spark, sf, "customer").select(
    "c_custkey", text.short_id(F.md5("c_name")).alias("short")
)
ORACLE["short_ids"] = "SELECT c_custkey, left(md5(c_name), 7) AS short FROM customer"

QUERIES["clamped"] = lambda spark, sf: table(spark, sf, "lineitem").groupBy(
    F.round(numeric.clamp_upper(F.col("l_discount") * 10), 6).alias("clamped")
).agg(F.count(F.lit(1)).alias("n"))
ORACLE["clamped"] = """SELECT round(least(l_discount * 10 + 0.3::DOUBLE, 1.0::DOUBLE), 6) AS clamped,
  count(*) AS n FROM lineitem GROUP BY 1"""

QUERIES["timeout_flags"] = lambda spark, sf: table(spark, sf, "events").select(
    "event_id", text.is_timeout(
        F.when(F.col("event_type") == "error", F.when(F.col("user_id") % 2 == 0, "Script Execution Timed Out after 600 seconds.")
               .otherwise("subprocess.TimeoutExpired")).otherwise(
            F.when(F.col("event_type") == "view", "Script Execution Failed"))
    ).alias("timeout")
)
ORACLE["timeout_flags"] = "SELECT event_id, event_type = 'error' AS timeout FROM events"
