"""Site-relative line frequency: lines on too large a share of a host's pages are boilerplate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from foldwise.llm.common import bytes_within, materialise, table
from foldwise.operators.ordered import lookup_join

#: A line on more than this share of its host's pages is boilerplate ...
RATIO = 0.02
#: ... if at least so many pages hold it.
MIN_PAGES = 5
#: A line of more words than this does not recur by chance: one that two texts hold is a repeated passage.
LONG_WORDS = 50
#: A text of which such lines are more than this share of the characters is a copy as a whole, which is left to near-dedup.
WHOLE = 0.8
#: Bytes of boilerplate keys that may be broadcast; above it they are joined by host.
BROADCAST_BYTES = 16 << 20


def lines_of(text: str = "text") -> str:
    """SQL for the array of a text's lines; a NULL text has none."""
    return f"split(coalesce({text}, ''), '\\n', -1)"


def key_of(line: str) -> str:
    """SQL for what two occurrences of a line share: its 128-bit digest without outer blanks."""
    return f"unhex(md5(trim(BOTH ' \\t\\r' FROM {line})))"


def boilerplate(pages: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    """__host and the digests (``__keys``) of its boilerplate lines, for hosts that have any.

    A line counts once a page (distinct within the row, before any shuffle), and counts are
    partial aggregates, so neither a hot host nor a hot line gathers rows. A host has at most
    lines-per-page / ratio such lines, however many pages it has.
    """
    totals = pages.groupBy("__host").agg(F.count(F.lit(1)).alias("pages"))
    keys = f"array_distinct(transform(filter({lines_of('__text')}, l -> trim(BOTH ' \\t\\r' FROM l) <> ''), l -> {key_of('l')}))"
    held = (
        pages.select("__host", F.explode(F.expr(keys)).alias("key"))
        .groupBy("__host", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    )
    return (
        held.join(totals, held["__host"].eqNullSafe(totals["__host"]))
        .where(F.col("n") > F.col("pages") * F.lit(ratio))
        .groupBy(held["__host"]).agg(F.collect_list("key").alias("__keys"))
    )


def drop_boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text",
    ratio: float = RATIO, min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``docs`` with ``text`` rid of its host's boilerplate lines, and n_lines, n_dropped as ``__n_lines``, ``__n_dropped``.

    A line is boilerplate if at least ``min_pages`` pages and more than ``ratio`` of the pages of
    its host hold it, wherever in them, compared without outer blanks. All its occurrences go;
    other lines, blank ones too, stay as they are and in order. A NULL host is a host of its own;
    a NULL text has no lines and stays NULL; a text of which nothing is left becomes empty.
    Repeated rows are pages of their own. All columns are carried along.
    """
    pages = docs.select(F.col(host).alias("__host"), F.col(text).alias("__text"))
    found = materialise(boilerplate(pages, ratio, min_pages))
    if bytes_within(found, BROADCAST_BYTES):
        found = F.broadcast(found)
    joined = docs.join(found, docs[host].eqNullSafe(found["__host"]), "left").withColumn(
        "__lines", F.expr(lines_of(f"`{text}`"))
    )
    kept = joined.withColumn(
        "__kept",
        F.expr(
            f"CASE WHEN __keys IS NULL THEN __lines ELSE "
            f"filter(__lines, l -> trim(BOTH ' \\t\\r' FROM l) = '' OR NOT array_contains(__keys, {key_of('l')})) END"
        ),
    )
    return kept.withColumns({
        text: F.expr(f"CASE WHEN `{text}` IS NULL THEN NULL ELSE array_join(__kept, '\\n') END"),
        "__n_lines": F.expr(f"CASE WHEN `{text}` IS NULL THEN 0L ELSE CAST(size(__lines) AS BIGINT) END"),
        "__n_dropped": F.expr("CAST(size(__lines) - size(__kept) AS BIGINT)"),
    }).drop("__host", "__keys", "__lines", "__kept")


def drop_passages(docs: DataFrame, text: str = "text", words: int = LONG_WORDS) -> DataFrame:
    """``docs`` whose lines of more than ``words`` words stay in one text of all that hold them.

    Of the distinct texts with such a line, whatever their hosts, that of the least digest keeps
    it, so no passage is lost and exact copies stay alike. A text that would lose more than WHOLE
    of its characters stays as it is: it is a near copy, and a stub of it would not be found by
    the search for such. Lines are compared without outer blanks; all else stays as it is and in order. A NULL text stays NULL; an empty table gives an
    empty one; all columns are carried along. A line that many texts hold and a text that many
    rows repeat are hot keys of :func:`lookup_join`, which sends them to no single task.
    """
    long = f"size(split(trim(BOTH ' \t\r' FROM l), '\\\\s+')) > {words}"
    keys = f"array_distinct(transform(filter({lines_of('__text')}, l -> {long}), l -> {key_of('l')}))"
    held = materialise(
        docs.select(F.col(text).alias("__text"))
        .select(F.expr("unhex(md5(__text))").alias("__page"), F.explode(F.expr(keys)).alias("__key")).distinct()
    )
    known = (
        held.groupBy("__key").agg(F.count(F.lit(1)).alias("__n"), F.min("__page").alias("__first")).where("__n > 1")
    )
    found = (
        lookup_join(held, known, ["__key"]).where("__page <> __first")
        .groupBy("__page").agg(F.collect_list("__key").alias("__keys"))
    )
    joined = lookup_join(docs.withColumn("__page", F.expr(f"unhex(md5(`{text}`))")), found, ["__page"])
    rest = f"filter({lines_of(f'`{text}`')}, l -> NOT array_contains(__keys, {key_of('l')}))"
    cut = joined.withColumn("__rest", F.expr(f"CASE WHEN __keys IS NOT NULL THEN array_join({rest}, '\n') END"))
    enough = f"length(__rest) >= {1 - WHOLE:.6f} * length(`{text}`)"
    return cut.withColumn(text, F.expr(f"CASE WHEN {enough} THEN __rest ELSE `{text}` END")).select(*docs.columns)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its source's boilerplate lines: the digest of what is left."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return drop_boilerplate(docs).selectExpr(
        "doc_id", "source", "__n_lines AS n_lines", "__n_dropped AS n_dropped",
        "CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars_left", "md5(coalesce(text, '')) AS text_md5",
    )


ORACLE = {
    "op7_line_dedup": f"""
WITH lines AS (
  SELECT source, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents
), held AS (
  SELECT source, trim(line, ' ' || chr(9) || chr(13)) AS line, count(DISTINCT doc_id) AS n FROM lines GROUP BY ALL
), totals AS (
  SELECT source, count(*) AS pages FROM documents GROUP BY source
), bad AS (
  SELECT h.source, list(h.line) AS keys FROM held h JOIN totals t ON h.source IS NOT DISTINCT FROM t.source
  WHERE h.line <> '' AND h.n >= {MIN_PAGES} AND h.n > t.pages * CAST({RATIO} AS DOUBLE) GROUP BY h.source
), kept AS (
  SELECT d.doc_id, d.source, string_split(coalesce(d.text, ''), chr(10)) AS a, coalesce(b.keys, []) AS keys, d.text IS NULL AS none
  FROM documents d LEFT JOIN bad b ON d.source IS NOT DISTINCT FROM b.source
), cut AS (
  SELECT doc_id, source, none, len(a) AS n,
    list_filter(a, lambda x: NOT list_contains(keys, trim(x, ' ' || chr(9) || chr(13)))) AS k FROM kept
)
SELECT doc_id, source, CASE WHEN none THEN 0 ELSE CAST(n AS BIGINT) END AS n_lines,
  CAST(n - len(k) AS BIGINT) AS n_dropped,
  CAST(length(array_to_string(k, chr(10))) AS BIGINT) AS n_chars_left, md5(array_to_string(k, chr(10))) AS text_md5
FROM cut""",
}
QUERIES = {"op7_line_dedup": op7_line_dedup}
