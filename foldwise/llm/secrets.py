"""Secret scans: a random forest removes false positives among candidates, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from foldwise.llm.common import hash_sample, materialise, table

#: What is looked at: values of at least 8 characters of any kind after a telling name and in the
#: user part of an address, and runs of at least 16 that keys, hashes and tokens are written in.
NAME = "(?i:passw(?:or)?d|passwd|secret|token|api[_-]?key|auth)"
VALUE = "(?<=[:=\"\\x27 ])(?<=" + NAME + "[\"\\x27]? {0,2}[:=]{1,2} {0,2}[\"\\x27]?)[^\\s\"\\x27:=][^\\s\"\\x27]{7,}"
LOGIN = "(?<=:)(?<=://[A-Za-z0-9._-]{1,32}:)[^\\s@/]{8,}(?=@)"
CANDIDATE = f"{VALUE}|{LOGIN}|[A-Za-z0-9+/_-]{{16,}}={{0,2}}"
#: Characters kept of what stands before and after a candidate.
BEFORE, AFTER = 48, 24
#: Distant labels of the findings to learn from: formats and assignments, and plain words and numbers.
SECRET_FORMAT = "^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35})$"
ASSIGNED = r"(?i)(passw(or)?d|passwd|secret|token|api[_-]?key|auth)[\"']?\s*[:=]+\s*[\"']?$"
PLAIN = "^([A-Z]?[a-z]+|[0-9]+|[A-Z]+|[a-z]+(-[a-z]+)+)$"
#: The most findings of each class that are learnt from.
PER_CLASS = 3000
#: A trigram is a part of words if it stands in more than this share of a text's worth of words, and in 3 at least.
TRIGRAM_SHARE, TRIGRAM_LEAST = 0.0015, 3
TREES, DEPTH, SEED = 24, 6, 6

LETTERS = "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = LETTERS + "0123456789"
FEATURES = {
    "size": "CAST(length(c) AS DOUBLE)",
    "digits": "length(regexp_replace(c, '[^0-9]', '')) / length(c)",
    "uppers": "length(regexp_replace(c, '[^A-Z]', '')) / length(c)",
    "marks": "length(regexp_replace(c, '[A-Za-z0-9]', '')) / length(c)",
    "switches": "(regexp_count(c, '[a-z](?=[0-9])') + regexp_count(c, '[0-9](?=[A-Za-z])') "
                "+ regexp_count(c, '[a-z](?=[A-Z])') + regexp_count(c, '[A-Z](?=[0-9])')) / length(c)",
    "distinct": "size(array_distinct(split(c, ''))) / length(c)",
    "hex": "IF(c RLIKE '^([0-9a-f]+|[0-9A-F]+)$', 1D, 0D)",
    "slashes": "CAST(length(c) - length(replace(c, '/', '')) AS DOUBLE)",
    "in_path": "IF(before RLIKE '(://|www[.]|[.]/|/)[^ ]*$' OR after RLIKE '^[./]', 1D, 0D)",
    "in_mail": "IF(after RLIKE '^@|^[.][a-z0-9.]*@', 1D, 0D)",
    "quoted": "IF(before RLIKE '[\"'']$' AND after RLIKE '^[\"'']', 1D, 0D)",
    "assigned": "IF(before RLIKE '[=:] *[\"'']?$', 1D, 0D)",
    "named": "IF(lower(before) RLIKE '(password|passwd|secret|token|key|auth|credential)', 1D, 0D)",
    "words_before": "CAST(size(filter(split(before, '[^A-Za-z]+'), w -> length(w) > 2)) AS DOUBLE)",
    "words_after": "CAST(size(filter(split(after, '[^A-Za-z]+'), w -> length(w) > 2)) AS DOUBLE)",
}


def candidates(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id), start, c, before and after of every candidate in ``text``.

    Row by row, without a shuffle; starts are code points from 0. NULL and empty texts have none.
    """
    keep = keep or ["doc_id"]
    pattern = CANDIDATE.replace("\\", "\\\\")  # as an SQL literal
    cut = docs.select(
        *keep, F.expr(f"split(text, '{pattern}', -1)").alias("__gaps"),
        F.expr(f"regexp_extract_all(text, '{pattern}', 0)").alias("__found"),
    ).where("size(__found) > 0")
    starts = """
      aggregate(sequence(0, size(__found) - 1), named_struct('at', 0L, 'all', CAST(array() AS ARRAY<BIGINT>)),
        (s, i) -> named_struct('at', s.at + length(get(__gaps, i)) + length(get(__found, i)),
          'all', array_append(s.all, s.at + length(get(__gaps, i)))), s -> s.all)"""
    zipped = cut.withColumn("__starts", F.expr(starts)).withColumn(
        "__rows",
        F.zip_with(
            F.zip_with("__starts", "__found", lambda a, b: F.struct(a.alias("start"), b.alias("c"))),
            F.zip_with(
                F.expr("slice(__gaps, 1, size(__found))"), F.expr("slice(__gaps, 2, size(__found))"),
                lambda a, b: F.struct(F.right(a, F.lit(BEFORE)).alias("before"), F.left(b, F.lit(AFTER)).alias("after")),
            ),
            lambda x, y: F.struct(x["start"].alias("start"), x["c"].alias("c"), y["before"].alias("before"), y["after"].alias("after")),
        ),
    )
    # The outer form, as the other evaluates the rows once more to skip texts without any.
    return zipped.select(*keep, F.inline_outer("__rows")).where("c IS NOT NULL")


class Lexicon:
    """What the corpus's words look like: levels (0 to 9) of character transitions, and their trigrams."""

    def __init__(self, levels: str, trigrams: str):
        self.levels, self.trigrams = levels, trigrams

    @classmethod
    def fit(cls, docs: DataFrame) -> Lexicon:
        """From the distinct words of every text, in one pass of partial counts; of the 1,296 pairs and
        17,576 trigrams that there can be, those found reach the driver."""
        n = len(SYMBOLS)
        words = docs.select(F.explode(F.array_distinct(F.expr("regexp_extract_all(lower(text), '[a-z0-9]{2,15}', 0)"))).alias("w"))
        grams = words.select(F.expr("""explode(concat(
          transform(sequence(1, length(w) - 1), i -> substring(w, i, 2)),
          IF(length(w) > 2 AND NOT w RLIKE '[0-9]',
            transform(sequence(1, length(w) - 2), i -> substring(w, i, 3)), CAST(array() AS ARRAY<STRING>))))""").alias("g"))
        found = {r.g: r.n for r in grams.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}
        texts = docs.count()
        counts = {g: k for g, k in found.items() if len(g) == 2}
        total = sum(counts.values()) + n * n
        levels = []
        for a in SYMBOLS:
            row = sum(counts.get(a + b, 0) for b in SYMBOLS) + n
            for b in SYMBOLS:
                lift = math.log((counts.get(a + b, 0) + 1) / row * n) if total else 0.0
                levels.append(str(min(9, max(0, round(5 + 1.5 * lift)))))
        least = max(TRIGRAM_LEAST, TRIGRAM_SHARE * texts)
        known = {g for g, k in found.items() if len(g) == 3 and k >= least}
        trigrams = "".join("1" if a + b + c in known else "0" for a in LETTERS for b in LETTERS for c in LETTERS)
        return cls("".join(levels), trigrams)

    def columns(self) -> dict[str, str]:
        """SQL over the candidate ``c``: mean transition level, and share of trigrams that are parts of words."""
        n = len(SYMBOLS)
        codes = f"filter(transform(split(lower(c), ''), x -> instr('{SYMBOLS}', x)), x -> x > 0)"
        letters = "split(regexp_replace(lower(c), '[^a-z]', ''), '')"
        return {
            "transitions": f"""
              coalesce(aggregate(sequence(1, greatest(size(__codes) - 1, 1)), 0D, (s, i) -> s +
                coalesce(CAST(try_element_at(split('{self.levels}', ''), (element_at(__codes, i) - 1) * {n} + try_element_at(__codes, i + 1)) AS DOUBLE), 5D))
                / greatest(size(__codes) - 1, 1), 5D)""",
            "in_words": f"""
              coalesce(aggregate(sequence(0, greatest(size(__letters) - 3, 0)), 0D, (s, i) -> s + IF(try_element_at(
                split('{self.trigrams}', ''), (instr('{LETTERS}', get(__letters, i)) - 1) * 676
                + (instr('{LETTERS}', get(__letters, i + 1)) - 1) * 26 + instr('{LETTERS}', get(__letters, i + 2))) = '1', 1D, 0D))
                / length(c), 0D)""",
            "__codes": codes,
            "__letters": letters,
        }


def described(found: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``found`` with the features of its candidates as ``f_<name>``: length, character transitions,
    dictionary coverage, path and neighbouring words."""
    extra = lexicon.columns()
    own = found.columns
    ready = found.withColumns({k: F.expr(extra.pop(k)) for k in ("__codes", "__letters")})
    return ready.select(*own, *[F.expr(e).alias(f"f_{k}") for k, e in {**FEATURES, **extra}.items()])


def distant_label() -> str:
    """SQL for 1 (a known format, or assigned to a telling name), 0 (a plain word or number), else NULL."""
    assigned = ASSIGNED.replace("\\", "\\\\").replace("'", "\\'")
    return (
        f"CASE WHEN c RLIKE '{SECRET_FORMAT}' THEN 1 WHEN c RLIKE '{PLAIN}' THEN 0 "
        f"WHEN before RLIKE '{assigned}' AND c RLIKE '[0-9]' THEN 1 END"
    )


def train(findings: DataFrame) -> RandomForestClassificationModel | float:
    """A forest of the labelled findings (``label`` and f_ columns), at most PER_CLASS of each class;
    without both classes the score is a constant."""
    known = findings.where("label IS NOT NULL")
    parts = [hash_sample(known.where(F.col("label") == k), PER_CLASS, "c", "before", "after") for k in (0, 1)]
    sample = materialise(parts[0].unionByName(parts[1]))
    have = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(have) < 2:
        return 0.9 if 1 in have else 0.1
    names = [c for c in findings.columns if c.startswith("f_")]
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt", subsamplingRate=0.7, maxBins=32,
    )
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(sample)
    return forest.fit(vectors.select("features", F.col("label").cast("double").alias("label")))


def score(found: DataFrame, model: RandomForestClassificationModel | float) -> DataFrame:
    """``found`` with ``score``: the forest's probability that a candidate is a secret."""
    if isinstance(model, float):
        return found.withColumn("score", F.lit(model))
    names = [c for c in found.columns if c.startswith("f_")]
    vectors = VectorAssembler(inputCols=names, outputCol="__features").transform(found)
    own = found.columns
    model = model.copy().setFeaturesCol("__features").setProbabilityCol("__p").setRawPredictionCol("__raw").setPredictionCol("__y")
    return model.transform(vectors).select(*own, vector_to_array("__p")[1].alias("score"))


def scan(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Every candidate of ``docs`` (``keep`` columns, default doc_id; text) with its score.

    The forest learns from findings that a format or an assignment labels, and tells from length,
    transitions, dictionary coverage, path and neighbouring words which of all candidates are
    secrets. Candidates are found row by row and written once; nothing is grouped by document,
    so a hot source or a long text gathers nowhere. Repeated rows give repeated findings.
    """
    lexicon = Lexicon.fit(docs)
    found = described(candidates(docs, keep), lexicon).withColumn("label", F.expr(distant_label()))
    found = materialise(found)
    return score(found, train(found))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets in all documents: where they are and how likely; no secret is spelt out."""
    found = scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.where("score >= 0.5").selectExpr(
        "doc_id", "start", "CAST(length(c) AS BIGINT) AS length", "sha2(c, 256) AS secret_sha256", "score"
    )


QUERIES = {"op6_secret_scan": op6_secret_scan}
ORACLE: dict[str, str] = {}
