"""Documents to training sequences: quality, line dedup, near-dedup, decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from foldwise.llm import decontam, linededup, minhash, packing, quality
from foldwise.llm.common import table
from foldwise.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rule ensemble, learnt from the labels, scores at its threshold or above."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select(*COLUMNS), model)
    return scored.where(F.col("__score") >= quality.THRESHOLD).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate on their source and with its long lines once; n_chars is that of the rest."""
    kept = linededup.drop_passages(linededup.drop_boilerplate(docs.select(*COLUMNS)).select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a 5-word Jaccard similarity of 0.8 or more."""
    return minhash.one_of_each(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontam.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark", "item_id", "text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of token sequences."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_lines),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: Learnt scores, fingerprints, edit distances and token ids are not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; each stage is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
