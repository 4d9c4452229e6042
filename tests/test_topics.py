"""Topics are learnt from every document and every term."""

from pyspark.sql import functions as F

from foldwise.operators import unsupervised
from foldwise.plans import models


def test_topics_count_their_terms_and_read_all_documents(spark):
    docs = spark.createDataFrame([(f"word{i} common{i % 7} und the",) for i in range(2100)], "text string")
    model, _ = unsupervised.topics(docs, "text", 2, None, 1, ["und", "the"])
    assert len(model.stages[-2].vocabulary) == 2107
    assert model.stages[-1].getSubsamplingRate() == 1.0
    rows = unsupervised.describe_topics(model, 3).collect()
    assert len(rows) == 6 and all(r.term in model.stages[-2].vocabulary for r in rows)


def test_topic_terms_leave_out_stop_words_of_all_languages(spark, folder):
    rows = models.topic_terms(spark, folder).collect()
    assert len(rows) == 32 and not {r.term for r in rows} & {"der", "und", "les", "que", "the"}


def test_texts_are_split_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    docs = spark.range(300).select(F.udf(seen, "string")(F.concat(F.lit("word"), "id")).alias("text"))
    unsupervised.topics(docs, "text", 2, None, 2, own=100, shared=16)
    assert read.value == 300
