"""Clustering, projections and topics over vector and text columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import LDA, BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import (
    PCA, CountVectorizer, CountVectorizerModel, HashingTF, RegexTokenizer, StopWordsRemover, VectorAssembler,
)
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators.products import leading_singular
from foldwise.operators.registry import vector_width
from foldwise.session import materialise

SEED = 42
NARROW = 4096
#: The most terms with a topic weight of their own, and the shared weights of all further terms.
OWN_TERMS = 1 << 18
SHARED_TERMS = 1 << 14
VECTOR = "features"
#: Rows that are worth a task of their own, and the most numbers of vectors in one.
TASK_ROWS = 512
TASK_CELLS = 1 << 24


def as_vector(df: DataFrame, array: str, vector: str = VECTOR) -> DataFrame:
    return df.withColumn(vector, array_to_vector(F.col(array).cast("array<double>")))


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The rows, written once and dealt by ``key`` to one task a core, or to more where they are many.

    Clusterings pass over the rows up to a hundred times, so a table whose file gives one partition would keep
    one core busy. The rows are written and not persisted, because MLlib keeps plain vectors of its own
    only where its input is not persisted, and otherwise reads every vector anew in each pass.
    """
    rows, width = df.count(), vector_width(df)
    tasks = max(min(df.sparkSession.sparkContext.defaultParallelism, rows // TASK_ROWS), math.ceil(rows * width / TASK_CELLS), 1)
    return materialise(df.repartition(tasks, key).sortWithinPartitions(key))


CLUSTERERS = {
    "kmeans": lambda k: KMeans(k=k, seed=SEED, featuresCol=VECTOR),
    "bisecting": lambda k: BisectingKMeans(k=k, seed=SEED, featuresCol=VECTOR),
    "mixture": lambda k: GaussianMixture(k=k, seed=SEED, featuresCol=VECTOR),
}


def cluster(df: DataFrame, kind: str, k: int) -> DataFrame:
    """Rows with their cluster in ``prediction``."""
    return CLUSTERERS[kind](k).fit(df).transform(df)


def silhouette(clustered: DataFrame) -> float:
    """Squared-distance silhouette from cluster moments: linear in the rows."""
    return ClusteringEvaluator(featuresCol=VECTOR).evaluate(clustered)


def principal_components(df: DataFrame, k: int):
    """PCA model; the covariance is summed on executors and only its square reaches the driver."""
    return PCA(k=k, inputCol=VECTOR, outputCol="components").fit(df)


def singular_values(df: DataFrame, k: int) -> list[float]:
    """Leading singular values of the uncentred rows.

    Up to ``NARROW`` features MLlib finds them; wider rows go by a random range, without a square
    of the features on the driver.
    """
    width = vector_width(df)
    if width > NARROW:
        return leading_singular(df, VECTOR, k, width)[0].tolist()
    return RowMatrix(MLUtils.convertVectorColumnsFromML(df.select(VECTOR), VECTOR)).computeSVD(k).s.toArray().tolist()


def topics(
    df: DataFrame, text: str, k: int, vocabulary: int | None = 2000, iterations: int = 10,
    stop_words: Sequence[str] = (), min_docs: float = 1.0, own: int = OWN_TERMS, shared: int = SHARED_TERMS,
):
    """Topic model of a text column: ``(pipeline model, frame with topicDistribution)``.

    The ``vocabulary`` most frequent terms that ``min_docs`` documents or more hold take part, None:
    all of them, by a count of terms. Where all are over ``own`` terms, the ``own`` most frequent ones
    (ties by name) keep a weight each and the others share ``shared`` weights by their hash, so the
    topics, a matrix on the driver, have at most ``own + shared`` columns. Texts are split
    and counted once. An iteration draws as many of the written counts as there are, with
    replacement, as MLlib's online optimizer does: about 37 % of the documents wait for another one.
    """
    words = [
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"\W+", minTokenLength=2),
        StopWordsRemover(
            inputCol="_tokens", outputCol="_words",
            stopWords=list(stop_words) or StopWordsRemover.loadDefaultStopWords("english"),
        ),
    ]
    prepared = Pipeline(stages=words).fit(df)
    split = materialise(prepared.transform(df).select("_words"))
    counter = [CountVectorizer(inputCol="_words", outputCol=VECTOR, vocabSize=vocabulary or own, minDF=min_docs)]
    if vocabulary is None:
        often = materialise(split.select(F.explode("_words").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")))
        if often.count() > own:
            counter = _own_and_shared(split, often, own, shared, min_docs)
    counted = Pipeline(stages=counter).fit(split)
    vectors = materialise(counted.transform(split).select(VECTOR))
    lda = LDA(k=k, maxIter=iterations, seed=SEED, featuresCol=VECTOR, optimizer="online", subsamplingRate=1.0)
    model = PipelineModel([*prepared.stages, *counted.stages, lda.fit(vectors)])
    return model, model.transform(df)


def _own_and_shared(split: DataFrame, often: DataFrame, own: int, shared: int, min_docs: float) -> list:
    """Stages that count the most frequent terms by name and the rest by hash, in one vector."""
    least = min_docs if min_docs >= 1.0 else min_docs * split.count()
    if least > 1:  # every counted term is in one document
        docs = split.select(F.explode(F.array_distinct("_words")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("docs"))
        often = often.join(docs.where(F.col("docs") >= least), "term")
    terms = [r["term"] for r in often.orderBy(F.desc("n"), "term").limit(own).select("term").collect()]
    return [
        CountVectorizerModel.from_vocabulary(terms, inputCol="_words", outputCol="_own"),
        StopWordsRemover(inputCol="_words", outputCol="_others", stopWords=terms, caseSensitive=True),
        HashingTF(inputCol="_others", outputCol="_shared", numFeatures=shared),
        VectorAssembler(inputCols=["_own", "_shared"], outputCol=VECTOR),
    ]


def describe_topics(model, words: int = 10) -> DataFrame:
    """``(topic, rank, term, weight)`` of the heaviest terms; ``#i`` is the i-th weight that terms share."""
    counts = next(s for s in model.stages if isinstance(s, CountVectorizerModel))
    lda = model.stages[-1]
    found = lda.describeTopics(words)
    used = sorted({i for r in found.collect() for i in r.termIndices})
    terms = counts.vocabulary
    names = F.create_map(*[F.lit(x) for i in used for x in (i, terms[i] if i < len(terms) else f"#{i - len(terms)}")])
    pairs = F.posexplode(F.arrays_zip("termIndices", "termWeights"))
    return found.select("topic", pairs.alias("rank", "x")).select(
        "topic", "rank", F.element_at(names, F.col("x.termIndices")).alias("term"),
        F.col("x.termWeights").alias("weight"),
    )
