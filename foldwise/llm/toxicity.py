"""Toxicity by multiple-instance learning: sentences, joined by noisy-or, learnt from document labels."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from foldwise.llm.common import labelled_sample, remainder, table

#: The bound of the training sample: rows of each class, and characters of a text in it.
PER_CLASS = 3000
SAMPLE_CHARS = 20_000
#: Rows of the hashed weight table, and what of a word is hashed besides the word: its beginnings.
DIMENSIONS = 1 << 18
BEGINNINGS = (4, 5, 6, 7, 8)
#: Full-batch proximal Adam: steps, rate, and weight of the absolute values.
STEPS, RATE, SPARSITY = 250, 0.1, 0.2
#: Words in more than this share of the clean texts say nothing; their weight is zero.
COMMON = 0.02
#: Words whose score a task remembers.
REMEMBERED = 400_000
#: Sentences from this score on are reported.
OFFENDING = 0.5

SENTENCE, WORD = re.compile(r"[^.!?\n\w]*\w[^.!?\n]*"), re.compile(r"\w+")


def features(word: str) -> list[int]:
    """Rows of the weight table for a lower-cased word: itself and, where it is longer, its first bytes."""
    key = word.encode("utf-8", "surrogatepass")
    rows = [crc32(key, 1) % (DIMENSIONS - 1) + 1]
    for n in BEGINNINGS:
        if len(key) <= n:
            break
        rows.append(crc32(key[:n]) % (DIMENSIONS - 1) + 1)
    return rows


def sentences(text: str) -> Iterator[tuple[int, int, set[str]]]:
    """Start, stop and distinct words of each sentence with a word."""
    for m in SENTENCE.finditer(text):
        yield m.start(), m.end(), set(WORD.findall(m.group().lower()))


class Model:
    """A sentence's log odds are the bias and the sum of its distinct words' weights; a document is
    clean if every sentence is."""

    def __init__(self, weights: np.ndarray, bias: float, common: list[str]):
        self.weights, self.bias, self.common = weights, bias, common

    @classmethod
    def fit(cls, texts: list[str], labels: list[int]) -> Model:
        """Least logarithmic loss of the noisy-or over documents, with few weights, none below zero:
        no word makes another sentence clean."""
        rows: dict[str, int] = {}
        tokens, firsts, doc_of = [], [], []
        for d, text in enumerate(texts):
            for _, _, words in sentences(text):
                firsts.append(len(tokens))
                doc_of.append(d)
                tokens += [rows.setdefault(w, len(rows)) for w in sorted(words)]
        if not firsts or len(set(labels)) < 2:
            rate = (sum(labels) + 0.5) / (len(labels) + 1)
            return cls(np.zeros(DIMENSIONS, np.float32), float(np.log(rate / (1 - rate))) - 10 * (rate < 0.5), [])
        n, y = len(texts), np.array(labels, float)
        tokens_, firsts_, doc = np.array(tokens, np.int32), np.array(firsts), np.array(doc_of)
        sizes = np.diff(firsts_, append=len(tokens_))
        held = np.unique(np.repeat(doc, sizes).astype(np.int64) * len(rows) + tokens_)
        in_clean = np.bincount(held[y[held // len(rows)] == 0] % len(rows), minlength=len(rows))
        common = [w for w, i in rows.items() if in_clean[i] > COMMON * max(50, (y == 0).sum())]
        table_ = np.zeros((len(rows), 1 + len(BEGINNINGS)), np.int32)  # row 0 of the weights stays zero
        for w, i in rows.items():
            f = features(w)
            table_[i, : len(f)] = f
        table_[[rows[w] for w in common]] = 0
        weights, bias = np.zeros(DIMENSIONS), -4.0
        m1, m2, b1, b2 = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), 0.0, 0.0
        for step in range(1, STEPS + 1):
            word_score = weights[table_].sum(1)
            z = np.clip(bias + np.add.reduceat(word_score[tokens_], firsts_), -30, 30)
            p = 1 / (1 + np.exp(-z))
            clean = np.exp(-np.bincount(doc, np.logaddexp(0, z), n))
            pull = np.where(y > 0, -clean / np.maximum(1 - clean, 1e-6), 1.0)
            g = pull[doc] * p
            by_word = np.bincount(tokens_, np.repeat(g, sizes), len(rows))
            grad = np.bincount(table_.ravel(), np.repeat(by_word, table_.shape[1]), DIMENSIONS)
            grad[0] = 0
            gb = g.sum()
            m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad * grad
            b1, b2 = 0.9 * b1 + 0.1 * gb, 0.99 * b2 + 0.01 * gb * gb
            c1, c2 = 1 - 0.9**step, 1 - 0.99**step
            scale = RATE / (np.sqrt(m2 / c2) + 1e-2)
            weights -= scale * m1 / c1
            weights = np.maximum(weights - scale * SPARSITY, 0)
            bias -= RATE * (b1 / c1) / (np.sqrt(b2 / c2) + 1e-2)
        return cls(weights.astype(np.float32), float(bias), common)


class Scorer(dict):
    """Word scores, remembered for the first words seen."""

    def __init__(self, model: Model):
        super().__init__(dict.fromkeys(model.common, 0.0))
        self.weights = {int(i): float(model.weights[i]) for i in np.flatnonzero(model.weights)}
        self.bias = model.bias

    def __missing__(self, word: str) -> float:
        score = sum([self.weights.get(f, 0.0) for f in features(word)])
        if len(self) < REMEMBERED:
            self[word] = score
        return score

    def document(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score and its offending sentences (start, stop, score)."""
        telling = {}
        for w in set(WORD.findall((text or "").lower())):
            if s := self[w]:
                telling[w] = s
        if not telling:
            n = len(SENTENCE.findall(text or ""))
            return -math.expm1(-n * math.log1p(math.exp(self.bias))), []
        spans, held = self.located(text, telling)
        clean = math.log1p(math.exp(self.bias)) * (len(held) - len(spans))
        offending = []
        for i in sorted(held):
            z = min(30.0, self.bias + sum([telling[w] for w in held[i]]))
            clean -= math.log1p(math.exp(z))
            if (p := 1 / (1 + math.exp(-z))) >= OFFENDING:
                offending.append((*spans[i], p))
        return -math.expm1(clean), offending

    def located(self, text: str, telling: dict[str, float]) -> tuple[list[tuple[int, int]], dict[int, set[str]]]:
        """All sentences, and for those with telling words which of them they hold."""
        low, held = text.lower(), {}
        if len(low) != len(text):
            found = list(sentences(text))
            return [f[:2] for f in found], {
                i: f[2] & telling.keys() for i, f in enumerate(found) if f[2] & telling.keys()
            }
        spans = [m.span() for m in SENTENCE.finditer(low)]
        starts = [a for a, _ in spans]
        for w in telling:
            at = low.find(w)
            while at >= 0:
                end = at + len(w)
                if not (at and WORD.match(low, at - 1, at)) and not WORD.match(low, end, end + 1):
                    held.setdefault(bisect_right(starts, at) - 1, set()).add(w)
                at = low.find(w, end)
        return spans, held


def train(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0) -> Model:
    """A model of ``labels.toxic`` from at most 2 * PER_CLASS texts of at most SAMPLE_CHARS characters.

    Longer texts and NULL texts aren't learnt from; without both classes the score is constant.
    """
    sample = F.broadcast(labelled_sample(labels, "toxic", modulus, held_out, PER_CLASS))
    rows = (
        docs.select("doc_id", "text").where(F.length("text") <= SAMPLE_CHARS).join(sample, "doc_id")
        .dropDuplicates().select("doc_id", "text", "label").limit(2 * PER_CLASS).collect()
    )
    rows.sort(key=lambda r: (r.doc_id, r.text))
    return Model.fit([r.text for r in rows], [r.label for r in rows])


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id), score and offending sentences of every row of ``docs``.

    Whole texts are read; a NULL, empty or wordless text scores 0. offending holds start, stop and
    score of each sentence of OFFENDING or more, in order.
    """
    keep = keep or ["doc_id"]
    source = docs.select(*keep, F.col("text").alias("__text"))
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
        + ["score double", "offending array<struct<start:bigint,stop:bigint,score:double>>"]
    )
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            found = [scorer.document(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            offending = [[{"start": a, "stop": b, "score": p} for a, b, p in f[1]] for f in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([f[0] for f in found], pa.float64()), pa.array(offending, kind)],
                [*batch.schema.names[:-1], "score", "offending"],
            )

    return source.mapInArrow(run, schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, and where it is."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending",
    )


QUERIES = {"op3_toxicity": op3_toxicity}
ORACLE: dict[str, str] = {}
