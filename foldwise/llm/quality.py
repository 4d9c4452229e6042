"""Quality by a sparse rule ensemble: tree paths over statistics as rules, weighted by lasso logistic regression."""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foldwise.llm.common import labelled_sample, remainder, table

#: The bound of the training sample: rows of each class.
PER_CLASS = 6000
THRESHOLD = 0.7
#: Trees, their depth, the rows and statistics each sees, and the least rows of a leaf.
TREES, DEPTH, ROWS_SHARE, FEATURES, LEAF = 30, 3, 0.5, 8, 8
#: Weight of the absolute values in the lasso, and its steps.
LASSO, STEPS = 4e-3, 400
SEED = 4

#: Classes of a text's UTF-8 bytes; bytes beyond ASCII count as letters.
OTHER, SPACE, LOWER, UPPER, DIGIT, STOP, MARK = range(7)
BYTE_CLASS = np.full(256, LOWER, np.uint8)
for _class, _bytes in (
    (OTHER, bytes(range(32)) + b"\x7f"), (SPACE, b" \t\n\r\x0b\x0c"), (UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (DIGIT, b"0123456789"), (STOP, b".,;:'\"()-"), (MARK, b"!?$%&*#@+=~^<>{}[]|\\/_`"),
):
    BYTE_CLASS[list(_bytes)] = _class

STATISTICS = (
    "log_chars", "log_words", "word_length", "distinct_words", "repeats_before", "upper_share", "digit_share",
    "letter_share", "mark_share", "shout_share", "pipe_share", "odd_share", "common_share", "line_words", "line_again",
)
#: Frequent short words of four languages.
COMMON_WORDS = frozenset((
    "the of and to in is that for it as was with be by on not he are this at from or have an they "
    "de la que el en y los se del las un por con una para es al lo como "
    "le et les des du dans qui pour pas au sur ne ce plus par avec son "
    "der die und den von zu das mit sich ist dem nicht ein eine auf für im auch"
).split())


def statistic_values(text: str) -> tuple[float, ...]:
    """The STATISTICS of a whole text; shares of nothing are 0."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = BYTE_CLASS[raw]
    count = np.bincount(kinds, minlength=7).tolist()
    words, lines = text.split(), text.split("\n")
    n, solid = max(1, len(words)), max(1, sum(count) - count[SPACE])
    marked = int(np.count_nonzero((kinds[:-1] == MARK) & (kinds[1:] == SPACE))) + bool(len(kinds) and kinds[-1] == MARK)
    return (
        math.log1p(len(text)), math.log1p(len(words)), solid / n, len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n, count[UPPER] / solid, count[DIGIT] / solid,
        (count[LOWER] + count[UPPER]) / solid, count[MARK] / solid, sum(map(str.isupper, words)) / n,
        words.count("|") / n, marked / n, sum(map(COMMON_WORDS.__contains__, words)) / n,
        len(words) / len(lines), 1 - len(set(lines)) / len(lines),
    )


def statistics(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) of every row of ``docs`` and the STATISTICS of its whole ``text`` as
    ``__s_<name>``. A NULL text counts as empty."""
    keep = keep or docs.columns
    names = [f"__s_{n}" for n in STATISTICS]
    source = docs.select(*keep, F.col("text").alias("__text"))
    schema = docs.select(*keep).schema
    for name in names:
        schema = schema.add(name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [statistic_values(t.as_py() or "") for t in batch.column(batch.num_columns - 1)]
            columns = np.array(values, float).reshape(-1, len(names)).T
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(c) for c in columns]], [*batch.schema.names[:-1], *names]
            )

    return source.mapInArrow(run, schema)


class Rule(tuple):
    """A conjunction of (statistic, is it above, threshold) along a path of a tree."""

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, above, cut in self:
            column = x[:, names.index(name)]
            out &= (column > cut) if above else (column <= cut)
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for name, above, cut in self:
            c = F.col(f"__s_{name}")
            out = out & ((c > F.lit(cut)) if above else (c <= F.lit(cut)))
        return out


def paths(x: np.ndarray, y: np.ndarray, w: np.ndarray, names: list[str], rng: np.random.Generator) -> list[Rule]:
    """Every path from the root, also the inner ones, of a tree that splits by Gini impurity."""
    found: list[Rule] = []

    def grow(rows: np.ndarray, path: tuple) -> None:
        if path:
            found.append(Rule(path))
        if len(path) == DEPTH or len(rows) < 2 * LEAF or len(set(y[rows])) < 2:
            return
        best = (1e-9, None, None)
        for f in rng.choice(len(names), min(FEATURES, len(names)), replace=False):
            order = rows[np.argsort(x[rows, f], kind="stable")]
            v, wy, ww = x[order, f], np.cumsum(w[order] * y[order]), np.cumsum(w[order])
            at = np.flatnonzero(v[1:] > v[:-1])
            at = at[(at + 1 >= LEAF) & (len(rows) - at - 1 >= LEAF)]
            if not len(at):
                continue
            l1, l = wy[at], ww[at]
            r1, r = wy[-1] - l1, ww[-1] - l
            parent = wy[-1] * (ww[-1] - wy[-1]) / ww[-1]
            gain = (parent - l1 * (l - l1) / l - r1 * (r - r1) / r) / ww[-1]
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (gain[i], f, float((v[at[i]] + v[at[i] + 1]) / 2))
        _, f, cut = best
        if f is None:
            return
        for above in (False, True):
            side = rows[(x[rows, f] > cut) == above]
            grow(side, (*path, (names[f], above, cut)))

    rows = np.sort(rng.choice(len(x), max(2 * LEAF, int(len(x) * ROWS_SHARE)), replace=True))
    grow(np.unique(rows), ())
    return found


class Ensemble:
    """Rules, their weights and a bias: the score is the logistic function of their sum."""

    def __init__(self, rules: list[Rule], weights: list[float], bias: float):
        self.rules, self.weights, self.bias = rules, weights, bias

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, names: list[str]) -> Ensemble:
        """Both classes weigh alike in the trees; the lasso, solved by FISTA, sees the rows as they are."""
        if len(y) < 4 * LEAF or len(set(y.tolist())) < 2:
            rate = (y.sum() + 1) / (len(y) + 1.25)
            return cls([], [], float(np.log(rate / max(1 - rate, 1e-3))))
        rng = np.random.default_rng(SEED)
        w = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, len(y) - y.sum())) * len(y)
        kept: dict[bytes, Rule] = {}
        for _ in range(TREES):
            for rule in paths(x, y, w, names, rng):
                on = rule.holds(x, names)
                if LEAF <= on.sum() <= len(y) - LEAF:
                    kept.setdefault(np.packbits(on).tobytes(), rule)
        rules = list(kept.values())
        if not rules:
            rate = y.mean()
            return cls([], [], float(np.log(rate / (1 - rate))))
        z = np.column_stack([r.holds(x, names) for r in rules]).astype(float)
        spread = z.std(0)
        a = np.column_stack([z / spread, np.ones(len(y))])
        step = 4 * len(y) / np.linalg.norm(a, 2) ** 2
        beta = momentum = np.zeros(a.shape[1])
        t = 1.0
        for _ in range(STEPS):
            p = 1 / (1 + np.exp(-np.clip(a @ momentum, -30, 30)))
            new = momentum - step * (a.T @ (p - y)) / len(y)
            new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * LASSO, 0)
            t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
            momentum = new + (t - 1) / t_new * (new - beta)
            beta, t = new, t_new
        used = np.flatnonzero(beta[:-1])
        return cls([rules[i] for i in used], [float(beta[i] / spread[i]) for i in used], float(beta[-1]))

    def column(self) -> Column:
        """The score as a column over the statistics of :func:`statistics`."""
        total = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights):
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def train(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2) -> Ensemble:
    """An ensemble for ``labels.quality`` from at most 2 * PER_CLASS rows; without both classes the score is constant."""
    sample = F.broadcast(labelled_sample(labels, "quality", modulus, held_out, PER_CLASS))
    names = list(STATISTICS)
    rows = (
        statistics(docs.select("doc_id", "text").join(sample, "doc_id").dropDuplicates(), ["doc_id", "label"])
        .limit(2 * PER_CLASS).collect()
    )
    rows.sort()
    x = np.array([r[2:] for r in rows], float).reshape(len(rows), len(names))
    return Ensemble.fit(x, np.array([r.label for r in rows], float), names)


def score(docs: DataFrame, model: Ensemble, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) of ``docs`` with ``__score``: 0 to 1, higher for better texts.

    Empty and NULL texts are scored by their statistics too; every row is kept once.
    """
    keep = keep or docs.columns
    return statistics(docs, keep).select(*keep, model.column().alias("__score"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, ["doc_id"]).select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"),
    )


QUERIES = {"op4_quality": op4_quality}
ORACLE: dict[str, str] = {}
