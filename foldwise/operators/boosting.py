"""Second-order gradient boosting over binned features, leaf by leaf, as grouped aggregates of gradient sums.

Rows are binned once and keep their scores, which every round renews. A pass over them sums, inside
each task, the gradients, curvatures and rows of every bin of the nodes that may split next. Few sums
(AT_ONCE bins) are added on the driver, which then needs those of the smaller of two siblings only;
more are added by feature, and the task that holds a feature finds its best splits, one row a task and
node. A tree takes a pass a level, for all classes at once.
"""

from __future__ import annotations

import copy
import heapq
import math
from collections import namedtuple
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.session import shared_dir

FEATURES, LABEL, PREDICTION, PROBABILITY, RAW = "features", "label", "prediction", "probability", "rawPrediction"
#: Gradients are whole multiples of this, so their sums are exact in doubles for 2 ** 27 rows of the
#: largest gradient, and the same however the rows are dealt.
UNIT = 2.0**-26
#: Bins whose sums one task keeps at once (24 bytes each); more nodes than that take another pass.
CELLS = 1 << 22
#: Bins whose sums the driver adds, and bytes of them that it takes from the tasks at once.
AT_ONCE, COLLECTED = 1 << 18, 1 << 26
#: Rows x features that a task passes over, unless cores would be idle: below that the start of a task costs more.
SHARE = 1 << 24
#: Rows x features that a task passes over at least: to start a task for fewer costs more than their sums.
LEAST = 1 << 20
#: Rounds after which the scores are written, so that lost ones need no more rounds than that.
REMEMBERED = 20
#: A row holds a block of rows, a column after the other as bytes: passing rows one by one costs more than their sums.
ROWS = "bins binary, y binary, row binary, held binary, score binary"


@dataclass(frozen=True)
class Settings:
    """How trees grow. ``leaves`` limits a tree's leaves, ``depth`` its levels (None: no limit).

    ``penalty`` is added to a leaf's curvature, ``min_gain`` must be exceeded by a split's gain,
    and both sides of a split need ``min_rows`` rows and ``min_weight`` curvature. Each tree sees a
    ``row_share`` of the rows, by a hash of the row, and a ``column_share`` of the features.
    """

    rounds: int = 100
    rate: float = 0.1
    depth: int | None = 6
    leaves: int | None = None
    penalty: float = 1.0
    min_gain: float = 0.0
    min_rows: int = 1
    min_weight: float = 0.0
    row_share: float = 1.0
    column_share: float = 1.0
    bins: int = 64
    seed: int = 42

    def __post_init__(self):
        if not 2 <= self.bins <= 256 or self.rounds < 0 or not (0 < self.row_share <= 1 and 0 < self.column_share <= 1):
            raise ValueError("2 to 256 bins, no negative rounds, shares above 0 and up to 1")
        if self.depth is None and self.leaves is None:
            raise ValueError("a tree needs a limit of its depth or its leaves")


#: The sums of a node and its best split, whose gain is minus infinity if none is allowed.
Split = namedtuple("Split", "k node all_g all_h all_n gain feature bin left_g left_h left_n")


@dataclass
class Node:
    """A node while its tree grows: its sums, and its best split once that is known."""

    depth: int
    g: float
    h: float
    n: int
    gain: float | None = None
    feature: int = -1
    bin: int = -1
    left: tuple[float, float, int] | None = None
    children: tuple[int, int] | None = None
    parent: int = -1


@dataclass
class Tree:
    """Nodes as arrays; ``feature`` is -1 at a leaf. A row goes left if its bin is up to ``bin``."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def leaf(self, columns) -> np.ndarray:
        """The leaf of each row; ``columns(rows, features, nodes)`` says who goes left."""
        node = np.zeros(columns.n, np.int64)
        open_ = np.arange(columns.n if self.feature[0] >= 0 else 0)
        while len(open_):
            at = node[open_]
            left = columns(open_, self.feature[at], self.bin[at])
            node[open_] = np.where(left, self.left[at], self.right[at])
            open_ = open_[self.feature[node[open_]] >= 0]
        return node


class Binned:
    def __init__(self, bins: np.ndarray):
        self.bins, self.n = bins, len(bins)

    def __call__(self, rows, features, bins):
        return self.bins[rows, features] <= bins


class Valued:
    """Raw feature values against the cut point that ends a bin; a NaN goes right, as its bin is the last."""

    def __init__(self, values: np.ndarray, cuts: list[np.ndarray]):
        self.values, self.n = values, len(values)
        self.offset = np.cumsum([0, *map(len, cuts)])[:-1]
        self.flat = np.concatenate(cuts) if cuts else np.zeros(0)

    def __call__(self, rows, features, bins):
        return self.values[rows, features] <= self.flat[self.offset[features] + bins]


def cut_points(df: DataFrame, bins: int) -> list[np.ndarray]:
    """Per feature the upper ends of its bins: up to ``bins`` - 1 quantiles.

    All features share one pass; a task keeps a sketch a feature, and the driver gets
    ``bins`` numbers each. NaN counts for none.
    """
    shares = [i / bins for i in range(1, bins)]
    values = df.select(F.posexplode(vector_to_array(FEATURES)).alias("f", "x")).where(~F.isnan("x"))
    rows = values.groupBy("f").agg(F.percentile_approx("x", shares, 100 * bins).alias("q")).collect()
    width = width_of(df)
    out = [np.zeros(0)] * width
    for r in rows:
        out[r.f] = np.unique(np.array(r.q, float))
    return out


def width_of(df: DataFrame) -> int:
    known = df.schema[FEATURES].metadata.get("ml_attr", {}).get("num_attrs")
    if known:
        return known
    row = df.select(F.size(vector_to_array(FEATURES))).first()
    return row[0] if row else 0


def binned(df: DataFrame, cuts: list[np.ndarray], label: str, held: str | None) -> DataFrame:
    """Blocks of rows: a byte a feature, the labels, hashes and whether they are held out, all as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            out = np.empty(values.shape, np.uint8)
            for f, ends in enumerate(cuts):
                out[:, f] = np.searchsorted(ends, values[:, f])
            y, row, out_of = (c.to_numpy(zero_copy_only=False) for c in batch.columns[1:])
            if batch.num_rows:
                yield block(out, y, row, out_of.astype(bool))

    rows = df.where(F.col(label).isNotNull()).select(
        vector_to_array(FEATURES).alias("x"), F.col(label).cast("double").alias("y"), F.xxhash64(*df.columns).alias("row"),
        (F.coalesce(F.col(held).cast("boolean"), F.lit(False)) if held else F.lit(False)).alias("held"),
    )
    return rows.mapInArrow(run, ROWS)


def block(bins: np.ndarray, y: np.ndarray, row: np.ndarray, held: np.ndarray, score: np.ndarray | None = None) -> pa.RecordBatch:
    parts = [bins, y, row, held, score]
    return pa.RecordBatch.from_arrays(
        [pa.array([None if x is None else np.ascontiguousarray(x).tobytes()], pa.binary()) for x in parts],
        ["bins", "y", "row", "held", "score"],
    )


class Block:
    """The arrays of one block of rows; ``score`` is None before any were written."""

    def __init__(self, cells: dict, width: int):
        self.y = np.frombuffer(cells["y"], np.float64)
        self.bins = np.frombuffer(cells["bins"], np.uint8).reshape(len(self.y), width)
        self.row = np.frombuffer(cells["row"], np.int64)
        self.held = np.frombuffer(cells["held"], bool)
        self.score = None if cells["score"] is None else np.frombuffer(cells["score"], np.float64).reshape(len(self.y), -1)

    def scored(self, score: np.ndarray) -> Block:
        out = copy.copy(self)
        out.score = score
        return out


def shared_out(rows: DataFrame, cells: int) -> DataFrame:
    """``rows`` in a task a core, or as many tasks as keep SHARE of all ``cells`` each; never in more than they are in."""
    return rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, -(-cells // SHARE)))


@dataclass
class State:
    """What a pass needs besides the rows: the objective, the start, and trees not yet in the scores."""

    task: str
    classes: int
    base: np.ndarray
    scale: float
    width: int
    settings: Settings
    recent: list[list[Tree]] = field(default_factory=list)

    def scores(self, part: Block, columns: Binned) -> np.ndarray:
        out = np.tile(self.base, (len(part.y), 1)) if part.score is None else part.score.copy()
        for trees in self.recent:
            for k, tree in enumerate(trees):
                out[:, k] += tree.value[tree.leaf(columns)]
        return out

    def gradients(self, y: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and second derivatives of the loss, in multiples of UNIT; squares in units of ``scale``."""
        if self.task == "regression":
            g, h = (score - y[:, None]) / self.scale, np.ones_like(score)
        elif self.classes == 1:
            p = 1 / (1 + np.exp(-score))
            g, h = p - y[:, None], p * (1 - p)
        else:
            p = softmax(score)
            g = p - (y[:, None] == np.arange(self.classes))
            h = p * (1 - p) * self.classes / (self.classes - 1)
        return np.rint(g / UNIT), np.rint(h / UNIT)

    def loss(self, y: np.ndarray, score: np.ndarray) -> np.ndarray:
        if self.task == "regression":
            return ((score[:, 0] - y) / self.scale) ** 2
        if self.classes == 1:
            return np.logaddexp(0, np.where(y > 0.5, -score[:, 0], score[:, 0]))
        return -np.log(np.maximum(softmax(score)[np.arange(len(y)), y.astype(int)], 1e-15))

    def sampled(self, row: np.ndarray, number: int) -> np.ndarray:
        """Which rows the ``number``-th round sees."""
        if self.settings.row_share >= 1:
            return np.ones(len(row), bool)
        mixed = row.view(np.uint64) ^ np.uint64((self.settings.seed << 32) + number + 1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
        return (mixed >> np.uint64(11)) * 2.0**-53 < self.settings.row_share

    def features(self, number: int) -> np.ndarray:
        """The features that the ``number``-th round sees."""
        share = self.settings.column_share
        if share >= 1:
            return np.arange(self.width)
        rng = np.random.default_rng([self.settings.seed, number])
        return np.sort(rng.choice(self.width, max(1, round(share * self.width)), replace=False))


def softmax(score: np.ndarray) -> np.ndarray:
    e = np.exp(score - score.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def sums(rows: RDD, state: State, trees: list[Tree], active: list[tuple[int, int]], number: int) -> RDD:
    """A task's sums of g, h (both in UNITs) and n by ``active`` (class, node), feature and bin, as one array."""
    bins, chosen = state.settings.bins, state.features(number)
    slot_of = [np.full(len(tree.feature), -1) for tree in trees]
    for slot, (k, node) in enumerate(active):
        slot_of[k][node] = slot
    shape = (3, len(active), len(chosen), bins)

    def run(parts: Iterator[Block]) -> Iterator[np.ndarray]:
        total = np.zeros(shape)
        for some in parts:
            columns = Binned(some.bins)
            g, h = state.gradients(some.y, state.scores(some, columns))
            seen = ~some.held & state.sampled(some.row, number)
            for k, tree in enumerate(trees):
                if not (slot_of[k] >= 0).any():
                    continue
                slot = slot_of[k][tree.leaf(columns)]
                mine = np.flatnonzero(seen & (slot >= 0))
                first, here, weights = slot[mine] * bins, some.bins[mine], (g[mine, k], h[mine, k], None)
                for at, feature in enumerate(chosen):
                    cell = first + here[:, feature]
                    for i, weight in enumerate(weights):
                        total[i, :, at] += np.bincount(cell, weight, shape[1] * bins).reshape(-1, bins)
        yield total

    return rows.mapPartitions(run)


def added(parts: RDD, shape: tuple[int, ...]) -> np.ndarray:
    """The sum of the tasks' arrays of a shape."""
    zero = np.zeros(shape)
    if parts.getNumPartitions() * zero.nbytes > COLLECTED:
        return parts.treeReduce(np.add)
    return sum(parts.collect(), zero)


def best_splits(total: np.ndarray, active: list[tuple[int, int]], chosen: np.ndarray, settings: Settings) -> list[Split]:
    """Per active class and node its sums and its best split, ties to the first feature and bin."""
    rows = max(settings.min_rows, 1)
    left = np.cumsum(total, axis=3) * np.array([UNIT, UNIT, 1.0]).reshape(3, 1, 1, 1)
    whole = left[..., -1:]
    term = lambda g, h: np.divide(g * g, h + settings.penalty, out=np.zeros(g.shape), where=h + settings.penalty > 0)
    right = whole - left
    gain = term(left[0], left[1]) + term(right[0], right[1]) - term(whole[0], whole[1])
    allowed = (left[2] >= rows) & (right[2] >= rows) & (left[1] >= settings.min_weight) & (right[1] >= settings.min_weight)
    gain = np.where(allowed, gain, -np.inf).reshape(len(active), -1)
    out = []
    # The first of the greatest, in the order of features and bins.
    for slot, at in enumerate(gain.argmax(1)):
        f, b = divmod(int(at), settings.bins)
        (ag, ah, an), (lg, lh, ln) = whole[:, slot, f, 0].tolist(), left[:, slot, f, b].tolist()
        out.append(Split(*active[slot], ag, ah, int(an), float(gain[slot, at]), int(chosen[f]), b, lg, lh, int(ln)))
    return out


def splits_by_feature(parts: RDD, active: list[tuple[int, int]], chosen: np.ndarray, settings: Settings) -> list[Split]:
    """:func:`best_splits` where a task adds the sums of some features; the driver picks from one row a task and node."""

    def run(found: Iterator[tuple[int, np.ndarray]]) -> Iterator[Split]:
        mine = sorted(found, key=lambda x: x[0])
        if mine:
            yield from best_splits(np.stack([x for _, x in mine], 2), active, chosen[[at for at, _ in mine]], settings)

    by_feature = parts.flatMap(lambda total: [(at, total[:, :, at]) for at in range(len(chosen))])
    best: dict[tuple[int, int], Split] = {}
    for x in by_feature.reduceByKey(np.add, min(len(chosen), parts.getNumPartitions())).mapPartitions(run).collect():
        old = best.get((x.k, x.node))
        if old is None or (x.gain, -x.feature) > (old.gain, -old.feature):
            best[x.k, x.node] = x
    return list(best.values())


class Growing:
    """A tree that grows best-first.

    Splits are known only where a pass has looked. Those that best-first growth would take now,
    were all unknown ones worthless, are looked into next; any other can only lose by what the
    unknown turn out to be, so the tree is that of growth leaf by leaf.
    """

    def __init__(self, settings: Settings):
        self.settings, self.nodes = settings, [Node(0, 0.0, 0.0, 0)]
        self.unknown = [0]

    def learn(self, split: Split) -> None:
        x = self.nodes[split.node]
        x.g, x.h, x.n = split.all_g, split.all_h, split.all_n
        x.gain, x.feature, x.bin = split.gain, split.feature, split.bin
        x.left = (split.left_g, split.left_h, split.left_n)

    def taken(self) -> list[int]:
        """The known splits of best-first growth, in order."""
        limit = self.settings.leaves or math.inf
        depth = self.settings.depth if self.settings.depth is not None else math.inf
        heap, out = [], []

        def offer(i: int) -> None:
            x = self.nodes[i]
            if x.gain is not None and x.gain > self.settings.min_gain and x.depth < depth:
                heapq.heappush(heap, (-x.gain, i))

        offer(0)
        while heap and len(out) + 1 < limit:
            _, i = heapq.heappop(heap)
            out.append(i)
            for child in self.nodes[i].children or ():
                offer(child)
        return out

    def grow(self) -> None:
        """Open the splits that are taken now; their children are to be looked into."""
        depth = self.settings.depth if self.settings.depth is not None else math.inf
        self.unknown = []
        for i in self.taken():
            x = self.nodes[i]
            if x.children is None:
                g, h, n = x.left
                x.children = (len(self.nodes), len(self.nodes) + 1)
                self.nodes += [Node(x.depth + 1, g, h, n, parent=i), Node(x.depth + 1, x.g - g, x.h - h, x.n - n, parent=i)]
                if x.depth + 1 < depth:
                    self.unknown += x.children

    def tree(self, splits: set[int], scale: float = 1.0) -> Tree:
        """The nodes as arrays, split where ``splits`` says."""
        rows = []
        for i, x in enumerate(self.nodes):
            down = x.h + self.settings.penalty
            value = -self.settings.rate * scale * x.g / down if down > 0 else 0.0
            inner = i in splits
            left, right = x.children if inner else (0, 0)
            rows.append((x.feature if inner else -1, x.bin if inner else 0, left, right, value, x.gain if inner else 0.0))
        a = np.array(rows, float)
        return Tree(*(a[:, i].astype(np.int64) for i in range(4)), a[:, 4], a[:, 5])


def grow_round(rows: RDD, state: State, number: int) -> list[Tree]:
    """One tree a class, grown side by side: each pass looks into the unknown nodes of all of them."""
    growing = [Growing(state.settings) for _ in range(state.classes)]
    chosen = state.features(number)
    cells = max(1, len(chosen) * state.settings.bins)
    known: dict[tuple[int, int], np.ndarray] = {}
    while any(x.unknown for x in growing):
        trees = [x.tree({i for i, n in enumerate(x.nodes) if n.children}) for x in growing]
        wanted = [(k, i) for k, x in enumerate(growing) for i in x.unknown]
        if len(wanted) * cells <= min(AT_ONCE, CELLS):
            known = node_sums(rows, state, growing, trees, wanted, known, number)
            found = best_splits(np.stack([known[x] for x in wanted], 1), wanted, chosen, state.settings)
        else:
            known, found, room = {}, [], max(1, CELLS // cells)
            for start in range(0, len(wanted), room):
                part = wanted[start : start + room]
                found += splits_by_feature(sums(rows, state, trees, part, number), part, chosen, state.settings)
        for r in found:
            growing[r.k].learn(r)
        for x in growing:
            x.grow()
    return [x.tree(set(x.taken()), state.scale) for x in growing]


def node_sums(
    rows: RDD, state: State, growing: list[Growing], trees: list[Tree], wanted: list[tuple[int, int]],
    known: dict[tuple[int, int], np.ndarray], number: int,
) -> dict[tuple[int, int], np.ndarray]:
    """The sums of the ``wanted`` nodes and of all ``known``; the larger child is its parent less the other. All are exact."""
    asked, rest = [], []
    for k, i in wanted:
        nodes = growing[k].nodes
        parent = nodes[i].parent
        if (k, parent) not in known:
            asked.append((k, i))
            continue
        a, b = nodes[parent].children
        small = a if nodes[a].n <= nodes[b].n else b
        if i == small:
            asked.append((k, i))
        else:
            rest.append((k, i, parent, small))
    shape = (3, len(asked), len(state.features(number)), state.settings.bins)
    total = added(sums(rows, state, trees, asked, number), shape)
    out = {x: total[:, slot] for slot, x in enumerate(asked)}
    out |= {(k, i): known[k, parent] - out[k, small] for k, i, parent, small in rest}
    return out


def held_loss(rows: RDD, state: State) -> float:
    """Mean loss of the held-out rows, from one sum a task."""

    def run(parts: Iterator[Block]) -> Iterator[tuple[float, int]]:
        total, n = 0.0, 0
        for some in parts:
            total += float(state.loss(some.y, state.scores(some, Binned(some.bins)))[some.held].sum())
            n += int(some.held.sum())
        yield total, n

    found = rows.mapPartitions(run).collect()
    n = sum(x[1] for x in found)
    return math.fsum(x[0] for x in found) / n if n else math.nan


class Boosted(Estimator):
    """Boosted trees for a class code (``classes`` of two or more) or, with none, a number.

    Two classes have one tree a round, more have one a class over their softmax. With ``held``, a
    boolean column, its rows train nothing; growth stops once their loss has not fallen by more
    than ``tolerance`` for ``patience`` rounds, and the rounds up to the least loss are kept.
    """

    def __init__(
        self, settings: Settings = Settings(), classes: int | None = None, label: str = LABEL,
        held: str | None = None, patience: int = 10, tolerance: float = 0.0,
    ):
        super().__init__()
        self.settings, self.classes, self.label = settings, classes, label
        self.held, self.patience, self.tolerance = held, patience, tolerance

    def start(self, df: DataFrame, width: int) -> State:
        """The scores before the first round, and the unit of the gradients, from one aggregate."""
        seen = df.select(F.col(self.label).cast("double").alias("y")).where("y IS NOT NULL")
        if self.classes is None:
            low, high, mean = seen.agg(F.min("y"), F.max("y"), F.avg("y")).first()
            reach = max(high - mean, mean - low) if mean is not None else 1.0
            scale = 2.0 ** math.ceil(math.log2(reach)) if reach > 0 else 1.0
            return State("regression", 1, np.array([mean or 0.0]), scale, width, self.settings)
        counts = {int(r.y): r["count"] for r in seen.groupBy("y").count().collect()}  # a row a class
        n = sum(counts.values())
        share = np.array([(counts.get(k, 0) + 1e-3) / (n + 1e-3 * max(self.classes, 2)) for k in range(max(self.classes, 2))])
        if self.classes <= 2:
            return State("classification", 1, np.log(share[1:] / share[:1]), 1.0, width, self.settings)
        return State("classification", self.classes, np.log(share), 1.0, width, self.settings)

    @staticmethod
    def rescored(rows: RDD, state: State, trees: list[Tree], write: bool) -> RDD:
        """The rows with the scores after ``trees``, kept, and also written if ``write``."""
        now = replace(state, recent=[trees])
        out = rows.map(lambda x: x.scored(now.scores(x, Binned(x.bins)))).persist(StorageLevel.MEMORY_AND_DISK)
        if write:
            if out.context.getCheckpointDir() is None:
                out.context.setCheckpointDir(shared_dir(SparkSession.active()))
            out.checkpoint()
            out.count()
        return out

    def _fit(self, df: DataFrame) -> BoostedModel:
        seen = df.where(~F.coalesce(F.col(self.held).cast("boolean"), F.lit(False))) if self.held else df
        cuts = cut_points(seen, self.settings.bins)
        width = len(cuts)
        cells = df.count() * width
        rows = shared_out(binned(df, cuts, self.label, self.held), cells).rdd.map(lambda r: Block(r.asDict(), width))
        rows = rows.coalesce(max(1, -(-cells // LEAST))).persist(StorageLevel.MEMORY_AND_DISK)
        state = self.start(seen, width)
        whole = self.settings.row_share >= 1 and self.settings.column_share >= 1
        rounds: list[list[Tree]] = []
        best, losses = 0, []
        kept = [rows]
        try:
            for number in range(self.settings.rounds if state.width else 0):
                trees = grow_round(rows, state, number)
                while len(kept) > 1:
                    kept.pop(0).unpersist()
                if whole and all(t.feature[0] < 0 for t in trees):
                    break  # no later round could split either
                rounds.append(trees)
                rows = self.rescored(rows, state, trees, len(rounds) % REMEMBERED == 0)
                kept.append(rows)
                if self.held:
                    losses.append(held_loss(rows, state))
                    if losses[-1] < losses[best] - self.tolerance:
                        best = number
                    if number - best >= self.patience:
                        break
        finally:
            for x in kept:
                x.unpersist()
        if self.held and rounds:
            rounds = rounds[: best + 1]
        return BoostedModel(rounds, cuts, state.base, self.classes, losses)


class BoostedModel(Model):
    """Adds the prediction and, for classes, the probabilities and raw scores as vectors."""

    def __init__(self, rounds: list[list[Tree]], cuts: list[np.ndarray], base: np.ndarray, classes: int | None, losses: list[float]):
        super().__init__()
        self.rounds, self.cuts, self.base, self.classes, self.losses = rounds, cuts, base, classes, losses

    @property
    def getNumTrees(self) -> int:  # MLlib's name
        return len(self.rounds)

    @property
    def featureImportances(self):  # MLlib's name
        """Each feature's share of the gain of all splits."""
        total = np.zeros(len(self.cuts))
        for trees in self.rounds:
            for t in trees:
                inner = t.feature >= 0
                np.add.at(total, t.feature[inner], t.gain[inner])
        return Vectors.dense(total / total.sum() if total.sum() > 0 else total)

    def raw(self, values: np.ndarray) -> np.ndarray:
        columns = Valued(values, self.cuts)
        out = np.tile(self.base, (len(values), 1))
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                out[:, k] += tree.value[tree.leaf(columns)]
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        model = self

        @F.pandas_udf("array<double>")
        def scored(x: pd.Series) -> pd.Series:
            values = np.stack(x.to_list()) if len(x) else np.zeros((0, len(model.cuts)))
            raw = model.raw(values)
            if model.classes is not None:
                raw = np.hstack([-raw, raw]) if raw.shape[1] == 1 else raw
                raw = np.hstack([raw, softmax(raw) if raw.shape[1] > 2 else 1 / (1 + np.exp(-raw))])
            return pd.Series(list(raw))

        out = df.withColumn("__scored", scored(vector_to_array(FEATURES)))
        if self.classes is None:
            return out.withColumn(PREDICTION, F.col("__scored")[0]).drop("__scored")
        k = max(self.classes, 2)
        likely = F.slice("__scored", k + 1, k)
        return out.withColumns({
            RAW: array_to_vector(F.slice("__scored", 1, k)), PROBABILITY: array_to_vector(likely),
            PREDICTION: (F.array_position(likely, F.array_max(likely)) - 1).cast("double"),
        }).drop("__scored")
