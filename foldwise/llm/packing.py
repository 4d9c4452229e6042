"""Best-fit packing of token sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import base64
import functools
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, functions as F

from foldwise.llm.common import materialise, table

SEQUENCE = 1024
END_ID = 2
#: The vocabulary of byte_bpe_50k.json as ranks, which gives the same ids.
VOCABULARY = "byte_bpe_50k.tiktoken"

#: Pieces that are packed together, on average; islands of a block, members of an island.
BLOCK_ITEMS = 4096
ISLANDS, MEMBERS = 3, 5
#: Rounds of evolution, with a migration between any two; generations of a round.
ROUNDS, GENERATIONS = 3, 3
#: Share of a parent's bins, the fullest first, of which half are injected into the other parent.
ELITE_BINS = 0.2
SEED = 11


@functools.cache
def encoder(vocabulary: str = VOCABULARY) -> tiktoken.Encoding:
    """The byte-level BPE of a vocabulary, built once in a Python worker."""
    with open(public_tokenizers.path(vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(text: str | None, vocabulary: str = VOCABULARY) -> bytes:
    """A text's ids as little-endian 32-bit bytes; a NULL text has none."""
    return array("I", encoder(vocabulary).encode_ordinary(text or "")).tobytes()


def cuts(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole sequences, after a first piece with the rest."""
    first = length % size
    return [(0, first)] * bool(first) + [(a, size) for a in range(first, length, size)]


def pieces(docs: DataFrame, size: int = SEQUENCE, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each document's pieces of at most ``size`` ids.

    Texts are encoded whole, then END_ID is appended; a NULL text is empty. Only documents of
    more than ``size`` ids are cut.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    end = array("I", [END_ID]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encoded(text, vocabulary) + end
                    for n, (start, length) in enumerate(cuts(len(ids) // 4, size)):
                        rows.append((doc_id, n, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                columns = zip(*rows)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


class Bins:
    """Bins by free space, for best fit in constant time a piece."""

    def __init__(self, size: int, free: list[int] | None = None):
        self.size, self.free = size, free or []
        self.by_space: list[list[int]] = [[] for _ in range(size + 1)]
        for b, space in enumerate(self.free):
            self.by_space[space].append(b)
        self.spaces = sum([1 << space for space in set(self.free) - {0}])

    def put(self, length: int) -> int:
        """The bin where the least space is left, or a new one."""
        fitting = self.spaces >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            stack = self.by_space[space]
            b = stack.pop()
            if not stack:
                self.spaces ^= 1 << space
            space -= length
        else:
            b, space = len(self.free), self.size - length
            self.free.append(space)
        self.free[b] = space
        if space:
            self.by_space[space].append(b)
            self.spaces |= 1 << space
        return b

    def place(self, items: np.ndarray, lengths: np.ndarray, member: np.ndarray) -> np.ndarray:
        """``member`` with the bins of ``items``, put in their order."""
        put = self.put
        member[items] = [put(length) for length in lengths[items].tolist()]
        return member


def best_fit(lengths: np.ndarray, order: np.ndarray, size: int) -> np.ndarray:
    return Bins(size).place(order, lengths, np.empty(len(lengths), np.int32))


def fills(member: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.bincount(member, lengths)


def fitness(member: np.ndarray, lengths: np.ndarray, size: int) -> tuple[int, float]:
    """Fewer bins first; among as many, the more uneven fill, which leaves room to lose one."""
    fill = fills(member, lengths) / size
    return -len(fill), float((fill * fill).sum())


def cross(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """``a`` with whole well-filled bins of ``b``: bins of ``a`` that hold one of their pieces go,
    with a few of the worst-filled, and the pieces displaced are best-fitted, longest first."""
    full = fills(b, lengths)
    best = np.argsort(-full, kind="stable")[: max(1, int(len(full) * ELITE_BINS))]
    chosen = np.zeros(len(full), bool)
    chosen[best[rng.random(len(best)) < 0.5]] = True
    injected = chosen[b]
    own = fills(a, lengths)
    gone = np.zeros(len(own), bool)
    gone[a[injected]] = True
    gone[np.argsort(own, kind="stable")[: 1 + len(own) // 50]] = True
    displaced = np.flatnonzero(gone[a] & ~injected)
    stays = ~gone[a] | injected
    member = np.full(len(a), -1, np.int32)
    groups, member[stays] = np.unique(np.where(injected, b, a + len(full))[stays], return_inverse=True)
    taken = np.bincount(member[stays], lengths[stays], len(groups))
    by_length = displaced[np.argsort(-lengths[displaced], kind="stable")]
    return Bins(size, (size - taken.astype(np.int64)).tolist()).place(by_length, lengths, member)


def evolve(
    lengths: np.ndarray, members: list[np.ndarray], guest: np.ndarray | None, size: int,
    generations: int, rng: np.random.Generator,
) -> list[np.ndarray]:
    """The island's members after some generations, best first; a guest takes the worst's place."""
    if not members:
        by_length = np.argsort(-lengths, kind="stable")
        members = [best_fit(lengths, by_length, size)]
        while len(members) < MEMBERS:
            blurred = lengths * rng.uniform(0.75, 1.25, len(lengths))
            members.append(best_fit(lengths, np.argsort(-blurred, kind="stable"), size))
    if guest is not None:
        members = [*members[:-1], guest]
    ranked = sorted(members, key=lambda m: fitness(m, lengths, size), reverse=True)
    least = -(-int(lengths.sum()) // size)
    for _ in range(generations):
        if ranked[0].max() + 1 <= least:
            break
        children = []
        for _ in range(MEMBERS):
            i, j = sorted(rng.choice(len(ranked), 2, replace=False)) if len(ranked) > 1 else (0, 0)
            children.append(cross(ranked[i], ranked[j], lengths, size, rng))
        ranked = sorted([*ranked, *children], key=lambda m: fitness(m, lengths, size), reverse=True)[:MEMBERS]
    return ranked


ISLAND = (
    "block long, island int, rids array<long>, lengths array<int>, members array<array<int>>, "
    "guest array<int>, n_bins int, evenness double"
)


def a_round(islands: DataFrame, size: int, r: int) -> DataFrame:
    """Every island, wherever it lies, evolves on its own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                lengths = np.asarray(row.lengths, np.int64)
                old = [] if row.members is None else [np.asarray(m) for m in row.members]
                guest = None if row.guest is None else np.asarray(row.guest)
                rng = np.random.default_rng([SEED, r, int(row.block), int(row.island)])
                ranked = evolve(lengths, old, guest, size, GENERATIONS, rng)
                score = fitness(ranked[0], lengths, size)
                yield pd.DataFrame({
                    "block": [row.block], "island": [row.island], "rids": [row.rids], "lengths": [row.lengths],
                    "members": [[m.astype(np.int32) for m in ranked]], "guest": [None],
                    "n_bins": [-score[0]], "evenness": [score[1]],
                })

    return materialise(islands.mapInPandas(run, ISLAND))


def laid_out(best: DataFrame, size: int) -> DataFrame:
    """__rid, sequence_id (twice the least rid of the bin) and offset of each piece of the best members."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                out = pd.DataFrame({
                    "__rid": np.asarray(row.rids), "length": np.asarray(row.lengths, np.int64),
                    "bin": np.asarray(row.members[0]),
                }).sort_values(["bin", "__rid"])
                bins = out.groupby("bin")
                out["sequence_id"] = bins["__rid"].transform("min") * 2
                out["offset"] = bins["length"].cumsum() - out["length"]
                yield out[["__rid", "sequence_id", "offset"]]

    return best.mapInPandas(run, "__rid long, sequence_id long, offset long")


def pack(found: DataFrame, size: int = SEQUENCE, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``found`` with sequence_id and offset: its pieces (``length`` 1 to ``size``) in few sequences.

    A piece of ``size`` is a sequence of its own. The others are dealt into blocks of
    ``block_items`` on average, by a hash of a row number, so no key can fill one; what a block
    can lose to its border is less than one sequence. Each block is evolved by ISLANDS islands,
    rows that Spark spreads over the tasks, whose best members move to the next island between
    rounds. Every round is written, so a lost executor costs at most that round. Members are
    best-fit-decreasing or better, results are the same for the same rows. An empty table gives
    an empty one; all columns are kept.
    """
    numbered = materialise(found.withColumn("__rid", F.monotonically_increasing_id()))
    rest = numbered.where(F.col("length") < size)
    blocks = max(1, -(-rest.count() // block_items))
    items = rest.select(
        F.pmod(F.xxhash64("__rid"), F.lit(blocks)).alias("block"),
        F.struct("__rid", F.col("length").cast("int").alias("length")).alias("item"),
    ).groupBy("block").agg(F.array_sort(F.collect_list("item")).alias("items"))
    islands = items.select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        F.col("items.__rid").alias("rids"), F.col("items.length").alias("lengths"),
        F.lit(None).cast("array<array<int>>").alias("members"), F.lit(None).cast("array<int>").alias("guest"),
        F.lit(0).alias("n_bins"), F.lit(0.0).alias("evenness"),
    )
    islands = islands.repartition("block", "island")
    for r in range(ROUNDS):
        if r:
            guests = islands.select(
                "block", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("members")[0].alias("guest")
            )
            islands = islands.drop("guest").join(guests, ["block", "island"]).select(
                "block", "island", "rids", "lengths", "members", "guest", "n_bins", "evenness"
            )
        islands = a_round(islands, size, r)
    best = islands.groupBy("block").agg(
        F.max_by(F.struct("rids", "lengths", F.slice("members", 1, 1).alias("members")),
                 F.struct(-F.col("n_bins"), "evenness", -F.col("island"))).alias("b")
    ).select("b.*")
    placed = numbered.where(F.col("length") < size).join(laid_out(best, size), "__rid")
    whole = numbered.where(F.col("length") == size).withColumns(
        {"sequence_id": F.col("__rid") * 2 + 1, "offset": F.lit(0).cast("long")}
    )
    return placed.unionByName(whole).drop("__rid")


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, as pieces of at most 1024 tokens, in sequences of at most 1024."""
    return pack(pieces(table(spark, sf_dir, "documents", "doc_id", "text")))


QUERIES = {"op5_pack": op5_pack}
ORACLE: dict[str, str] = {}
