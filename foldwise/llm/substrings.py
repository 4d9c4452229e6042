"""Repeated passages: documents meet at winnowed seeds, matches are extended both ways and the longest ones go."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from foldwise.llm.common import materialise, release, table

#: Words of the shortest passage that counts as repeated.
WINDOW = 13
#: Words of a seed.
SEED_WORDS = 5
#: Rows whose texts are seeded together, up to about so many bytes of text.
SLICE, SLICE_BYTES = 256, 1 << 20
#: Words that are hashed at once.
BLOCK = 1 << 16
#: Odd factors, of bytes within a word, of words within a seed, and of the seeds' order.
BYTE, WORD, ORDER = np.uint64(0x100000001B3), np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Seeded:
    """The words of some texts, and the seeds that their windows chose.

    Each window of ``window`` words chooses the seed (run of ``seed`` words) of least hash in it,
    the last of equals, so a window's choice is the same wherever it stands. ``low`` is the first
    window of a seed and ``high`` the word behind its last one, counted over all texts: the seed
    extended both ways to all that its windows cover. ``first`` is each text's first word, with
    the number of all words at the end.
    """

    words: list[bytes]
    first: np.ndarray
    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    joined: bytes
    begin: np.ndarray
    end: np.ndarray

    def text_of(self) -> np.ndarray:
        """The number of each seed's text."""
        return np.searchsorted(self.first, self.low, "right") - 1

    def keys(self, which: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Rows (anchor, digest of the words from low to high) for the seeds ``which``."""
        joined, digest = self.joined, xxhash.xxh64_intdigest
        spans = zip(self.begin[low].tolist(), self.end[high - 1].tolist())
        own = np.fromiter((digest(joined[a:b]) for a, b in spans), np.uint64, len(low))
        return np.stack([self.anchor[which], own.view(np.int64)], 1)

    def stretches(self) -> np.ndarray:
        return self.keys(np.arange(len(self.low)), self.low, self.high)

    def windows(self, which: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The seeds' windows: their seed, first word and key."""
        n = self.high[which] - window + 1 - self.low[which]
        seed = np.repeat(which, n)
        low = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.low[seed]
        return seed, low, self.keys(seed, low, low + window)


def hashed(joined: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of ``joined``, by blocks of words."""
    raw = np.frombuffer(joined, np.uint8)
    parts = []
    for at in range(0, len(begin), BLOCK):
        low, high = begin[at : at + BLOCK], end[at : at + BLOCK]
        lengths = high - low + 1  # with the space behind, which counts nothing
        powers = np.cumprod(np.full(int(lengths.max()), BYTE), dtype=np.uint64)
        place = np.arange(int(lengths.sum())) - np.repeat(low - low[0], lengths)
        block = raw[low[0] : high[-1]].astype(np.uint64) * powers[place[: high[-1] - low[0]]]
        block[high[:-1] - low[0]] = 0
        parts.append(np.add.reduceat(block, low - low[0]))
    out = np.concatenate(parts)
    return (out ^ (out >> np.uint64(29))) * ORDER


def seeded(texts: list[str | None], window: int, seed: int) -> Seeded:
    """The seeds of some texts; one of under ``window`` words (or NULL) has none."""
    split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    words = [w for part in split for w in part]
    first = np.cumsum([0, *map(len, split)])
    n, none = len(words), np.zeros(0, np.int64)
    if n < window:
        return Seeded(words, first, none, none, none, b"", none, none)
    joined = b" ".join(words)
    end = np.append(np.flatnonzero(np.frombuffer(joined, np.uint8) == 32), len(joined))
    begin = np.append(0, end[:-1] + 1)
    each = hashed(joined, begin, end)
    grams = np.zeros(n - seed + 1, np.uint64)
    for i in range(seed):
        grams = grams * WORD + each[i : n - seed + 1 + i]
    grams = (grams ^ (grams >> np.uint64(31))) * ORDER
    width = window - seed + 1
    views = np.lib.stride_tricks.sliding_window_view(grams, width)
    starts = np.flatnonzero(np.searchsorted(first, np.arange(n - window + 1), "right")
                            == np.searchsorted(first, np.arange(window - 1, n), "right"))
    chosen = starts + (width - 1) - views[starts, ::-1].argmin(1)
    at = np.flatnonzero(np.diff(chosen, prepend=-1))
    last = np.append(at[1:], len(starts)) - 1
    return Seeded(words, first, grams[chosen[at]].view(np.int64), starts[at], starts[last] + window, joined, begin, end)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch by rows, and by the bytes of the texts in column 1, so that long texts come alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and (held + size > SLICE_BYTES or i - start >= SLICE):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def anchors(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """doc_id and each ``anchor`` (seed's hash) of every row once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = seeded(part.column(1).to_pylist(), window, seed)
                ids = part.column(0).to_numpy(zero_copy_only=False)[found.text_of()]
                order = np.lexsort([found.anchor, ids])
                rows = np.column_stack([ids, found.anchor])[order]
                rows = rows[np.append(True, (rows[1:] != rows[:-1]).any(1))[: len(rows)]]
                yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], ["doc_id", "anchor"])

    return docs.mapInArrow(run, "doc_id long, anchor long")


def stretches(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """doc_id, ``anchor`` and the digest ``h`` of each seed's stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = seeded(part.column(1).to_pylist(), window, seed)
                ids, keys = part.column(0).to_numpy(zero_copy_only=False)[found.text_of()], found.stretches()
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys[:, 0]), pa.array(keys[:, 1])], ["doc_id", "anchor", "h"])

    return docs.mapInArrow(run, "doc_id long, anchor long, h long")


def windows(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """doc_id, anchor and digest of each window of the stretches that ``__keys`` names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = seeded(part.column(1).to_pylist(), window, seed)
                which, _, keys = found.windows(named_seeds(found, part.column(2)), window)
                ids = part.column(0).to_numpy(zero_copy_only=False)[found.text_of()[which]]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys[:, 0]), pa.array(keys[:, 1])], ["doc_id", "anchor", "h"])

    return docs.mapInArrow(run, "doc_id long, anchor long, h long")


def named_in(keys: pa.Scalar) -> set[bytes]:
    """The (anchor, digest) pairs of a list as bytes, none for NULL."""
    if not keys.is_valid:
        return set()
    pairs = keys.values
    return as_bytes(np.stack([pairs.field(0).to_numpy(), pairs.field(1).to_numpy()], 1), set)


def as_bytes(keys: np.ndarray, kind=list):
    raw = keys.tobytes()
    return kind(raw[i : i + 16] for i in range(0, len(raw), 16))


def named_seeds(found: Seeded, lists: pa.Array) -> np.ndarray:
    """The seeds whose stretch their text's list names."""
    named = [named_in(x) for x in lists]
    return np.flatnonzero(np.fromiter(
        (key in named[t] for key, t in zip(as_bytes(found.stretches()), found.text_of().tolist(), strict=True)), bool, len(found.low)
    ))


def gone_in(found: Seeded, lists: pa.Array, window: int) -> np.ndarray:
    """Which words lie in a stretch, or in a window of another one, that their text's list names."""
    edges = np.zeros(len(found.words) + 1, np.int64)
    whole = named_seeds(found, lists)
    np.add.at(edges, found.low[whole], 1)
    np.add.at(edges, found.high[whole], -1)
    listed = np.fromiter((x.is_valid for x in lists), bool, len(lists))
    rest = np.setdiff1d(np.flatnonzero(listed[found.text_of()]), whole)
    seed, low, keys = found.windows(rest, window)
    named = {t: named_in(lists[t]) for t in np.unique(found.text_of()[rest]).tolist()}
    hit = np.fromiter(
        (key in named[t] for key, t in zip(as_bytes(keys), found.text_of()[seed].tolist(), strict=True)), bool, len(seed)
    )
    np.add.at(edges, low[hit], 1)
    np.add.at(edges, low[hit] + window, -1)
    return np.cumsum(edges[:-1]) > 0


def later_holders(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows (doc_id, anchor, h): each key with its ``least`` document, and the rows of later documents.

    Keys are counted by partial aggregates, and only those of several documents are joined back;
    the optimiser splits the tasks of a key that very many documents hold.
    """
    known = rows.groupBy("anchor", "h").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    again = known.where("least < most").select("anchor", "h", "least")
    return known.select("anchor", "h", "least"), (
        rows.join(again.hint("merge"), ["anchor", "h"]).where("doc_id > least").select("doc_id", "anchor", "h")
    )


def by_document(rows: DataFrame) -> DataFrame:
    """doc_id and its keys as ``__keys``: no more than its texts have windows."""
    return rows.groupBy("doc_id").agg(F.collect_set(F.struct("anchor", "h")).alias("__keys"))


def repeated(docs: DataFrame, window: int = WINDOW, seed: int = SEED_WORDS) -> DataFrame:
    """doc_id and ``__keys``, what an earlier document (doc_id, text; no NULL ids) holds too: keys of stretches and of windows.

    Documents meet at their seeds: seeds that one document alone holds are dropped first, by a
    count. A seed is extended both ways to its stretch, all words of the windows that chose it.
    Inside a passage that documents share their stretches are the same, so one aggregate finds the
    least document of each, and all later ones have it repeated as a whole: a group of copies costs
    a row a copy and seed, never a pair. Where a seed has several stretches, as at the ends of a
    passage, each distinct stretch is opened once, by the least document that holds it, and its
    windows are counted likewise. No window is lost: all that hold it chose its seed in it. A key
    is the seed's 64-bit hash with a 64-bit digest of all words.
    """
    text, spark = docs.select("doc_id", "text"), docs.sparkSession
    shared = materialise(
        anchors(text, window, seed).groupBy("anchor")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("anchor")
    )
    release(spark)
    met = materialise(stretches(text, window, seed).join(shared.hint("merge"), "anchor", "left_semi").select("doc_id", "anchor", "h"))
    release(spark)
    known, whole = later_holders(met)
    known = materialise(known)
    several = known.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    opened = known.join(several.hint("merge"), "anchor", "left_semi").select(F.col("least").alias("doc_id"), "anchor", "h")
    parts = materialise(windows(text.join(by_document(opened).hint("merge"), "doc_id"), window, seed))
    release(spark)
    _, partly = later_holders(parts)
    return materialise(by_document(whole.unionByName(partly)))


def drop_repeated(docs: DataFrame, keep: list[str], window: int = WINDOW, seed: int = SEED_WORDS) -> DataFrame:
    """``keep`` columns of every row of ``docs`` (doc_id bigint, text), ``__n_words``, ``__spans`` and ``__kept``.

    A window is ``window`` consecutive words, as ASCII white space separates them; it is repeated if
    a document of smaller doc_id holds the same words, before anything is removed. ``__spans`` are
    the maximal stretches (start, length) of words that repeated windows cover, each at least
    ``window`` long, and ``__kept`` is the rest, joined by one space.

    Rows without an id come neither before nor after any, so they lose nothing and count for
    nothing. Rows of one id, alike or not, never count against each other, and each is judged by
    its own text. NULL, empty and short texts have no windows; an empty table gives an empty one.
    A document's keys are the only thing that is gathered, in one row of it.
    """
    named = docs.where("doc_id IS NOT NULL")
    found = repeated(named, window, seed)
    release(docs.sparkSession)
    both = named.select(*keep, "doc_id", "text") if "doc_id" not in keep else named.select(*keep, "text")
    rows = both.join(found.hint("merge"), "doc_id", "left").select(*keep, F.col("text").alias("__text"), "__keys")
    rest = docs.where("doc_id IS NULL").select(*keep, F.col("text").alias("__text"))
    rows = rows.unionByName(rest.withColumn("__keys", F.lit(None).cast(rows.schema["__keys"].dataType)))
    span = StructType([StructField("start", LongType()), StructField("length", LongType())])
    schema = StructType(rows.select(*keep).schema.fields + [
        StructField("__n_words", LongType()), StructField("__spans", ArrayType(span)), StructField("__kept", StringType()),
    ])
    # The text comes second, as :func:`slices` wants it.
    rows = rows.select("__keys", "__text", *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        for batch in batches:
            for part in slices(batch):
                lists = part.column(0)
                found = seeded(part.column(1).to_pylist(), window, seed)
                gone = gone_in(found, lists, window) if lists.null_count < len(lists) else np.zeros(len(found.words), bool)
                spans, kept, first = [], [], found.first.tolist()
                for a, b, held in zip(first, first[1:], lists):
                    own = gone[a:b] if held.is_valid else np.zeros(0, bool)
                    turns = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0)).reshape(-1, 2).tolist()
                    spans.append([{"start": x, "length": y - x} for x, y in turns])
                    words = found.words[a:b]
                    kept.append(b" ".join([words[i] for i in np.flatnonzero(~own).tolist()] if turns else words))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[2:], pa.array(np.diff(found.first), pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary()).cast(pa.string())],
                    [*keep, "__n_words", "__spans", "__kept"],
                )

    return rows.mapInArrow(run, schema)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages of 13 or more words that an earlier one holds."""
    found = drop_repeated(table(spark, sf_dir, "documents", "doc_id", "text"), ["doc_id"])
    return found.selectExpr(
        "doc_id", "__n_words AS n_words", "aggregate(__spans, 0L, (n, s) -> n + s.length) AS n_removed",
        "sha2(__kept, 256) AS kept_sha256",
    )


QUERIES = {"op13_substring_dedup": op13_substring_dedup}
ORACLE = {
    "op13_substring_dedup": rf"""
WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS MATERIALIZED (
  SELECT row, doc_id, i, array_to_string(ws[i : i + {WINDOW - 1}], ' ') AS win
  FROM (SELECT row, doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM texts)
), least AS (
  SELECT win, min(doc_id) AS least FROM windows GROUP BY win
), gone AS (
  SELECT DISTINCT row, unnest(range(i, i + {WINDOW})) AS j FROM windows w JOIN least l ON w.win = l.win WHERE doc_id > least
), words AS (
  SELECT row, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM texts
), kept AS (
  SELECT w.row, count(*) AS n, string_agg(word, ' ' ORDER BY w.j) AS k
  FROM words w LEFT JOIN gone g ON g.row = w.row AND g.j = w.j WHERE g.j IS NULL GROUP BY w.row
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k, '')) AS kept_sha256 FROM texts t LEFT JOIN kept k ON k.row = t.row""",
}
