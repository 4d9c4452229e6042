"""Periodic runs of words: texts fall apart at words too rare to repeat, and what is left is scanned for lags."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from foldwise.llm.common import table

#: A run is at least so many words and so many periods long.
MIN_WORDS, MIN_PERIODS = 24, 3
#: Rows whose results are sent at once.
SLICE = 256

Words = list[bytes]
#: start, length and period of a run, in words.
Run = tuple[int, int, int]


def words_of(text: str | None) -> Words:
    """What ASCII white space separates; a NULL text has none."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def numbered(words: Words) -> np.ndarray:
    """A number for each word, the same for the same words."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def surviving(ids: np.ndarray, min_words: int, min_periods: int) -> np.ndarray:
    """The first word's place of the segment each place lies in, -1 where no run can be.

    A run of ``min_periods`` periods holds each of its words at least as often, so a word rarer
    than that within its segment splits the segment. The pieces that a round has made are counted
    anew, until none splits; pieces under ``min_words`` are done. A segment that did not change is
    not counted again.
    """
    segment = np.full(len(ids), -1, np.int64)
    places, of = np.arange(len(ids)), np.zeros(len(ids), np.int64)
    span = int(ids.max()) + 1 if len(ids) else 1
    while len(places):
        _, inverse, counts = np.unique(of * span + ids[places], return_inverse=True, return_counts=True)
        rare = counts[inverse] < min_periods
        # Segments without a rare word are stable.
        touched = np.unique(of[rare])
        split = np.isin(of, touched, assume_unique=False)
        segment[places[~split]] = of[~split]
        places = places[split & ~rare]
        if not len(places):
            break
        # A piece ends where a place is missing; neighbouring segments lie apart by a place at least.
        starts = np.flatnonzero(np.diff(places, prepend=-2) > 1)
        lengths = np.diff(np.append(starts, len(places)))
        long = lengths >= min_words
        places, of = places[np.repeat(long, lengths)], np.repeat(places[starts[long]], lengths[long])
    return segment


def doubled(grams: np.ndarray, by: int) -> np.ndarray:
    """Numbers of the runs of 2 * ``by`` words from numbers of those of ``by``."""
    left, right = grams[:-by], grams[by:]
    return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1]


def runs_of(ids: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[Run]:
    """All maximal runs of ``ids`` by start, then period: at least ``min_words`` words and ``min_periods`` (3 or more) periods long.

    The surviving segments are scanned an octave of lags at a time: for lags above k / 2 and up to
    k, the lag at which the k words from each place occurred last. No shorter lag can hide a run's
    period, because k words of it fix the period; so places in a row with one lag are a run, and
    each run is found in the one octave of its period. The first octave holds all lesser lags too:
    with ``min_words`` of 24 that of 16 words, which a run of any lesser period has twice.
    """
    if min_periods < 3 or min_words < 3:
        raise ValueError("a run has 3 periods and 3 words at least")
    if len(ids) < min_words:
        return []
    segment = surviving(ids, min_words, min_periods)
    places = np.flatnonzero(segment >= 0)
    if not len(places):
        return []
    # Segments side by side, with a number between any two that occurs once.
    first = np.flatnonzero(np.diff(segment[places], prepend=-1))
    gap = int(ids.max()) + 1 + np.arange(len(first))
    grams, places = np.insert(ids[places], first, gap), np.insert(places, first, -1)
    found: list[Run] = []
    whole, first_octave, n = 1, octave(min_words, min_periods), len(grams)
    while True:
        if whole >= first_octave:
            above = 0 if whole == first_octave else whole // 2
            found += repeated_at(grams, places, whole, above, min_words, min_periods)
            if min_periods * whole >= n:
                break
        if np.bincount(grams).max() < 2:
            break
        grams, whole = doubled(grams, whole), 2 * whole
    return sorted(found, key=lambda r: (r[0], r[2]))


def octave(min_words: int, min_periods: int) -> int:
    """The largest power of two k such that every run of a period q up to k holds q + k words."""
    return 1 << max(0, (min_words * (min_periods - 1) // min_periods).bit_length() - 1)


def repeated_at(
    grams: np.ndarray, places: np.ndarray, whole: int, above: int, min_words: int, min_periods: int
) -> list[Run]:
    """Runs whose period is over ``above`` and up to ``whole``, from the lags of grams of ``whole`` words."""
    order = np.argsort(grams, kind="stable")
    lag = np.zeros(len(grams), np.int64)
    alike = grams[order[1:]] == grams[order[:-1]]
    lag[order[1:][alike]] = (order[1:] - order[:-1])[alike]
    lag[(lag <= above) | (lag > whole)] = 0
    at = np.flatnonzero(lag)
    if not len(at):
        return []
    begins = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(lag[at], prepend=0) != 0))
    stretch = np.diff(np.append(begins, len(at)))
    period = lag[at[begins]]
    start, length = at[begins] - period, stretch + whole - 1 + period
    kept = (length >= min_words) & (length >= min_periods * period)
    return list(zip(places[start[kept]].tolist(), length[kept].tolist(), period[kept].tolist()))


def left_after(runs: list[Run], n: int) -> np.ndarray:
    """Which of ``n`` words stay when of every run only the first period does."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) == 0


def longest(runs: list[Run]) -> Run | None:
    """The run of most periods, compared exactly; of those the one of least start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find(
    docs: DataFrame, keep: list[str], min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS,
    change: Callable[[Words, tuple], Words] | None = None,
) -> DataFrame:
    """``keep`` columns of every row of ``docs``, its ``__runs`` (start, length, period, by start) and ``__collapsed``.

    Words are what ASCII white space separates, over whole texts. A run is a stretch of words with
    a smallest period, at least ``min_words`` words and ``min_periods`` periods long, that no
    neighbouring word extends. ``__collapsed`` is the text without what follows the first period
    of any run, its words joined by one space. ``change`` may alter the words of a row, given its
    ``keep`` values. NULL, empty and blank texts give no runs and an empty text; repeated rows are
    judged one by one; an empty table gives an empty one. A row depends on itself alone, so
    nothing is shuffled, and a task holds one text's words and a few numbers for each.
    """
    schema = docs.select(*keep).schema
    each = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])
    schema = schema.add("__runs", ArrayType(each)).add("__collapsed", "string")
    source = docs.select(*keep, F.col("text").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found, texts = [], []
                rows = zip(*(c.to_pylist() for c in part.columns[:-1]), strict=True)
                for row, text in zip(rows, part.column(part.num_columns - 1), strict=True):
                    words = words_of(text.as_py())
                    if change is not None:
                        words = change(words, row)
                    runs = runs_of(numbered(words), min_words, min_periods)
                    if runs:
                        stays = left_after(runs, len(words))
                        words = [words[i] for i in np.flatnonzero(stays).tolist()]
                    found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                    texts.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(found, pa.list_(RUN)), pa.array(texts, pa.binary()).cast(pa.string())],
                    [*part.schema.names[:-1], "__runs", "__collapsed"],
                )

    return source.mapInArrow(run, schema)


def planted(words: Words, doc_id: int | None) -> Words:
    """The words with a period planted from some place on, in a tenth of the documents: by crc32 of the id."""
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def digests(found: DataFrame) -> DataFrame:
    """The columns of :func:`op11_periodic_runs` from the rows of :func:`find`."""
    # An array's order is start, then period; the run of most periods comes from exact products.
    better = "x.length * best.period > best.length * x.period"
    best = f"aggregate(__runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>), (best, x) -> IF(best IS NULL OR {better}, x, best))"
    listed = "array_join(transform(__runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return found.selectExpr("doc_id", "__runs", "__collapsed", f"{best} AS __best").selectExpr(
        "doc_id", "CAST(size(__runs) AS BIGINT) AS n_runs", "__best.start", "__best.length", "__best.period",
        "1000 * __best.length div __best.period AS exponent_milli",
        f"sha2({listed}, 256) AS runs_sha256", "sha2(__collapsed, 256) AS collapsed_sha256",
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, with periods planted in a tenth of them."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return digests(find(docs, ["doc_id"], change=lambda words, row: planted(words, row[0])))


QUERIES = {"op11_periodic_runs": op11_periodic_runs}
ORACLE: dict[str, str] = {}
