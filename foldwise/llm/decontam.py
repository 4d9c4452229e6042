"""Benchmark decontamination by pigeonhole edit matching."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from foldwise.llm.common import table

#: Edits allowed per character of a test item.
ERROR_RATE = 0.05
#: Items whose normalised text is shorter are matched without edits, as whole words.
MIN_CHARS = 40
#: Characters of test items that one pass over the documents looks for: what is sent to the tasks.
BLOCK_CHARS = 4_000_000

#: What is returned about a finding.
FINDING = {"item_id": "long", "start": "long", "stop": "long", "distance": "long", "n_item": "long"}
#: Characters that are hashed to find a piece, and the odd multipliers of that hash.
ANCHOR = 12
BASE, MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
WORD = re.compile(r"[^\W_]+")
#: What is between words: other characters than letters and digits, beyond ASCII and in it.
EXOTIC = re.compile(r"[^\w\x00-\x7f]")
BLANKED = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def folded(text: str | None) -> str:
    """``text`` in lower case, character for character."""
    low = (text or "").lower()
    if len(low) != len(text or ""):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return low


def normalised(low: str) -> str:
    """The words of a folded text between single spaces, with a space at either end; "" without any."""
    if not low.isascii():
        low = EXOTIC.sub(" ", low)
    words = low.encode("utf-8", "surrogatepass").translate(BLANKED).split()
    return f" {b' '.join(words).decode('utf-8', 'surrogatepass')} " if words else ""


def places(low: str) -> list[tuple[int, int, int]]:
    """For each word its place in the normalised text, and where it begins and ends in the text."""
    out, at = [], 1
    for m in WORD.finditer(low):
        out.append((at, m.start(), m.end()))
        at += m.end() - m.start() + 1
    return out


def budget(length: int, rate: float = ERROR_RATE, min_chars: int = MIN_CHARS) -> int:
    return int(length * rate) if length >= min_chars else 0


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``item`` cut into errors + 1 near-equal pieces, each with its offset: at most ``errors``
    edits leave at least one of them as it is."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str, errors: int) -> tuple[int, int] | None:
    """Least distance of ``pattern`` to a substring of ``text`` and where that ends (exclusive), or
    None above ``errors``: Myers' bit-parallel columns, with whole numbers as bit vectors."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = errors + 1, -1
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | ~(xh | up) & full
        mh = up & xh
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
        ph, mh = ph << 1 & full, mh << 1 & full
        up, down = mh | ~(xv | ph) & full, ph & xv
        if score < best:
            best, end = score, j + 1
            if not best:
                break
    return (best, end) if best <= errors else None


def reach(pattern: str, text: str, distance: int) -> int:
    """How many characters of ``text``, from its first on, lie at ``distance`` of ``pattern``, where
    that is the least there is: the number closest to the pattern's length, and of two the greater."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best = 0 if m == distance else -m - distance - 1
    for j, c in enumerate(text[: m + distance]):
        eq = masks.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | ~(xh | up) & full
        mh = up & xh
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
        # Each character before the pattern costs one, as the match begins with the text.
        ph, mh = (ph << 1 | 1) & full, mh << 1 & full
        up, down = mh | ~(xv | ph) & full, ph & xv
        if score == distance and abs(j + 1 - m) <= abs(best - m):
            best = j + 1
    return best


def rolling(text: str) -> np.ndarray:
    """A hash of the ANCHOR characters from every place of ``text`` on."""
    h = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    width, power = 1, int(BASE)
    parts = {1: (h, BASE)}
    while width * 2 <= ANCHOR:
        h = h[:-width] * np.uint64(power) + h[width:]
        width, power = width * 2, power * power % (1 << 64)
        parts[width] = (h, np.uint64(power))
    done = width
    while done < ANCHOR:
        step = max(w for w in parts if w <= ANCHOR - done)
        tail, base = parts[step]
        n = len(text) - done - step + 1
        h = h[:n] * base + tail[done : done + n]
        done += step
    return h


class Matcher:
    """The pieces of a block of items, and the search of one text.

    A piece of ANCHOR characters or more is found by the hash of its first ANCHOR characters,
    computed for all places of a text at once, then compared in full; shorter ones by an automaton.
    """

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE, min_chars: int = MIN_CHARS):
        self.items = []
        at: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            whole = normalised(folded(text))
            if not whole:
                continue
            errors = budget(len(whole), rate, min_chars)
            for offset, piece in pieces(whole, errors):
                at.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((item_id, whole, errors))
        self.anchors: dict[int, list[tuple[str, list[tuple[int, int]]]]] = {}
        self.short = ahocorasick.Automaton()
        for piece, uses in at.items():
            if len(piece) >= ANCHOR:
                self.anchors.setdefault(int(rolling(piece[:ANCHOR])[0]), []).append((piece, uses))
            else:
                self.short.add_word(piece, (len(piece), uses))
        if len(self.short):
            self.short.make_automaton()
        # A table of bits, at least 64 for each hash, tells most places apart from all pieces.
        bits = max(16, (64 * len(self.anchors)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.known = np.zeros(1 << bits, bool)
        self.known[(np.array(list(self.anchors), np.uint64) * MIX) >> self.shift] = True

    def hits(self, whole: str) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """Where a piece begins in ``whole``, and the items and offsets it comes from."""
        if self.anchors and len(whole) >= ANCHOR:
            hashes = rolling(whole)
            for place in np.flatnonzero(self.known[(hashes * MIX) >> self.shift]).tolist():
                for piece, uses in self.anchors.get(int(hashes[place]), ()):
                    if whole.startswith(piece, place):
                        yield place, uses
        if len(self.short):
            for end, (length, uses) in self.short.iter(whole):
                yield end - length + 1, uses

    def find(self, text: str | None) -> list[tuple[int, int, int, int, int]]:
        """item_id, start, stop (in ``text``), distance, characters compared, of every item found."""
        low = folded(text)
        whole = normalised(low)
        if not whole or not self.items:
            return []
        windows: dict[int, list[list[int]]] = {}
        for place, uses in self.hits(whole):
            for n, offset in uses:
                _, item, errors = self.items[n]
                begin = place - offset - errors
                stop = begin + len(item) + 2 * errors
                spans = windows.setdefault(n, [])
                if spans and begin <= spans[-1][1] and stop >= spans[-1][0]:
                    spans[-1][0], spans[-1][1] = min(begin, spans[-1][0]), max(stop, spans[-1][1])
                else:
                    spans.append([begin, stop])
        found, words = [], []
        for n, spans in windows.items():
            item_id, item, errors = self.items[n]
            best = None
            for begin, stop in spans:
                begin = max(0, begin)
                hit = myers(item, whole[begin:stop], errors)
                if hit and (best is None or hit[0] < best[0]):
                    best = (hit[0], begin + hit[1])
            if best:
                distance, end = best
                words = words or places(low)
                begin = end - reach(item[::-1], whole[max(0, end - len(item) - distance) : end][::-1], distance)
                last = bisect_left(words, (end - 1,)) - 1
                # A word whose end is all that the stretch holds of it counts as whole.
                first = min(last, max(0, bisect_right(words, (begin + 1, len(low), len(low))) - 1))
                found.append((item_id, words[first][1], words[last][2], distance, len(item)))
        return found


def blocks(items: DataFrame, chars: int) -> Iterator[list[tuple[int, str]]]:
    """The test items, streamed to the driver one partition at a time, in blocks of at most
    ``chars`` characters (or one longer item)."""
    block, size = [], 0
    for row in items.toLocalIterator():
        n = len(row.text or "")
        if block and size + n > chars:
            yield block
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += n
    if block:
        yield block


def matches(
    docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, min_chars: int = MIN_CHARS,
    block_chars: int = BLOCK_CHARS, keep: list[str] | None = None,
) -> DataFrame:
    """One row per row of ``docs`` (``keep`` columns, default doc_id) and test item found in its text.

    Texts are compared as lower-cased words (letters and digits) between single spaces. An item
    is found if some stretch of the text lies within ``rate`` of its length in character edits;
    items below ``min_chars`` characters must appear unchanged. start and stop are that
    stretch in the given text, distance its edits; of several, the first with the fewest. An
    item is cut into one piece more than its edits, so one piece is unchanged; one scan finds
    the pieces, and only the windows around them, joined where they overlap,
    are verified: work stays in proportion to the text.

    Documents are never shuffled: each block of items is sent to all tasks for one pass. NULL or
    wordless texts and items match nothing; of repeated item rows each counts; NULL ids are kept.
    """
    keep = keep or ["doc_id"]
    source = docs.select(*keep, F.col("text").alias("__text"))
    fields = docs.select(*keep).schema
    for name, kind in FINDING.items():
        fields = fields.add(name, kind)
    found = None
    for block in blocks(items.select("item_id", "text"), block_chars):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            matcher = Matcher(sent.value, rate, min_chars)
            for batch in batches:
                at, rows = [], []
                for i, text in enumerate(batch["__text"]):
                    for row in matcher.find(text):
                        at.append(i)
                        rows.append(row)
                out = batch[keep].iloc[at].reset_index(drop=True)
                yield pd.concat([out, pd.DataFrame(rows, columns=list(FINDING))], axis=1)

        part = source.mapInPandas(run, fields)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = source.select(*keep, *[F.lit(None).cast(t).alias(c) for c, t in FINDING.items()]).limit(0)
    return found


def clean(
    docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, min_chars: int = MIN_CHARS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``docs`` in whose ``text`` no test item is found, as :func:`matches` finds them.

    Rows are judged one by one, without a shuffle; NULL ids and repeated rows need no care.
    """
    kept = docs
    for block in blocks(items.select("item_id", "text"), block_chars):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(sent.value, rate, min_chars)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text"))
                yield batch.filter(pa.array([not matcher.find(t.as_py()) for t in texts], pa.bool_()))

        kept = kept.mapInArrow(run, docs.schema)
    return kept


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item found in it, with the stretch and its edits."""
    return matches(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


QUERIES = {"op2_decontaminate": op2_decontaminate}
ORACLE: dict[str, str] = {}
