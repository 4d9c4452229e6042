"""Periodic runs against brute force over all lags."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from foldwise.llm import runs


def brute(words, min_words=24, min_periods=3):
    """Every maximal stretch of every lag, without those of a lesser period."""
    n, found = len(words), {}
    for q in range(1, n // min_periods + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end - at + q >= max(min_words, min_periods * q) and end > at:
                found.setdefault((at, end - at + q), q)
            at = end + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def wordy(rng):
    """A text of random words with repeated stretches, some within others."""
    words = [rng.choice("abcdefgh"[: rng.randint(2, 8)]) for _ in range(rng.randint(0, 60))]
    for _ in range(rng.randint(0, 4)):
        unit = [rng.choice("abcxyz") for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 16, 17, 31, 33, 40]))]
        if rng.random() < 0.3:
            unit = unit * rng.randint(2, 4) + [rng.choice("abc")]
        stretch = (unit * rng.randint(2, 30))[: rng.randint(10, 200)]
        words += stretch + [rng.choice("abqrs") for _ in range(rng.randint(0, 5))]
    return words


@pytest.mark.parametrize("seed", range(8))
def test_all_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(150):
        words = [w.encode() for w in wordy(rng)]
        assert runs.runs_of(runs.numbered(words)) == brute(words)
        assert runs.runs_of(runs.numbered(words), 7, 4) == brute(words, 7, 4)


def test_splitting_loses_no_place_of_a_run():
    rng = random.Random(1)
    for _ in range(100):
        words = [w.encode() for w in wordy(rng)]
        segment = runs.surviving(runs.numbered(words), 24, 3) if words else np.zeros(0)
        for start, length, _ in brute(words):
            assert len(set(segment[start : start + length].tolist())) == 1 and segment[start] >= 0


def test_query_columns_and_edge_rows(spark, tmp_path):
    rng = random.Random(2)
    texts = [" ".join(wordy(rng)) for _ in range(80)]
    texts[:8] = ["", None, " \t\n ", "w " * 30_000, "one", "é ü " * 40, "a\u00a0b " * 24, texts[9]]
    rows = [(i, t, i) for i, t in enumerate(texts)] + [(None, "k " * 24, 1), (None, None, 1), (9, texts[9], 1), (9, "other", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __runs long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, runs.op11_periodic_runs(spark, str(tmp_path)).collect()), key=str)

    def expected(doc_id, text):
        words = [w for w in __import__("re").findall("[^\\x20\\x09-\\x0D]+", text or "")]
        n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = [(0, n, 1)] if len(set(words)) == 1 and n >= 24 else brute(words)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        return (
            doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
        )

    assert got == sorted((expected(d, t) for d, t, _ in rows), key=str)
    assert any(r[1] > 1 for r in got) and runs.find(docs.limit(0), ["doc_id"]).count() == 0
