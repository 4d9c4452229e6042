"""Mutual information by nearest neighbours against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from foldwise.operators import neighbours
from foldwise.operators.neighbours import digamma, mutual_information_nearest
from foldwise.operators.ordered import chunk_carry


def psi(n):
    return sum(1 / i for i in range(1, n)) - 0.57721566490153286061


def brute(rows, k):
    sizes = {}
    for x, _ in rows:
        sizes[x] = sizes.get(x, 0) + 1
    rows = [(x, y) for x, y in rows if sizes[x] > 1]
    total = 0.0
    for i, (x, y) in enumerate(rows):
        near = sorted(abs(y - b) for j, (a, b) in enumerate(rows) if a == x and j != i)
        kk = min(k, len(near))
        d = near[kk - 1]
        m = sum(abs(y - b) < d if d else b == y for _, b in rows)
        total += psi(kk) - psi(sizes[x]) - psi(m)
    return max(0.0, psi(len(rows)) + total / len(rows)) if rows else 0.0


@pytest.mark.parametrize("chunk,parts,k", [(1 << 20, 3, 3), (40, 5, 3), (7, 2, 1), (25, 4, 6)])
def test_equals_brute_force_with_ties(spark, chunk, parts, k):
    rng = random.Random(chunk)
    rows = []
    for i in range(2000 if chunk > 100 else 600):
        x = rng.choice("aaaaabbbccd")
        y = {"a": 0, "b": 20, "c": 40, "d": 60}[x] + (rng.choice([0.0, 0.25, rng.randint(-9, 9)]) if rng.random() < 0.3 else round(rng.gauss(0, 1) * 4096) / 4096)
        rows.append((x if x != "d" else None, f"r{rng.randrange(40)}", float(y) if i % 50 else None))
    rows += [("lone", "r1", 1.0), ("two", "r2", 5.0), ("two", "r2", 5.0)]
    df = spark.createDataFrame(rows, "x string, other string, y double").repartition(parts)
    got = {r.column: r.mi for r in mutual_information_nearest(df, ["x", "other"], "y", k, chunk).collect()}
    for i, c in enumerate(("x", "other")):
        assert got[c] == pytest.approx(brute([(r[i] or "Missing", r[2] or 0.0) for r in rows], k), abs=1e-9)
    assert got["x"] > 0.1


def test_digamma_and_edges(spark):
    rows = spark.range(1, 400).select("id", digamma(F.col("id")).alias("d")).collect()
    assert all(r.d == pytest.approx(psi(r.id), abs=1e-10) for r in rows)
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "x string, y double")
    assert [tuple(r) for r in mutual_information_nearest(df, ["x"], "y").collect()] == [("x", 0.0)]
    assert mutual_information_nearest(df.limit(0), ["x"], "y").first().mi == 0.0
    same = spark.createDataFrame([("a", 1.0)] * 5 + [("b", 1.0)] * 5, "x string, y double")
    assert mutual_information_nearest(same, ["x"], "y").first().mi == pytest.approx(max(0, psi(3) - psi(5)), abs=1e-9)


@pytest.mark.parametrize("chunk,ends", [(400, 1 << 17), (400, 0), (90, 1 << 17), (90, 50)])
def test_borders_of_chunks_are_finished_exactly(spark, chunk, ends):
    rng = random.Random(chunk)
    rows = []
    for _ in range(2500):
        x = rng.choice("aaaaaaaabbbbc")
        y = {"a": 0, "b": 20, "c": 40}[x] + (rng.choice([0.0, rng.randint(-9, 9)]) if rng.random() < 0.1 else round(rng.gauss(0, 4) * 65536) / 65536)
        rows.append((x, rng.choice("pppq"), float(y)))
    df = spark.createDataFrame([*rows, ("far", "q", -5000.0), ("far", "q", 5000.0)], "x string, other string, y double").repartition(4)
    rows += [("far", "q", -5000.0), ("far", "q", 5000.0)]
    got = {r.column: r.mi for r in mutual_information_nearest(df, ["x", "other"], "y", 3, chunk, ends).collect()}
    for i, c in enumerate(("x", "other")):
        assert got[c] == pytest.approx(brute([(r[i], r[2]) for r in rows], 3), abs=1e-9)
    assert got["x"] > 0.1


def test_few_rows_are_asked_again(spark, monkeypatch):
    asked = []

    def carry(df, *args):
        asked.append(df.count())
        return chunk_carry(df, *args)

    monkeypatch.setattr(neighbours, "chunk_carry", carry)
    df = spark.range(20_000).select((F.col("id") % 4).alias("x"), F.pmod(F.col("id") * 7919, F.lit(20_011)).cast("double").alias("y"))
    assert mutual_information_nearest(df, ["x"], "y", 3, 4_000).count() == 1
    assert 0 < asked[0] < 1_000
