"""Removal of repeated passages against brute force over all windows, and against SQL."""

import random

import pytest
from oracle import canonical, connect
from pyspark.sql import functions as F

from foldwise.llm import substrings


def brute(rows, window):
    """doc_id, words and kept words of each row, from a table of all windows."""
    least = {}
    for doc_id, text in rows:
        words = (text or "").split()
        if doc_id is not None:
            for i in range(len(words) - window + 1):
                key = tuple(words[i : i + window])
                least[key] = min(doc_id, least.get(key, doc_id))
    for doc_id, text in rows:
        words = (text or "").split()
        gone = set()
        if doc_id is not None:
            for i in range(len(words) - window + 1):
                if least[tuple(words[i : i + window])] < doc_id:
                    gone.update(range(i, i + window))
        yield doc_id, len(words), " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(rng):
    draw = lambda n, v: [f"w{rng.randrange(v)}" for _ in range(n)]
    passages = [draw(rng.randint(11, 60), 10**6) for _ in range(6)]
    copy = draw(120, 10**6)
    out = []
    for i in range(150):
        words = draw(rng.randint(0, 60), 10**6)
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            words += p[rng.randint(0, 8) : len(p) - rng.randint(0, 8)] + draw(rng.randint(0, 15), 10**6)
        if i % 5 == 0:
            words = list(copy)
            for _ in range(i % 3):
                words[rng.randrange(120)] = f"new{i}"
        if i % 7 == 0:
            words = draw(rng.randint(10, 80), 2)
        if i % 11 == 0:
            words = ["same"] * rng.randint(5, 40)
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("window,seed", [(13, 7), (13, 13), (5, 1), (8, 3)])
def test_kept_words_equal_brute_force(spark, window, seed):
    rng = random.Random(window + seed)
    rows = list(enumerate(texts(rng)))
    rows += [(None, rows[5][1]), (None, rows[5][1]), (7, rows[5][1]), (7, rows[7][1]), (7, rows[7][1]), (400, None), (401, ""), (402, " \t\n"),
             (403, "a\u00a0b " * 30), (404, "long word " * 20_000), (405, "long word " * 20_000)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(d, t, 1, [2]) for d, t in rows], "doc_id long, text string, __keys int, __spans array<int>").repartition(4)
    got = substrings.drop_repeated(docs, ["doc_id"], window, seed).collect()
    ascii_rows = [(d, t.replace("\u00a0", "_") if t else t) for d, t in rows]
    want = [(d, n, k.replace("_", "\u00a0")) for d, n, k in brute(ascii_rows, window)]
    assert sorted(((r.doc_id, r["__n_words"], r["__kept"]) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        spans = [(s.start, s.length) for s in r["__spans"]]
        assert all(n >= window for _, n in spans) and r["__n_words"] - len(r["__kept"].split(" ") if r["__kept"] else []) == sum(n for _, n in spans)
        assert all(a + n < b for (a, n), (b, _) in zip(spans, spans[1:]))
    assert any(r["__spans"] for r in got)


def test_empty_table_and_other_columns(spark):
    docs = spark.createDataFrame([(1, "a " * 20, "x"), (2, "a " * 20, "y")], "doc_id long, text string, lang string")
    assert substrings.drop_repeated(docs.limit(0), ["doc_id"]).count() == 0
    got = {r.lang: r["__kept"] for r in substrings.drop_repeated(docs, ["lang"]).collect()}
    assert got == {"x": " ".join(["a"] * 20), "y": ""}


def test_query_matches_sql(spark, folder):
    got = substrings.op13_substring_dedup(spark, folder).toPandas()
    want = connect(folder).execute(substrings.ORACLE["op13_substring_dedup"]).fetch_df()
    assert canonical(got) == canonical(want) and (got.n_removed > 0).any()
    assert {c: str(t) for c, t in got.dtypes.items()} == {c: str(t) for c, t in want.dtypes.items()}
