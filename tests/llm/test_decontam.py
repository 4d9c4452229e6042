"""Pigeonhole edit matching against plain dynamic programming over every stretch."""

import random

import pytest

from foldwise.llm import decontam as D


def least_edits(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, c in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != c))
    return min(row)


def words(rng, n):
    return " ".join("".join(rng.choice("abcde") for _ in range(rng.randint(2, 7))) for _ in range(n))


def edited(rng, text, edits):
    for _ in range(edits):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + text[i + 1:], text[:i] + "z" + text[i:], text[:i] + "y" + text[i + 1:]])
    return text


@pytest.mark.parametrize("seed", range(6))
def test_myers_is_the_least_distance(seed):
    rng = random.Random(seed)
    for _ in range(60):
        pattern, text = words(rng, 4), words(rng, 9)
        want = least_edits(pattern, text)
        got = D.myers(pattern, text, len(pattern))
        assert got[0] == want
        assert want == min(least_edits(pattern, text[:got[1]]), want)


def test_every_item_within_its_edits_is_found_and_no_other():
    rng = random.Random(5)
    items = [(i, words(rng, rng.choice([3, 12, 30]))) for i in range(25)]
    matcher = D.Matcher(items)
    for _ in range(80):
        item_id, text = rng.choice(items)
        doc = words(rng, 10) + ". " + edited(rng, text, rng.randint(0, 9)) + "; " + words(rng, 10)
        whole = D.normalised(D.folded(doc))
        want = {}
        for i, t in items:
            n = D.normalised(D.folded(t))
            d = least_edits(n, whole)
            if d <= D.budget(len(n)):
                want[i] = d
        assert {f[0]: f[3] for f in matcher.find(doc)} == want


def distances(pattern, text):
    """Edits between the pattern and each prefix of the text."""
    row = list(range(len(text) + 1))
    for i, p in enumerate(pattern, 1):
        left, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (p != t))
    return row


def test_starts_equal_brute_force():
    rng = random.Random(8)
    for _ in range(300):
        pattern = "".join(rng.choice("ab c") for _ in range(rng.randint(5, 14)))
        text = edited(rng, pattern, rng.randint(0, 4)) + "".join(rng.choice("ab c") for _ in range(6))
        row = distances(pattern, text)
        least = min(row)
        ends = [j for j, d in enumerate(row) if d == least]
        assert D.reach(pattern, text, least) == min(ends, key=lambda j: (abs(j - len(pattern)), -j))


def test_an_edited_item_is_given_from_its_first_to_its_last_word():
    item = "the quick brown fox jumps over the lazy dog and runs away"
    doc = "Before it. The qquick brown foxx jumps over the lazy dog and runs away - after"
    ((_, start, stop, distance, _),) = D.Matcher([(1, item)]).find(doc)
    assert distance == 2 and doc[start:stop] == "The qquick brown foxx jumps over the lazy dog and runs away"


def test_stretch_lies_in_the_given_text():
    item = "The QUICK brown fox; jumps over the lazy dog and runs away from it"
    doc = "İntro — text!\nthe quick, brown fox jumps\tover the lazy dog and runs away from it... end"
    ((_, start, stop, distance, _),) = D.Matcher([(1, item)]).find(doc)
    assert distance == 0 and doc[start:stop] == "the quick, brown fox jumps\tover the lazy dog and runs away from it"


def test_edge_rows(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "so: " + item, "y"), (3, "so: " + item, "y"), (None, item, None),
         (4, "word " * 200_000 + item, "z")],
        "doc_id long, text string, item_id string",
    )
    items = spark.createDataFrame([(7, item), (8, None), (9, "!"), (None, item)], "item_id long, text string")
    got = D.matches(docs.withColumnRenamed("item_id", "other"), items).select("doc_id", "item_id").collect()
    assert sorted(got, key=str) == sorted([(3, 7), (3, 7), (None, 7), (4, 7), (3, None), (3, None), (None, None), (4, None)], key=str)
    assert D.matches(docs, items.limit(0)).count() == 0
    assert D.matches(docs.limit(0), items).count() == 0
    blocks = D.matches(docs, items, block_chars=10).count()
    assert blocks == 8
