"""The near-duplicate stage keeps one of each group linked at a 5-word Jaccard similarity of 0.8."""

import random

import corpus_pipeline
from foldwise.llm import simhash


def changed(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"new{rng.random()}"
    return words


def test_stage_drops_copies_of_similarity_080_and_keeps_others(spark):
    rng = random.Random(11)
    rows, sets = [], []
    for i in range(30):
        base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        for j, edits in enumerate((0, 2, 4, 30)):
            rows.append((4 * i + j, " ".join(changed(rng, base, edits)), "en", "s", 1))
    hub = [f"h{i}" for i in range(300)]
    rows += [(1000 + i, " ".join(changed(rng, hub, 1 + i % 9)), "en", "s", 1) for i in range(300)]
    sets = [frozenset(simhash.shingles(r[1], 5, 42)) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if len(x & sets[j]) >= 0.8 * len(x | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    want = {rows[find(i)][0] for i in range(len(rows))}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) < 200


def test_repeated_id_with_two_texts_is_judged_text_by_text(spark):
    one, two = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(1, one, "en", "s", 1), (1, two, "en", "s", 1), (2, two, "en", "s", 1), (None, two, "en", "s", 1), (3, "", None, None, 0), (4, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_dedup(spark, docs.repartition(3), "").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted([(0, two), (1, one), (1, two), (3, "")])


def test_fingerprints_link_copies_that_share_no_band(spark, monkeypatch):
    from foldwise.llm import minhash

    base = [f"w{i}" for i in range(400)]
    one, bits = " ".join(base), 0
    for i in range(200):  # a tail that turns a few bits
        two = f"{one} tail{i} end{i}"
        bits = ((simhash.fingerprint(one, 5, 42) ^ simhash.fingerprint(two, 5, 42)) & (2**64 - 1)).bit_count()
        if 1 <= bits <= 3:
            break
    assert 1 <= bits <= 3
    rows = [(1, one), (2, two), (3, " ".join(f"x{i}" for i in range(400)))]
    monkeypatch.setattr(minhash, "bands", lambda hashes, seed: [])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in minhash.one_of_each(docs).collect()) == [1, 3]
