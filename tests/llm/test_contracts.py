"""Every registered query and stage on given tables and on edge rows; those with SQL against it."""

import random

import corpus_pipeline
import numpy as np
import pytest
import xxhash
from oracle import compare, connect

from foldwise.llm import packing, registry, simhash

COLUMNS = {
    "op1_html_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op3_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5_pack": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
                 "sequence_id": "bigint", "offset": "bigint"},
    "op8_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op11_periodic_runs": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint",
                           "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string"},
}
ROWS = {"op1_html_text": "pages", "op3_toxicity": "documents", "op4_quality": "documents", "op8_simhash": "documents", "op11_periodic_runs": "documents"}


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_query_gives_its_columns_for_every_row(spark, folder, name):
    found = registry.QUERIES[name](spark, folder)
    have = dict(found.dtypes)
    assert COLUMNS.get(name, {}).items() <= have.items()
    n = found.count()
    if name in ROWS:
        assert n == spark.read.parquet(f"{folder}/{ROWS[name]}.parquet").count()
    else:
        assert n > 0 or name == "op6_secret_scan"  # the least table holds no secret


@pytest.mark.parametrize("name", sorted(set(registry.ORACLE) - {"op12_centroid_clusters", "op13_substring_dedup"}))
def test_query_matches_sql(spark, folder, name):
    assert compare(spark, connect(folder), name, registry.QUERIES[name], registry.ORACLE[name], folder) == []


def test_pipeline_gives_pieces(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0) and r.length + r.offset <= 1024
        ends[r.sequence_id] = r.offset + r.length
    assert rows


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_edge_rows_and_an_empty_table(spark, folder, name, stage):
    rng = random.Random(4)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(40_000))
    rows = [(None, None, None, None, None, 1, 1, "x"), (1, "", "en", "a", 0, 1, 1, None), (2, None, "en", None, 5, 2, 2, "y"),
            (3, long, None, "a", None, 3, 3, "z"), (3, long, None, "a", None, 3, 3, "z"), (5, "same text here", "en", "b", 9, 5, 5, ""),
            (5, "same text here", "en", "b", 9, 5, 5, ""), (6, "\n\n \t", "en", "a", 3, 6, 6, "q"), (7, "é" * 30 + "😀 </s>", "fr", "a", 3, 7, 7, "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __row long, rid long, __keys string")
    found = stage(spark, docs, folder)
    if name != "pack":
        assert found.columns == list(corpus_pipeline.COLUMNS) and found.count() <= len(rows)
    else:
        assert found.count() >= len(rows)
    assert stage(spark, docs.limit(0), folder).count() == 0


def test_fingerprints_equal_a_naive_count_of_bits():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 4, 60):
        text = " ".join(rng.choice(["Ab", "c", "É", "dd"]) for _ in range(n))
        words = text.encode().lower().split()
        runs = [b" ".join(words[i : i + 3]) for i in range(max(1, n - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint(text, 3, 42) & (2**64 - 1) == want


def fewest(lengths, size):
    """The least number of bins, by trying all."""
    best = [len(lengths)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + lengths[i] <= size and bins[b] not in bins[:b]:
                bins[b] += lengths[i]
                put(i + 1, bins)
                bins[b] -= lengths[i]
        put(i + 1, [*bins, lengths[i]])

    put(0, [])
    return best[0]


def test_evolution_is_at_most_a_bin_above_the_optimum_of_small_blocks_and_beats_best_fit():
    rng = np.random.default_rng(2)
    above = []
    for _ in range(25):
        lengths = np.sort(rng.integers(10, 60, 9))[::-1].copy()
        found = packing.evolve(lengths, [], None, 100, 12, rng)[0]
        assert np.bincount(found, lengths).max() <= 100
        above.append(int(found.max()) + 1 - fewest(lengths.tolist(), 100))
    assert set(above) <= {0, 1} and sum(above) <= 5
    lengths = rng.integers(256, 520, 2048)
    plain = packing.best_fit(lengths, np.argsort(-lengths, kind="stable"), 1024).max() + 1
    evolved = packing.evolve(lengths, [], None, 1024, 9, rng)[0].max() + 1
    assert evolved < plain
