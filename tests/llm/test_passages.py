"""The line stage keeps a long line once, over hot, tiny and missing sources."""

import corpus_pipeline


def test_long_lines_stay_in_one_text_of_the_corpus(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    brief = " ".join(f"p{i}" for i in range(20))
    own = lambda i: " ".join(f"o{i}x{j}" for j in range(40))
    rows = [(i, f"{own(i)}\n{passage if i < 10 else 'x'}\n{brief if i < 4 else 'y %d' % i}", "en", "hot", 1) for i in range(600)]
    rows += [(1000, f"{own(1000)}\n{passage}", "en", "tiny", 1), (1001, f"{own(1001)}\n {passage}", "en", "tiny", 1)]
    rows += [(1002, f"{own(1002)}\n{passage}", "en", None, 1), (1003, f"{own(1002)}\n{passage}", "en", None, 1), (1004, None, "en", None, 0)]
    # A copy as a whole is left to the near-duplicate stage.
    rows += [(1005, f"a b\n{passage}", "en", "tiny", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in corpus_pipeline.drop_lines(spark, docs, "").collect()}
    held = {i for i, r in got.items() if passage in (r["text"] or "")} - {1005}
    assert len(got) == len(rows) and (len(held) == 1 or held in ({1002, 1003}, set())) and got[1004]["text"] is None
    assert got[1005]["text"] == rows[-1][1] and got[5]["text"].startswith(own(5))
    assert sum(brief in (got[i]["text"] or "").split("\n") for i in range(4)) == 4
    assert all(r["n_chars"] == len(r["text"]) for r in got.values() if r["text"])
