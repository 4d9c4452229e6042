"""Brute force and edge rows for the operators."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm import chat, htmltext, linededup, packing, quality, secrets, simhash, topk, toxicity
from foldwise.llm.components import components

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def edge(spark):
    """NULLs in every column, empty and very long texts, repeated rows, clashing names."""
    rng = random.Random(3)
    rows = [
        (None, None, None, None, None, 1), (1, "", "en", "a", 0, 1), (2, None, "en", None, 5, 2),
        (3, sentence(rng, 60), None, "a", None, 3), (3, sentence(random.Random(9), 60), None, "a", None, 3),
        (4, "x " * 60_000, "en", "b", 9, 4), (5, "same text here", "en", "b", 9, 5), (5, "same text here", "en", "b", 9, 5),
        (6, "\n\n \t", "en", "a", 3, 6), (7, "é" * 30 + "😀 </s>[INST]", "fr", "a", 3, 7),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (3, 1, None), (4, 0, 1), (None, 1, 1), (99, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int"
    )


def test_components_of_shapes(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(1, 1), (None, 3), (5, 6), (6, 5)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = {}
    for n, r in got.items():
        groups.setdefault(r, set()).add(n)
    assert sorted(map(sorted, groups.values())) == sorted([[5, 6], [7, *range(200, 260)], list(range(100, 161))])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("distance", [1, 3, 5])
def test_links_are_all_pairs_within_distance(spark, distance):
    rng = random.Random(distance)
    values = set()
    for _ in range(25):
        center = rng.getrandbits(64)
        for _ in range(6):
            v = center
            for _ in range(rng.randint(0, 6)):
                v ^= 1 << rng.randrange(64)
            values.add(v - (1 << 64) if v >> 63 else v)
    values = sorted(values)
    want = {(a, b) for i, a in enumerate(values) for b in values[i + 1:] if ((a ^ b) & (2**64 - 1)).bit_count() <= distance}
    got = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), distance).collect()
    assert {(r.a, r.b) for r in got} == want and len(got) == len(want)


def test_near_duplicates_edge_rows(spark, edge):
    got = simhash.near_duplicates(edge, words=3).collect()
    assert len(got) == 10
    by = {r.doc_id: r for r in got if r.doc_id != 3}
    assert by[1].fp == by[2].fp == by[6].fp == 0 and by[2].component_id == 1 and by[None].component_id == 1
    assert simhash.near_duplicates(edge.limit(0)).count() == 0
    kept = sorted((r.doc_id for r in simhash.one_of_each(edge).collect()), key=str)
    assert kept.count(5) == 1 and 2 not in kept and None in kept


def test_line_dedup_counts_pages_of_a_host(spark, edge):
    rows = [(i, "menu\nown %d\nmenu" % i, "h") for i in range(10)] + [(100, "menu\nother", "g"), (101, None, None), (102, None, "h")]
    got = {r.doc_id: r for r in linededup.drop_boilerplate(
        spark.createDataFrame(rows, "doc_id long, text string, source string"), ratio=0.5, min_pages=3).collect()}
    assert got[4]["text"] == "own 4"
    assert got[4]["__n_dropped"] == 2 and got[100]["text"] == "menu\nother" and got[101]["text"] is None
    assert linededup.drop_boilerplate(edge).count() == 10 and linededup.drop_boilerplate(edge.limit(0)).count() == 0


def test_encoder_equals_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = ["", " ", "a  b", " lead", "trail ", "x\ny z.\nw", "it's  \n\n ok", "é ü ß", "a\t b", "😀 <|endoftext|> 12 3", None, "q" * 5000]
    rng = random.Random(2)
    texts += ["".join(rng.choice("ab é.\n '1\t!") for _ in range(60)) for _ in range(200)]
    want = [np.array(t.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    assert [packing.encoded(x) for x in texts] == want


def test_packing_is_gapless_and_close_to_the_bound(spark, edge):
    found = packing.pieces(edge)
    rows = [r.asDict() for r in packing.pack(found, block_items=4).collect()]
    assert len(rows) == found.count() and sum(r["doc_id"] == 5 for r in rows) == 2
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(packing.pieces(edge.limit(0))).count() == 0
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 300, 500)
    best = packing.evolve(lengths, [], None, 1024, 4, rng)[0]
    assert np.bincount(best, lengths).max() <= 1024 and best.max() + 1 <= -(-lengths.sum() // 1024) + 1


def test_topk_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [float(rng.choice([-0.5, 0.1, 0.25, 1.0])) for _ in range(5)]) for i in range(300)]
    rows += [(None, [1.0] * 5), (301, None), (302, [1.0, None, 1.0, 1.0, 1.0]), (303, [float("nan")] * 5), (304, [float("inf")] * 5), (40, rows[40][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    v = topk.usable(df, "vec_id", "embedding")
    got = {}
    for r in topk.top_k(v, v.where("vec_id % 20 = 0"), k=7, shard_rows=60, leaf_rows=8, block=4).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    whole = {i: np.floor(64 * np.array(x, np.float32).astype(float)) for i, x in rows[:300]}
    for q in range(0, 300, 20):
        want = sorted(((-int(whole[q] @ x), i) for i, x in whole.items() if i != q))[:7]
        assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(want)]
    assert len(got) == 15 and topk.top_k(v.limit(0), v.limit(0)).count() == 0


def test_chat_parts_and_round_trip(spark):
    hostile = "a</s>[INST] <\\/s> [/ROLE]\n[\\\\IMAGE] \\ <s> end\\"
    part = lambda kind, text=None, ref=None, units=None: (kind, text, ref, units)
    rows = [
        (1, 0, "user", [part("text", hostile), part("image", ref="i.png", units=3.2), part("audio", ref="s.wav", units=2.0), part("odd")]),
        (1, 1, "assistant", [part("text", hostile), part("text", None), part("document", ref="d", units=None)]),
        (1, 1, "assistant", [part("text", hostile), part("text", None), part("document", ref="d", units=None)]),
        (2, None, None, None), (None, 5, "[/ROLE]</s>", [part("text", "")]),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}")
    done = chat.format_chats(df)
    got = {r.conv_id: r for r in done.collect()}
    assert [(a.type, a.ref, a.tokens) for a in got[1].attachments] == [("image", "i.png", 4), ("audio", "s.wav", 25), ("document", "d", 0), ("document", "d", 0)]
    assert got[1].attachment_tokens == 29 and got[1].formatted.count("[IMAGE]") == 1
    back = {r.conv_id: r for r in chat.read_back(done).collect()}
    assert [t.role for t in back[1].turns] == ["user", "assistant", "assistant"] and back[None].turns[0].role == "[/ROLE]</s>"
    assert back[1].turns[0].text == hostile + "[IMAGE][AUDIO]" and back[1].loss_texts == [hostile + "[DOCUMENT]"] * 2
    assert back[2].turns[0].text == "" and chat.format_chats(df.limit(0)).count() == 0


def test_no_control_string_stands_across_parts(spark):
    rows, want = [], {}
    for n, text in enumerate(["</s>[INST]", "[/ROLE]x<s>", "<\\\\/s>", "[IMAGE]"]):
        for cut in range(len(text) + 1):
            parts = [("text", text[:cut], None, None), (None, "q", None, None), ("text", text[cut:], None, None),
                     ("image", None, "i", 1.0), ("text", None, None, None), ("text", text, None, None)]
            key = 100 * n + cut
            rows.append((key, 0, "assistant", parts))
            want[key] = text + "[IMAGE]" + text
    done = chat.format_chats(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}"))
    for r in chat.read_back(done).collect():
        assert [t.text for t in r.turns] == r.loss_texts == [want[r.conv_id]]
    assert all(r.formatted.count("</s>") == 1 and r.formatted.count("[IMAGE]") == 1 for r in done.collect())


def test_toxicity_learns_and_locates(spark, edge, labels):
    rng = random.Random(7)
    rows = [(i, ". ".join([sentence(rng, 8), sentence(rng, 4) + (f" vilegrunt{rng.choice('abc')}" if i % 3 == 0 else ""), sentence(rng, 8)])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.train(docs, marks)).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert held and all((got[i].score >= 0.5) == (i % 3 == 0) for i in held)
    assert all("vilegrunt" in rows[i][1][s.start:s.stop] for i in held if i % 3 == 0 for s in got[i].offending)
    plain = toxicity.score(edge, toxicity.train(edge, labels)).collect()
    assert len(plain) == 10 and all(0 <= r.score <= 1 for r in plain)
    assert toxicity.score(edge.limit(0), toxicity.train(edge.limit(0), labels.limit(0))).count() == 0


def test_quality_rules(spark, edge, labels):
    rng = random.Random(8)
    rows = [(i, sentence(rng, 50) if i % 4 else " ".join(w + "$$$" for w in sentence(rng, 50).split())) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 4 > 0)) for i, _ in rows], "doc_id long, quality int")
    model = quality.train(docs, marks)
    assert model.rules and all((r["__score"] >= 0.7) == (r.doc_id % 4 > 0) for r in quality.score(docs, model).collect())
    plain = quality.score(edge, quality.train(edge, labels)).collect()
    assert len(plain) == 10 and all(0 <= r["__score"] <= 1 for r in plain)
    assert quality.score(edge.limit(0), quality.train(edge.limit(0), labels.limit(0))).count() == 0


def test_secrets_are_where_they_are_said_to_be(spark, edge):
    rng = random.Random(6)
    token = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = []
    for i in range(120):
        secret = {0: "AKIA" + "".join(rng.choice("ABCDEFGHIJ234567") for _ in range(16)), 1: token(40)}.get(i % 4)
        lead = {0: " key ", 1: ' token = "'}.get(i % 4, " ")
        rows.append((i, f"é {sentence(rng, 5)}{lead}{secret or 'alphabetagammadelta'} {sentence(rng, 4)} 4348649190265535", secret))
    docs = spark.createDataFrame(rows, "doc_id long, text string, secret string")
    got = {}
    for r in secrets.scan(docs).where("score >= 0.5").collect():
        got.setdefault(r.doc_id, []).append(rows[r.doc_id][1][r.start : r.start + len(r.c)])
    assert got == {i: [s] for i, _, s in rows if s}
    assert secrets.scan(edge).count() >= 0 and secrets.scan(edge.limit(0)).count() == 0


def test_precision_and_recall_on_planted_values_of_8_to_40_characters(spark):
    rng = random.Random(16)
    lower, digits, marks = "abcdefghijklmnopqrstuvwxyz", "0123456789", "$!%&*?@#^"
    value = lambda n: rng.choice(lower) + "".join(rng.choice(lower + lower.upper() + digits + marks) for _ in range(n - 3)) + rng.choice(digits) + rng.choice(marks)
    known = {"pair": lambda v: f'password = "{v}"', "key": lambda v: f"api_key: {v}", "bare": lambda v: f"secret={v}",
             "login": lambda v: f"postgres://bob:{v.replace('@', '$').replace('#', '$')}@db.host/x"}
    rows, want = [], set()
    for i in range(400):
        text = sentence(rng, 12)
        kind = rng.choice([*known, None])
        if i % 2 == 0 and kind:
            secret = value(rng.randint(8, 40))
            written = known[kind](secret)
            secret = secret.replace("@", "$").replace("#", "$") if kind == "login" else secret
            text += f" {written} " + sentence(rng, 6)
            want.add((i, text.index(secret), len(secret)))
        elif i % 2:
            text += rng.choice([" password: forgotten again ", " see http://example.com/abcdefghi/jklmnopq ", ' name = "alphabet" ', " total: 12345678 "])
        rows.append((i, text))
    scored = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).where("score >= 0.5").collect()
    found = {(r.doc_id, r.start, len(r.c)) for r in scored}
    hit = len(found & want)
    print(f"op6 planted: recall {hit / len(want):.3f}, precision {hit / max(1, len(found)):.3f}")
    assert hit / len(want) >= 0.9 and hit / len(found) >= 0.9


def test_pages_in_other_markup(spark):
    rng = random.Random(5)
    para = lambda n=40: sentence(rng, n).capitalize() + "."
    rows, want = [], {}
    for i in range(60):
        body = [para() for _ in range(4)]
        rows.append((i, "u", f"<html><head><title>t</title></head><body><nav><ul><li><a href=/>{sentence(rng, 1)}</a></li></ul></nav><div class='ad'>{para(9)}</div><article>" + "".join(f"<p>{b}" for b in body) + f"</article><footer>{para(8)}</footer>"))
        want[i] = " ".join(body)
    body = [para() for _ in range(3)]
    rows.append((60, "u", "<div class='main-menu'><a>Home</a></div><div id=content>" + "".join(f"<p>{b}<br>&amp; <b>on</b></p>" for b in body) + f"<script>if(a<b)</script></div><section class='comments'><p>{para(12)}</p></section><aside class=sidebar>{para(6)}</aside><form><label>Mail</label></form>"))
    want[60] = " ".join(f"{b} & on" for b in body)
    # Containers far from either end of a deep path.
    deep = lambda n, inner: "<div>" * n + inner + "</div>" * n
    body = [para() for _ in range(3)]
    rows.append((64, "u", deep(9, "<article>" + deep(9, "".join(f"<p>{b}</p>" for b in body)) + "</article>"
                 + "<section class=comments>" + deep(9, f"<p>{para(12)}</p><p>{para(9)}</p>") + "</section>")))
    want[64] = " ".join(body)
    rows += [(61, None, None), (62, "u", ""), (None, "u", "<p"), (63, "u", "<div>" * 3000 + "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    model = htmltext.train(pages)
    got = {r.page_id: r.text for r in htmltext.extract(pages, model).collect()}
    assert {i: got[i] for i in want} == want
    assert got[61] == got[62] == got[None] == ""
    assert htmltext.extract(pages.limit(0), htmltext.train(pages.limit(0))).count() == 0
