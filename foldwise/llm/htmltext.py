"""Main text of web pages: a bidirectional LSTM labels the leaf blocks of a page in their context."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from foldwise.llm.common import hash_sample, table

#: The bound of the training sample: pages, and characters of a page in it.
SAMPLE_PAGES, SAMPLE_CHARS = 300, 40_000
#: Rows and widths of the tables for path tokens and words; width of the LSTM in each direction.
PATH_ROWS, PATH_DIM, WORD_ROWS, WORD_DIM, HIDDEN = 2048, 16, 2048, 6, 16
EPOCHS, BATCH, RATE, SEED = 14, 24, 0.01, 1
#: Pages that a task labels at once, and blocks of one such batch.
PAGES_AT_ONCE, BLOCKS_AT_ONCE = 128, 1 << 15

#: Elements by how they lay out text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = "script|style|noscript|template|svg|iframe|canvas|object|audio|video|select|textarea|button|title|head"
#: What an element closes when it opens, besides inline elements and paragraphs.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tr": {"td", "th", "tr"}, "option": {"option"},
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{SILENT})\b[^>]*>(?:.*?(?=</(?P=raw)\b)|.*\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:[^>"']+|"[^"]*"|'[^']*')*+)>"""
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I,
)
NAMED = re.compile(r"""(?:^|\s)(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def hashed(token: str, rows: int) -> int:
    return crc32(token.encode("utf-8", "surrogatepass")) % rows


def element_tokens(tag: str, attributes: str) -> list[str]:
    """What the path says of an element: its tag, and the words of its class, id and role."""
    out = [f"<{tag}"]
    if attributes and "=" in attributes:
        for _, value in NAMED.findall(attributes):
            out += [w.lower() for w in NAME.findall(value) if len(w) > 1]
    return out


class Block:
    """A leaf block: its text, the path tokens above it and how many of its characters are links."""

    __slots__ = ("text", "path", "linked", "label")

    def __init__(self, text: str, path: tuple[str, ...], linked: float, label: int = 0):
        self.text, self.path, self.linked, self.label = text, path, linked, label


def leaf_blocks(page: str | None) -> list[Block]:
    """The page's text in leaf blocks, in order, with references decoded and blanks collapsed.

    Comments, scripts, styles, the head and form fields hold no text. Unclosed and stray tags are
    read as browsers do: a block closes open paragraphs and inline elements, an end tag without
    its start is nothing, an unfinished tag at the end of the page is dropped. A block's path holds
    each token of all block elements above it once, however many they are.
    """
    blocks: list[Block] = []
    stack: list[tuple[str, list[str]]] = []
    opened: dict[str, int] = {}
    above: dict[str, int] = {}
    buffer: list[str] = []
    links = 0

    def flush() -> None:
        nonlocal links
        if buffer:
            whole = "".join(buffer)
            text = " ".join((html.unescape(whole) if "&" in whole else whole).split())
            if text:
                blocks.append(Block(text, tuple(above), min(1.0, links / max(1, len(whole.strip())))))
            buffer.clear()
            links = 0

    def pop() -> None:
        tag, tokens = stack.pop()
        opened[tag] -= 1
        for t in tokens:
            above[t] -= 1
            if not above[t]:
                del above[t]

    for m in TOKEN.finditer(page or ""):
        if (text := m["text"]) is not None:
            buffer.append(text)
            if opened.get("a"):
                links += len(text.strip())
            continue
        if m["tag"] is None:
            if m["raw"] is not None:
                flush() if m["raw"].lower() not in ("svg", "button") else buffer.append(" ")
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if tag not in INLINE:
                flush()
            if opened.get(tag):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in VOID:
            buffer.append(" ") if tag in ("br", "wbr") else tag == "hr" and flush()
            continue
        if tag not in INLINE:
            flush()
            closes = CLOSES.get(tag, ())
            while stack and (stack[-1][0] in INLINE or stack[-1][0] == "p" or stack[-1][0] in closes):
                pop()
        if not m["attributes"].endswith("/"):
            tokens = element_tokens(tag, m["attributes"]) if tag not in INLINE else []
            for t in tokens:
                above[t] = above.get(t, 0) + 1
            stack.append((tag, tokens))
            opened[tag] = opened.get(tag, 0) + 1
    flush()
    return blocks


# --- features -------------------------------------------------------------------------------

STATS = 6


class Features:
    """Hashed rows of path tokens and words, remembered for those seen first."""

    def __init__(self, remembered: int = 200_000):
        self.paths: dict[tuple[str, ...], list[int]] = {}
        self.words: dict[str, int] = {}
        self.remembered = remembered

    def path(self, path: tuple[str, ...]) -> list[int]:
        rows = self.paths.get(path)
        if rows is None:
            rows = sorted({hashed(t, PATH_ROWS) for t in path}) or [0]
            if len(self.paths) < self.remembered:
                self.paths[path] = rows
        return rows

    def word(self, word: str) -> int:
        row = self.words.get(word)
        if row is None:
            row = hashed(word.lower(), WORD_ROWS)
            if len(self.words) < self.remembered:
                self.words[word] = row
        return row

    def of(self, page: list[Block]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        stats = np.zeros((len(page), STATS), np.float32)
        paths, words, known, size = [], [], self.words.get, math.log1p(len(page)) / 6
        for i, b in enumerate(page):
            split = b.text.split(" ")
            paths.append(self.path(b.path))
            rows = list(map(known, split))
            words.append([self.word(w) for w in split] if None in rows else rows)
            n = len(b.text)
            stats[i] = (
                math.log1p(len(split)) / 4, b.linked, b.text[-1] in ".!?…", b.text.count(",") * 10 / n,
                i / len(page), size,
            )
        return paths, words, stats


def stacked(pages: list[tuple]) -> dict[str, np.ndarray]:
    """Pages side by side: flat tables of hashed rows with the block they belong to, and where each
    block lies in a (page, step) grid, read forwards and backwards."""
    lengths = np.array([len(p[2]) for p in pages])
    first = np.cumsum(lengths) - lengths
    grid = np.full((len(pages), lengths.max()), lengths.sum(), np.int64)
    back = grid.copy()
    for k, n in enumerate(lengths):
        grid[k, :n] = first[k] + np.arange(n)
        back[k, :n] = grid[k, :n][::-1]
    paths = [r for p in pages for r in p[0]]
    words = [r for p in pages for r in p[1]]
    return {
        "path": np.concatenate(paths).astype(np.int64), "path_n": np.array([len(r) for r in paths]),
        "word": np.concatenate(words).astype(np.int64), "word_n": np.array([len(r) for r in words]),
        "stats": np.concatenate([p[2] for p in pages]), "grid": grid, "back": back,
    }


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Path and word vectors, statistics, one LSTM in each direction, and a logistic output."""

    def __init__(self, rng: np.random.Generator):
        d, h = PATH_DIM + WORD_DIM + STATS, HIDDEN
        small = lambda *s: (rng.standard_normal(s) * 0.2).astype(np.float32)
        self.p = {"path": small(PATH_ROWS, PATH_DIM), "word": small(WORD_ROWS, WORD_DIM) * 0.5,
                  "out": small(2 * h), "bias": np.zeros(1, np.float32)}
        for way in ("f", "b"):
            self.p[f"x{way}"], self.p[f"h{way}"] = small(d, 4 * h), small(h, 4 * h)
            self.p[f"c{way}"] = np.concatenate([np.ones(h), np.zeros(3 * h)]).astype(np.float32)

    def inputs(self, s: dict[str, np.ndarray]) -> np.ndarray:
        starts = lambda n: np.cumsum(n) - n
        path = np.add.reduceat(self.p["path"][s["path"]], starts(s["path_n"]))
        word = np.add.reduceat(self.p["word"][s["word"]], starts(s["word_n"])) / s["word_n"][:, None]
        x = np.concatenate([path, word.astype(np.float32), s["stats"]], 1)
        return np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])  # the last row pads

    def pass_(self, x: np.ndarray, grid: np.ndarray, way: str, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states of each block, and what the way back needs."""
        h = np.zeros((len(grid), HIDDEN), np.float32)
        c = h.copy()
        out = np.zeros((len(x), HIDDEN), np.float32)
        zx, memory = x @ self.p[f"x{way}"] + self.p[f"c{way}"], []
        pad = len(x) - 1
        for t in range(grid.shape[1]):
            at = grid[:, t]
            live = (at != pad)[:, None]
            z = zx[at] + h @ self.p[f"h{way}"]
            f, i, o = np.split(sigmoid(z[:, : 3 * HIDDEN]), 3, 1)
            g = np.tanh(z[:, 3 * HIDDEN :])
            c_new = np.where(live, f * c + i * g, c)
            tc = np.tanh(c_new)
            h_new = np.where(live, o * tc, h)
            if keep:
                memory.append((at, live, f, i, o, g, c, tc, h))
            c, h = c_new, h_new
            out[at] = h
        out[pad] = 0
        return out, memory

    def scores(self, s: dict[str, np.ndarray]) -> np.ndarray:
        x = self.inputs(s)
        both = [self.pass_(x, s[g], way, False)[0] for g, way in (("grid", "f"), ("back", "b"))]
        return sigmoid((np.concatenate(both, 1) @ self.p["out"] + self.p["bias"])[:-1])

    def back(self, d_out: np.ndarray, memory: list, x: np.ndarray, way: str, grads: dict) -> np.ndarray:
        """Back-propagation through time: gradients of one direction, and that of the inputs."""
        dzx = np.zeros((len(x), 4 * HIDDEN), np.float32)
        dh = np.zeros((len(memory[0][0]), HIDDEN), np.float32)
        dc, gh = dh.copy(), np.zeros_like(self.p[f"h{way}"])
        for at, live, f, i, o, g, c, tc, h in reversed(memory):
            dh_all = dh + d_out[at] * live
            dc_all = dc + np.where(live, dh_all * o * (1 - tc * tc), 0)
            dz = np.concatenate([
                dc_all * c * f * (1 - f), dc_all * g * i * (1 - i), dh_all * tc * o * (1 - o), dc_all * i * (1 - g * g),
            ], 1) * live
            dzx[at] += dz
            gh += h.T @ dz
            dh = np.where(live, dz @ self.p[f"h{way}"].T, dh_all)
            dc = np.where(live, dc_all * f, dc_all)
        dzx[-1] = 0
        grads[f"h{way}"], grads[f"x{way}"], grads[f"c{way}"] = gh, x.T @ dzx, dzx.sum(0)
        return dzx @ self.p[f"x{way}"].T

    def gradients(self, s: dict[str, np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
        x = self.inputs(s)
        (hf, mf), (hb, mb) = self.pass_(x, s["grid"], "f", True), self.pass_(x, s["back"], "b", True)
        both = np.concatenate([hf, hb], 1)
        e = sigmoid(both @ self.p["out"] + self.p["bias"])
        e[:-1] -= labels
        e[-1] = 0
        e = (e / len(labels)).astype(np.float32)
        grads = {"out": both.T @ e, "bias": e.sum(keepdims=True)}
        d = e[:, None] * self.p["out"]
        dx = self.back(d[:, :HIDDEN], mf, x, "f", grads) + self.back(d[:, HIDDEN:], mb, x, "b", grads)
        for name, lo, hi, scale in (("path", 0, PATH_DIM, None), ("word", PATH_DIM, PATH_DIM + WORD_DIM, s["word_n"])):
            per = dx[:-1, lo:hi] if scale is None else dx[:-1, lo:hi] / scale[:, None]
            grads[name] = np.zeros_like(self.p[name])
            np.add.at(grads[name], s[name], np.repeat(per, s[f"{name}_n"], 0))
        return grads

    def fit(self, make: callable, rng: np.random.Generator) -> Labeller:
        """Adam over EPOCHS of the pages that ``make(rng)`` gives, with their blocks' labels."""
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        features, step = Features(), 0
        for epoch in range(EPOCHS):
            pages = [p for p in make(rng) if p]
            pages.sort(key=len)
            groups = [pages[i : i + BATCH] for i in range(0, len(pages), BATCH)]
            for k in rng.permutation(len(groups)):
                s = stacked([features.of(p) for p in groups[k]])
                grads = self.gradients(s, np.array([b.label for p in groups[k] for b in p], np.float32))
                step += 1
                rate = RATE * (1 if epoch < EPOCHS * 2 // 3 else 0.3)
                for name, g in grads.items():
                    g = np.clip(g, -1, 1)
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.995 * second[name] + 0.005 * g * g
                    change = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.995**step)) + 1e-7)
                    self.p[name] = (self.p[name] - rate * change).astype(np.float32)
        return self


# --- training pages -------------------------------------------------------------------------

#: Elements whose text is the article, and how boilerplate of each kind is marked up.
MAIN_TAGS = ("<article", "<main")
OTHER_TAGS = ("<nav", "<header", "<footer", "<aside", "<form", "<menu", "<dialog", "<fieldset")
OTHER_NAMES = frozenset("ad ads advert sidebar comments comment footer menu nav cookie banner promo newsletter".split())
MAIN_STYLES = (
    "article", "main", "main article", "article div.article-body", "div#content", "div.post-content", "div.entry-content",
    "div#main", "div.article", "section.story", "div.main div.text", "div#article-body", "main section", "section.content",
    "div.page-content", "table tr td.content", "div.post", "div.body-text", "",
)
KINDS = {
    "menu": ("nav ul li", "nav", "ul.menu li", "div.navbar ul li", "div#nav", "div.navigation a", "header nav ul li",
             "div.breadcrumbs", "ol.breadcrumb li", "menu li", "div.topbar", "div.tabs", "div.pagination", "ul.links li"),
    "header": ("header", "header h1", "header div.title h1", "div.header", "div#header", "div.site-header", "header div.logo", "div.masthead", "div.branding"),
    "footer": ("footer", "div.footer", "div#footer", "footer p", "div.copyright", "footer ul li", "div.site-info", "div.legal"),
    "sidebar": ("aside", "aside.sidebar", "div.sidebar", "div#sidebar", "aside ul li", "div.widget", "div.related ul li",
                "section.related", "div.right-column", "div.recommended", "div.popular li", "div.more-stories", "div.tags"),
    "notice": ("div.cookie-notice", "div#cookie-banner", "div.notice", "div.consent", "div#cc-window", "div#gdpr", "div.alert", "dialog", "div.modal",
               "div.popup", "section.disclaimer", "div.gdpr", "div.paywall", "div.message", "div.warning", "p.notice", "div.announcement"),
    "advert": ("div.ad", "div.ads", "div.advert", "div.advertisement", "aside.ad", "div.banner", "div.sponsored", "div.promo",
               "section.promotion", "div#ad-slot", "div.sponsor", "div.adbox", "p.ad", "div.commercial"),
    "form": ("form", "form label", "form.newsletter p", "div.newsletter", "form.search", "div.subscribe", "form fieldset",
             "form.contact div", "div.signup", "div.login form", "form p"),
    "comments": ("section.comments", "div.comments div.comment", "div#comments", "ul.comments li", "ol.commentlist li p",
                 "div.comment p", "section#comments article.comment", "div.reviews", "div.discussion", "div.replies div.reply",
                 "section.responses p", "article.comment p", "div.reader-comments p", "aside.comments p"),
    "share": ("div.share", "ul.social li", "div.share-buttons", "div.author-bio", "div.follow", "div.print", "div.byline-links"),
}
WRAPPERS = ("", "div.wrapper", "div.container", "div#page", "div.site div.row", "div.layout", "center table tr td")
LEAVES = ("p", "p", "p", "p", "div", "h2", "ul li", "blockquote p", "h3", "section p", "pre", "figure figcaption")


def marked_up(style: str) -> tuple[str, ...]:
    """The path tokens of a style such as ``div.post p``."""
    out: list[str] = []
    for part in style.split():
        tag, *names = re.split(r"[.#]", part)
        out += [f"<{tag}", *(w.lower() for n in names for w in NAME.findall(n) if len(w) > 1)]
    return tuple(out)


def by_markup(blocks: list[Block]) -> list[Block]:
    """Blocks labelled by telling elements; without any on the page, by length and links."""
    telling = any(t in b.path for b in blocks for t in MAIN_TAGS)
    for b in blocks:
        other = any(t in OTHER_TAGS or t in OTHER_NAMES for t in b.path)
        main = any(t in b.path for t in MAIN_TAGS) if telling else len(b.text) > 120 and b.linked < 0.3
        b.label = int(main and not other)
    return blocks


def varied(pages: list[list[Block]], rng: np.random.Generator) -> list[list[Block]]:
    """The sample pages as they are, or their blocks in other markup, among boilerplate whose
    words are those of other articles: what tells it apart is the path and the context."""
    texts = [b.text for p in pages for b in p if b.label] or ["text"]
    pick = lambda options: options[int(rng.integers(len(options)))]
    out = []
    for page in pages:
        if rng.random() < 0.3:
            out.append(page)
            continue
        root = ("<html", "<body", *marked_up(pick(WRAPPERS)))
        main = (*root, *marked_up(pick(MAIN_STYLES)))

        def boilerplate(kinds: tuple[str, ...], base: tuple[str, ...]) -> list[Block]:
            kind = pick(kinds)
            path = (*base, *marked_up(pick(KINDS[kind])))
            if rng.random() < 0.3:
                path = (*path, *marked_up(pick(("p", "span", "div", "div p", "ul li", "h3"))))
            n = int(rng.integers(3, 9)) if kind == "menu" else int(rng.integers(1, 5))
            short = rng.random() < 0.5 and kind != "comments"
            made = []
            for _ in range(n):
                words = pick(texts).split(" ")
                at = int(rng.integers(len(words)))
                words = words[at : at + int(rng.integers(1, 5 if kind == "menu" or short else 60))]
                linked = float(rng.random() < (0.9 if kind == "menu" else 0.2))
                made.append(Block(" ".join(words) or "more", path, linked))
            return made

        before, inside, after = ("menu", "header", "notice", "advert", "form"), ("advert", "sidebar", "share", "notice", "form", "comments"), tuple(KINDS)
        blocks = [b for _ in range(int(rng.integers(0, 4))) for b in boilerplate(before, root)]
        article = [b for b in page if b.label]
        for k, b in enumerate(article):
            leaf = pick(("h1", "header h1", "div.title")) if k == 0 and rng.random() < 0.6 else pick(LEAVES)
            if leaf == "header h1" and "<article" not in main:
                leaf = "h1"
            words = b.text.split(" ")
            if rng.random() < 0.15:
                words = words[: int(rng.integers(1, 6))]
            blocks.append(Block(" ".join(words), (*main, *marked_up(leaf)), float(rng.random() < 0.05), 1))
            if rng.random() < 0.06:
                blocks += boilerplate(inside, main)
        if rng.random() < 0.3:
            blocks += boilerplate(("comments", "share", "sidebar", "advert", "form"), main)
        blocks += [b for _ in range(int(rng.integers(0, 4))) for b in boilerplate(after, root)]
        out.append(blocks)
    return out


def train(pages: DataFrame) -> Labeller:
    """A labeller from at most SAMPLE_PAGES pages of at most SAMPLE_CHARS characters."""
    fit = pages.select("html").where(F.length("html").between(1, SAMPLE_CHARS))
    rows = sorted(r.html for r in hash_sample(fit, SAMPLE_PAGES, "html").collect())
    sample = [by_markup(b) for b in map(leaf_blocks, rows) if b]
    if sample:  # few pages are varied the more often
        sample = sample * max(1, SAMPLE_PAGES // len(sample))
    rng = np.random.default_rng(SEED)
    labeller = Labeller(rng)
    return labeller.fit(lambda r: varied(sample, r), rng) if sample else labeller


def main_texts(pages: list[str | None], labeller: Labeller, features: Features) -> list[str]:
    """The main text of each page: its blocks of score 0.5 or more, joined by a space."""
    parsed = [leaf_blocks(p) for p in pages]
    order = sorted((k for k in range(len(parsed)) if parsed[k]), key=lambda k: len(parsed[k]))
    texts = [""] * len(pages)
    at = 0
    while at < len(order):
        stop = at + 1
        while stop < len(order) and (stop - at + 1) * len(parsed[order[stop]]) <= BLOCKS_AT_ONCE:
            stop += 1
        group = order[at:stop]
        scores = labeller.scores(stacked([features.of(parsed[k]) for k in group]))
        first = 0
        for k in group:
            n = len(parsed[k])
            texts[k] = " ".join(b.text for b, p in zip(parsed[k], scores[first : first + n]) if p >= 0.5)
            first += n
        at = stop
    return texts


def extract(pages: DataFrame, labeller: Labeller, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default page_id, url) and the main ``text`` of every row of ``pages``.

    Every block of a whole page is labelled in the context of all others. NULL and empty pages and
    pages without text give an empty text. Repeated rows are pages of their own.
    """
    keep = keep or ["page_id", "url"]
    source = pages.select(*keep, F.col("html").alias("__html"))
    schema = pages.select(*keep).schema.add("text", "string")
    sent = pages.sparkSession.sparkContext.broadcast(labeller)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(at, PAGES_AT_ONCE)
                texts = main_texts(part.column(part.num_columns - 1).to_pylist(), sent.value, features)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string())], [*part.schema.names[:-1], "text"]
                )

    return source.mapInArrow(run, schema)


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    found = extract(pages, train(pages))
    return found.withColumn("n_chars", F.length("text").cast("long"))


QUERIES = {"op1_html_text": op1_html_text}
ORACLE: dict[str, str] = {}
