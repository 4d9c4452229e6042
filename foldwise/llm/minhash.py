"""Near-duplicates by word-shingle Jaccard.

SimHash fingerprints, joined by pigeonring filtering, and MinHash bands for what is further than
their few bits find candidates; the exact similarity confirms them.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType

from foldwise.llm.common import materialise
from foldwise.llm.components import components
from foldwise.llm.simhash import links, majority, shingles

#: Texts this similar, by their sets of shingles, are copies.
SIMILARITY = 0.8
#: Bits that fingerprints of candidates may differ in.
DISTANCE = 3
#: Bands of minima: a pair of similarity 0.8 shares no band with probability (1 - 0.8 ** 5) ** 16 = 0.0017.
BANDS, ROWS = 16, 5
#: Shingles whose permutations are computed at once (640 bytes each).
BLOCK = 1 << 12
#: Texts on the sides of a block of pairs that one task confirms.
LEFT, RIGHT = 256, 512
#: What names such a block.
PIECE = ("band", "key", "left", "right")
#: Texts whose shingles a task remembers while it confirms pairs.
REMEMBERED = 64


@functools.cache
def permutations(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks and odd factors of the permutations of 64-bit hashes, as columns."""
    drawn = np.random.default_rng(seed).integers(0, 1 << 64, (2, BANDS * ROWS, 1), np.uint64)
    return drawn[0], drawn[1] | np.uint64(1)


def bands(hashes: list[int], seed: int) -> list[int]:
    """One signed 64-bit key a band of the minima of a text's shingle hashes; no hashes, no keys."""
    if not hashes:
        return []
    masks, factors = permutations(seed)
    values = np.array(hashes, np.uint64)
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for at in range(0, len(values), BLOCK):
        least = np.minimum(least, ((values[at : at + BLOCK] ^ masks) * factors).min(1))
    keys = [xxhash.xxh64_intdigest(row.tobytes()) for row in least.reshape(BANDS, ROWS)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def signatures(docs: DataFrame, keep: list[str], words: int, seed: int) -> DataFrame:
    """``keep`` columns of every row of ``docs``, the digest ``node`` of its words, its fingerprint ``fp`` and its ``bands``."""
    source = docs.select(*keep, F.col("text").alias("__text"))
    schema = docs.select(*keep).schema.add("node", "binary").add("fp", "long").add("bands", ArrayType(LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, fps, keys = [], [], []
            for t in batch.column(batch.num_columns - 1):
                text = t.as_py()
                found = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
                nodes.append(hashlib.md5(found).digest())
                hashes = shingles(text, words, seed)
                fps.append(majority(hashes))
                keys.append(bands(hashes, seed))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(nodes, pa.binary()), pa.array(fps, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                [*batch.schema.names[:-1], "node", "fp", "bands"],
            )

    return source.mapInArrow(run, schema)


def alike(x: frozenset[int], y: frozenset[int], similarity: float) -> bool:
    """Whether two sets of shingles share at least ``similarity`` of their union."""
    least, most = sorted((len(x), len(y)))
    if least < similarity * most - 1e-9:
        return False
    shared = len(x & y)
    return shared >= similarity * (least + most - shared) - 1e-9


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, similarity: float, seed: int) -> DataFrame:
    """The rows a, b of ``pairs`` whose texts (node, text) share enough of their distinct shingles."""
    both = (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
        .select("a", "b", "text_a", "text_b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = functools.lru_cache(REMEMBERED)(lambda text: frozenset(shingles(text, words, seed)))
        for batch in batches:
            kept = [
                alike(known(a.as_py()), known(b.as_py()), similarity)
                for a, b in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return both.mapInArrow(run, "a binary, b binary")


def crossed(rooted: DataFrame, texts: DataFrame, words: int, similarity: float, seed: int) -> DataFrame:
    """All links a, b of components (``root``) that meet in a bucket (band, key), with its choice's root ``main``.

    What is not in the choice's component is held against all of the bucket, in blocks of about
    LEFT by RIGHT texts, each a group of bounded size. A pair is confirmed in the first band it shares.
    """
    split = rooted.groupBy("band", "key").agg(
        F.expr("CAST(ceil(count_if(root <> main) / %d) AS INT)" % LEFT).alias("lefts"),
        F.expr("CAST(ceil(count(*) / %d) AS INT)" % RIGHT).alias("rights"),
    ).where("lefts > 0")
    spread = """concat(
      IF(root <> main, transform(sequence(0, rights - 1), r ->
        named_struct('left', CAST(pmod(xxhash64(node), lefts) AS INT), 'right', r, 'other', TRUE)), array()),
      transform(sequence(0, lefts - 1), l ->
        named_struct('left', l, 'right', CAST(pmod(xxhash64(node), rights) AS INT), 'other', FALSE)))"""
    dealt = rooted.join(split.hint("merge"), ["band", "key"]).join(texts.hint("merge"), "node").selectExpr(
        "band", "key", "node", "root", "bands", "text", f"inline({spread})"
    )

    def run(group: pa.Table) -> pa.Table:
        band = group["band"][0].as_py()
        other = np.array(group["other"].to_pylist(), bool)
        mine, theirs = np.flatnonzero(other), np.flatnonzero(~other)
        keys = np.array(group["bands"].to_pylist(), np.int64).reshape(-1, BANDS)
        nodes, roots = group["node"].to_pylist(), group["root"].to_pylist()
        known = {}

        def of(i: int) -> frozenset[int]:
            if nodes[i] not in known:
                known[nodes[i]] = frozenset(shingles(group["text"][i].as_py(), words, seed))
            return known[nodes[i]]

        found = set()
        for i in mine.tolist():
            first = (keys[theirs] == keys[i]).argmax(1) == band
            for j in theirs[first].tolist():
                ends = min(roots[i], roots[j]), max(roots[i], roots[j])
                if roots[i] != roots[j] and ends not in found and alike(of(i), of(j), similarity):
                    found.add(ends)
        return pa.table(
            {"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())}
        )

    dealt = dealt.repartition(int(rooted.sparkSession.conf.get("spark.sql.shuffle.partitions")), *PIECE)
    return dealt.groupBy(*PIECE).applyInArrow(run, "a binary, b binary").distinct()


def fingerprinted(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs a < b of ``classes`` (node, fp): every one and the choice of its component of fingerprints.

    Fingerprints link at ``distance`` or fewer differing bits, as in :func:`simhash.near_duplicates`.
    """
    fps = materialise(classes.groupBy("fp").agg(F.min("node").alias("least")))
    roots = components(links(fps.select("fp"), distance)).withColumnRenamed("node", "fp")
    rooted = materialise(
        fps.join(roots.hint("merge"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    )
    chosen = rooted.groupBy("root").agg(F.min("least").alias("a"))
    named = rooted.join(chosen.hint("merge"), "root").select("fp", "a")
    return classes.select(F.col("node").alias("b"), "fp").join(named.hint("merge"), "fp").where("a < b").select("a", "b")


def neighbours(classes: DataFrame, texts, words: int, similarity: float, seed: int) -> DataFrame:
    """node, root of all ``classes`` (node, fp, bands) that are linked; ``texts`` gives node, bands and text of a frame of nodes.

    First every class is held against the choice of its component of fingerprints, and every class of
    a bucket against one of it, another in each band, so that a large group of copies costs a pair a
    copy and band. Then what is not yet joined to its bucket's
    choice is held against all classes of the bucket in other components, so no pair is left out;
    the components that this links are contracted as they are, not from their members anew.
    """
    keyed = classes.select("node", F.posexplode("bands").alias("band", "key"))
    many = (
        keyed.groupBy("band", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("band", "node").alias("h"), "node")).alias("m"))
        .where("n > 1").selectExpr("band", "key", "m.node AS chosen")
    )
    members = materialise(keyed.join(many.hint("merge"), ["band", "key"]))
    stars = members.where("node <> chosen").select(
        F.least("node", "chosen").alias("a"), F.greatest("node", "chosen").alias("b")
    )
    stars = materialise(stars.unionByName(fingerprinted(classes)).distinct())
    asked = members.select("node").unionByName(stars.selectExpr("inline(array(struct(a AS node), struct(b AS node)))"))
    held = materialise(texts(asked.distinct()))
    linked = materialise(confirmed(stars, held, words, similarity, seed))
    roots = components(linked)
    of = lambda name, root: roots.select(F.col("node").alias(name), F.col("root").alias(root)).hint("merge")
    rooted = materialise(
        members.join(of("node", "r"), "node", "left").join(of("chosen", "c"), "chosen", "left")
        .select("band", "key", "node", F.coalesce("r", "node").alias("root"), F.coalesce("c", "chosen").alias("main"))
    )
    found = rooted.select("node", "root").unionByName(roots.select("node", "root")).distinct()
    further = components(crossed(rooted, held, words, similarity, seed))
    last = further.select(F.col("node").alias("root"), F.col("root").alias("last")).hint("merge")
    return found.join(last, "root", "left").select("node", F.coalesce("last", "root").alias("root"))


def one_of_each(docs: DataFrame, words: int = 5, similarity: float = SIMILARITY, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each component of texts linked by a Jaccard similarity of ``similarity`` or more.

    Of a component the row of the least (doc_id, words, row) stays, so a repeated id with different
    texts is judged text by text. Words and shingles are those of :func:`simhash.fingerprints`; all
    texts without words are alike. Rows without an id can't be named, so they stay and stand for no
    group. Candidates have fingerprints within DISTANCE bits, or share one of BANDS keys of ROWS minima,
    which reach what SimHash does not; each link is confirmed exactly.
    """
    named = docs.where("doc_id IS NOT NULL").withColumn("__row", F.xxhash64(*docs.columns))
    marked = materialise(signatures(named, ["doc_id", "__row"], words, seed))
    classes = materialise(
        marked.groupBy("node").agg(F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.min(F.struct("doc_id", "node", "__row")).alias("least"))
    )

    def texts(nodes: DataFrame) -> DataFrame:
        rows = classes.join(nodes.hint("merge"), "node").selectExpr("node", "bands", "least.doc_id AS doc_id", "least.__row AS __row")
        return (
            named.select("doc_id", "__row", "text").join(rows.hint("merge"), ["doc_id", "__row"])
            .dropDuplicates(["doc_id", "__row"]).select("node", "bands", "text")
        )

    roots = neighbours(classes, texts, words, similarity, seed)
    first = (
        classes.join(roots.hint("merge"), "node", "left").groupBy(F.coalesce("root", "node").alias("root"))
        .agg(F.min("least").alias("least")).select("least.doc_id", "least.__row")
    )
    kept = named.join(first.hint("merge"), ["doc_id", "__row"], "left_semi").dropDuplicates(["doc_id", "__row"])
    return kept.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))
