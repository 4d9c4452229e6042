"""SimHash near-duplicates, joined by pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from foldwise.llm.common import materialise, table, unsigned
from foldwise.llm.components import components

BITS = 64
#: Shingle hashes that are unpacked to bits at once (64 bytes each).
BLOCK = 1 << 16


def shingles(text: str | None, words: int, seed: int) -> list[int]:
    """XXH64 of every run of ``words`` words of a text; a shorter text is one run, one without words has none."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return []
    hash_ = xxhash.xxh64_intdigest
    if len(found) <= words:
        return [hash_(b" ".join(found), seed)]
    whole = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    return [
        hash_(whole[a:b], seed) for a, b in zip(starts[: len(found) - words + 1].tolist(), ends[words - 1:].tolist())
    ]


def fingerprint(text: str | None, words: int, seed: int) -> int:
    """A text's fingerprint as a signed 64-bit number; no words (or a NULL text): zero."""
    return majority(shingles(text, words, seed))


def majority(hashes: list[int]) -> int:
    """The bits that more than half of the hashes have, as a signed 64-bit number; no hashes: zero."""
    if not hashes:
        return 0
    values = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(values), BLOCK):
        ones += np.unpackbits(values[at : at + BLOCK], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 5, seed: int = 42, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id) of every row of ``docs`` and the fingerprint ``fp`` of ``text``.

    Words are what ASCII white space separates, with A-Z lower-cased. A shingle is ``words`` of
    them, joined by spaces; a shorter text is one shingle. Bit b of ``fp`` is set if bit b is set
    in more than half of the shingles' XXH64. NULL, empty and blank texts give 0.
    """
    keep = keep or ["doc_id"]
    source = docs.select(*keep, F.col("text").alias("__text"))
    schema = docs.select(*keep).schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            fps = pa.array([fingerprint(t.as_py(), words, seed) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], fps], [*batch.schema.names[:-1], "fp"])

    return source.mapInArrow(run, schema)


def segment(column: str, index: int, parts: int) -> tuple[str, int]:
    """SQL for the ``index``-th of ``parts`` near-equal runs of bits of a bigint, and its width."""
    low, high = index * BITS // parts, (index + 1) * BITS // parts
    return f"(shiftrightunsigned({column}, {low}) & {(1 << (high - low)) - 1}L)", high - low


def links(values: DataFrame, distance: int = 3) -> DataFrame:
    """Pairs a < b of the distinct bigints ``fp`` that differ in at most ``distance`` (1 to 15) bits.

    The bits lie in distance + 1 segments on a ring. Were the differences of some chain of l
    segments from every start above l * distance / (distance + 1), their total would be above
    ``distance``; so each pair has a start whose chains of 1, 2, 3, ... segments differ in at
    most 0, 1, 2, ... bits. The first two boxes form the join key: the first segment alike, the
    second alike or one bit apart, for which one side lists the variants. The longer chains are
    filters on the joined pair, before the full check. Nothing is lost, and a key spans two
    segments, so that a bucket stays small where one segment alone would not be selective.
    """
    parts = distance + 1
    keyed, probes = [], []
    for i in range(parts):
        first, _ = segment("fp", i, parts)
        second, width = segment("fp", (i + 1) % parts, parts)
        keyed.append(f"named_struct('i', {i}, 'u', {first}, 'v', {second})")
        flips = "array(" + ", ".join(["0L", *(f"{1 << b}L" for b in range(width))]) + ")"
        probes.append(f"transform({flips}, f -> named_struct('i', {i}, 'u', {first}, 'v', {second} ^ f))")
    left = values.selectExpr("fp AS a", f"inline(array({', '.join(keyed)}))")
    right = values.selectExpr("fp AS b", f"inline(flatten(array({', '.join(probes)})))")
    pairs = left.join(right, ["i", "u", "v"]).where("a < b")
    chains = []
    for i in range(parts):
        reach = ["TRUE"]
        for length in range(3, parts):
            total = " + ".join(
                f"bit_count({segment('x', (i + j) % parts, parts)[0]})" for j in range(length)
            )
            reach.append(f"{total} <= {length - 1}")
        chains.append(f"(i = {i} AND {' AND '.join(reach)})")
    return (
        pairs.selectExpr("a", "b", "i", "a ^ b AS x").where(" OR ".join(chains))
        .where(f"bit_count(x) <= {distance}").select("a", "b").distinct()
    )


def near_duplicates(docs: DataFrame, words: int = 5, distance: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp and component_id of every row of ``docs`` (doc_id bigint, text).

    Rows of one fingerprint form a class; only distinct fingerprints are joined, so copies never
    meet in pairs. component_id is the smallest doc_id reachable over links of at most
    ``distance`` differing bits, the row's own included; NULL ids don't count, and a component
    with only NULL ids has a NULL id. Repeated rows stay; other columns are ignored; an empty
    table gives an empty one. All texts without words share the fingerprint zero.
    """
    marked = materialise(fingerprints(docs, words, seed))
    classes = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(classes.select("fp"), distance))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, words: int = 5, distance: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each component of :func:`near_duplicates`: that of the smallest doc_id.

    Rows without an id can't be named, so they stay and stand for no group.
    """
    named = docs.where("doc_id IS NOT NULL")
    found = near_duplicates(named, words, distance, seed)
    first = found.where("doc_id = component_id").select("doc_id").distinct()
    kept = named.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id IS NULL")).select(docs.columns)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by 3-word SimHash fingerprints within 3 bits."""
    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), words=3, distance=3)
    return found.selectExpr("doc_id", f"{unsigned('fp')} AS fingerprint", "component_id")


QUERIES = {"op8_simhash": op8_simhash}
ORACLE: dict[str, str] = {}
