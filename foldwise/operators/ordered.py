"""Ordered work without a single-task bottleneck.

A window over one hot group, or over the whole table, runs in one task. The operators here
cut the order into chunks, aggregate each chunk, carry the bounded chunk table forward and
finish inside the chunks, so no task sees more than about one chunk of one group.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from foldwise.session import materialise

CHUNK = "_chunk"
CHUNK_ROWS = 1 << 20
MAX_CHUNKS = 20_000
PROBE_CUTS = 256
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
HOT_KEYS = 1_000
HOT_ROWS = 16_000_000
EXACT_ROWS = 1 << 18
SAMPLE_ROWS = 1 << 18
MOST_SAMPLED = 1 << 24
#: Size parameter of quantile sketches, and an upper bound of their rank error at that size.
SKETCH = 8192
WIDE_SKETCH = 65_535
RANK_ERROR = 5e-4


def order_number(df: DataFrame, col: str) -> Column:
    """The column as a double that sorts the same way (times become epoch microseconds)."""
    dtype, c = df.schema[col].dataType, F.col(col)
    if isinstance(dtype, T.NumericType):
        return c.cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(dtype, T.TimestampNTZType):
        clock = F.hour(c) * 3600 + F.minute(c) * 60 + F.extract(F.lit("SECOND"), c)
        return F.unix_date(c.cast("date")).cast("double") * 86_400e6 + clock.cast("double") * 1e6
    raise TypeError(f"{col}: {dtype.simpleString()} has no numeric order")


def sketched_quantiles(
    df: DataFrame, wanted: Sequence[tuple[Column, Sequence[float]]], size: int = SKETCH
) -> tuple[int, list[list[float] | None]]:
    """The number of rows, and near quantiles of several double columns; None for one without values.

    Every partition builds one mergeable sketch a column. Partitions i^2 to (i+1)^2 - 1 merge in
    one group, so n partitions make about sqrt(n) groups of at most 2 sqrt(n) sketches each, and
    the last task merges one sketch a group. NULL and NaN have no rank.
    """
    group = F.floor(F.sqrt(F.spark_partition_id())).alias("_group")
    names = [f"s{i}" for i in range(len(wanted))]
    groups = df.groupBy(group).agg(F.count(F.lit(1)).alias("rows"), *[
        F.kll_sketch_agg_double(c.cast("double"), size).alias(n) for n, (c, _) in zip(names, wanted, strict=True)
    ])
    merged = groups.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), *[
        F.kll_merge_agg_double(n, size).alias(n) for n in names
    ])
    row = merged.select("rows", *[
        F.when(
            F.kll_sketch_get_n_double(n) > 0,
            F.kll_sketch_get_quantile_double(n, F.array(*[F.lit(float(p)) for p in probs])),
        ).alias(n) for n, (_, probs) in zip(names, wanted, strict=True)
    ]).first()
    return row["rows"], [row[n] for n in names]


def with_chunks(df: DataFrame, order: str, rows: int = CHUNK_ROWS) -> DataFrame:
    """Add an int column, non-decreasing in ``order``, that splits the table in even parts.

    The cut points are at most ``MAX_CHUNKS`` quantiles, kept as literals in the plan, so a
    recomputed task assigns the same chunk. Equal order values stay together. The number of
    chunks is noted in the column's metadata: a single chunk needs no carry.
    """
    number = order_number(df, order)
    probs = [i / PROBE_CUTS for i in range(1, PROBE_CUTS)]
    total, (cuts,) = sketched_quantiles(df, [(number, probs)])
    chunks = min(MAX_CHUNKS, math.ceil(total / rows))
    if chunks <= 1:
        cuts = []
    elif chunks <= PROBE_CUTS:
        step = PROBE_CUTS // chunks
        cuts = (cuts or [])[step - 1::step]
    else:
        probs = [i / chunks for i in range(1, chunks)]
        cuts = sketched_quantiles(df, [(number, probs)], WIDE_SKETCH)[1][0]
    if not cuts:
        return df.withColumn(CHUNK, F.lit(0).alias(CHUNK, metadata={"chunks": 1}))
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    bucket = Bucketizer(
        splits=splits, inputCol="_order", outputCol="_bucket", handleInvalid="keep"
    )
    out = bucket.transform(df.withColumn("_order", number))
    chunk = F.col("_bucket").cast("int").alias(CHUNK, metadata={"chunks": len(splits)})
    return out.withColumn(CHUNK, chunk).drop("_order", "_bucket")


def chunk_count(df: DataFrame) -> int:
    return df.schema[CHUNK].metadata.get("chunks", MAX_CHUNKS)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on ``keys``, where NULL equals NULL, so that no row is lost."""
    names = {k: f"__right_{k}" for k in keys}
    right = right.withColumnsRenamed(names)
    same = F.lit(True)
    for k, name in names.items():
        same = same & left[k].eqNullSafe(right[name])
    return left.join(right, same, how).drop(*names.values())


def chunk_carry(
    df: DataFrame, group: Sequence[str], partials: Mapping[str, Column],
    carries: Mapping[str, tuple[str, Callable[[Column], Column]]],
) -> DataFrame:
    """Attach to every row what the earlier chunks of its group contribute, NULL if nothing.

    ``partials`` aggregates one chunk; each carry ``name: (partial, fn)`` folds the partials
    of earlier chunks with ``fn``. The carry table has one row per (group, chunk), and the
    window over it sees at most ``MAX_CHUNKS`` rows of one group. A NULL key is a group like any other.
    """
    keys = [*group, CHUNK]
    table = df.groupBy(*keys).agg(*[c.alias(n) for n, c in partials.items()])
    earlier = (
        Window.partitionBy(*group).orderBy(CHUNK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    table = table.select(
        *keys, *[fn(F.col(part)).over(earlier).alias(n) for n, (part, fn) in carries.items()]
    )
    if chunk_count(df) == 1:
        types = {n: table.schema[n].dataType for n in carries}
        return df.withColumns({n: F.lit(None).cast(t) for n, t in types.items()})
    return join_null_safe(df, table, keys, "left")


def rows_before(group: Sequence[str], order: Sequence[str | Column]) -> Window:
    """Earlier rows of the same group within one chunk."""
    return (
        Window.partitionBy(*group, CHUNK).orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def row_number_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "position",
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """1-based position in the group; ``order[0]`` numeric or time, the rest break ties.

    The chunk column stays on the result for later steps on the same order.
    """
    if CHUNK not in df.columns:
        df = with_chunks(df, order[0], rows)
    df = chunk_carry(
        df, group, {"_rows": F.count(F.lit(1))}, {"_offset": ("_rows", F.sum)}
    )
    inside = Window.partitionBy(*group, CHUNK).orderBy(*order)
    position = F.row_number().over(inside) + F.coalesce(F.col("_offset"), F.lit(0))
    return df.withColumn(name, position.cast("bigint")).drop("_offset")


@dataclass
class Span:
    """Neighbouring ranks of one column, known to lie strictly inside ``(lo, hi)``.

    ``base`` values are at or below ``lo`` and ``inside`` values lie between; an end that is
    None is open.
    """

    name: str
    ranks: list[int]
    inside: int
    base: int = 0
    lo: float | None = None
    hi: float | None = None
    slack: float = 1.0

    def within(self, c: Column) -> Column:
        if self.lo is not None:
            c = F.when(c > F.lit(self.lo), c)
        if self.hi is not None:
            c = F.when(c < F.lit(self.hi), c)
        return c

    def shares(self, sampled: float) -> list[float]:
        """Quantiles of a sample of ``sampled`` values that should enclose the ranks."""
        margin = min(0.25, self.slack * (RANK_ERROR + 2.0 / math.sqrt(max(sampled, 1.0))))
        ends = [(r - self.base) / max(self.inside - 1, 1) for r in (self.ranks[0], self.ranks[-1])]
        return [max(0.0, ends[0] - margin), min(1.0, ends[1] + margin)]


def order_statistics(
    df: DataFrame, cols: Mapping[str, Column], ranks: Mapping[str, Sequence[int]],
    exact_rows: int = EXACT_ROWS, counts: Mapping[str, int] | None = None,
) -> dict[str, dict[int, float]]:
    """Exact values at 0-based ``ranks`` of several double columns.

    Each round takes two passes over all columns: quantiles of a sample propose a bracket
    around neighbouring ranks, and exact counts over all rows settle the ranks at its ends
    and bound those between; a bracket that missed is proposed again, wider. When the rows
    left between all ends fit ``exact_rows`` their distinct values are counted and read off.
    Only brackets reach the driver, and a tie of any size ends at a bracket's end.
    """
    if counts is None:
        counts = df.agg(*[F.count(c).alias(n) for n, c in cols.items()]).first().asDict()
    found: dict[str, dict[int, float]] = {n: {} for n in cols}
    spans = []
    for n in cols:
        for r in sorted(set(ranks.get(n, ()))):
            if not 0 <= r < counts[n]:
                raise ValueError(f"{n} has {counts[n]} values, no rank {r}")
            if spans and spans[-1].name == n and r - spans[-1].ranks[-1] <= 1:
                spans[-1].ranks.append(r)
            else:
                spans.append(Span(n, [r], counts[n]))
    trial, exact_rows = 0, max(exact_rows, 16 * len(spans))
    while sum(span.inside for span in spans) > exact_rows:
        fewest = min(span.inside for span in spans)
        wanted = min(max(fewest / 100, SAMPLE_ROWS), MOST_SAMPLED)
        part = min(1.0, wanted / fewest)
        sample = df if part == 1.0 else df.sample(part, seed=trial)
        shares = [span.shares(math.inf if part == 1.0 else part * span.inside) for span in spans]
        trial += 1
        _, proposed = sketched_quantiles(
            sample, [(span.within(cols[span.name]), q) for span, q in zip(spans, shares, strict=True)]
        )
        brackets = []
        for i, (span, (low, high)) in enumerate(zip(spans, shares, strict=True)):
            lo, hi = proposed[i] or (span.lo, span.hi)
            brackets.append((lo if low > 0 else span.lo, hi if high < 1 else span.hi))
        tests = {
            f"{tag}{i}": test
            for i, (span, ends) in enumerate(zip(spans, brackets, strict=True))
            for tag, test in _against(cols[span.name], *ends).items()
        }
        seen = df.agg(F.lit(0), *[F.count_if(t).alias(n) for n, t in tests.items()]).first().asDict()
        spans = [
            left
            for i, (span, ends) in enumerate(zip(spans, brackets, strict=True))
            for left in _settle(span, ends, seen, i, found)
        ]
    for span, rank, value in _read_off(df, cols, spans):
        found[span.name][rank] = value
    return found


def _against(c: Column, lo: float | None, hi: float | None) -> dict[str, Column]:
    tests = {}
    if lo is not None:
        tests |= {"lt_lo": c < F.lit(lo), "le_lo": c <= F.lit(lo)}
    if hi is not None:
        tests |= {"lt_hi": c < F.lit(hi), "le_hi": c <= F.lit(hi)}
    return tests


def _settle(span: Span, ends, seen: Mapping[str, int], i: int, found) -> list[Span]:
    """Record the ranks found at a bracket's ends; return the span still to be searched."""
    lo, hi = ends
    stop = span.base + span.inside
    lt_lo, le_lo = seen.get(f"lt_lo{i}", span.base), seen.get(f"le_lo{i}", span.base)
    lt_hi, le_hi = seen.get(f"lt_hi{i}", stop), seen.get(f"le_hi{i}", stop)
    if span.ranks[0] < lt_lo or span.ranks[-1] >= le_hi:
        return [replace(span, slack=span.slack * 2)]
    left = []
    for r in span.ranks:
        if lo is not None and r < le_lo:
            found[span.name][r] = lo
        elif hi is not None and r >= lt_hi:
            found[span.name][r] = hi
        else:
            left.append(r)
    return [replace(span, ranks=left, base=le_lo, inside=lt_hi - le_lo, lo=lo, hi=hi)] if left else []


def _read_off(df, cols, spans):
    """Values at the ranks left, from the counted distinct values inside their brackets."""
    if not spans:
        return []
    members = F.array(*[
        F.struct(F.lit(i).alias("slot"), span.within(cols[span.name]).alias("v"))
        for i, span in enumerate(spans)
    ])
    # Few values are inside: the others are left out before they become rows.
    members = F.filter(members, lambda m: m["v"].isNotNull())
    counted = (
        df.select(F.explode(members).alias("m"))
        .groupBy("m.slot", "m.v").agg(F.count(F.lit(1)).alias("rows"))
    )
    # A slot holds at most its bracket's rows, whose sum was checked against exact_rows.
    upto = F.sum("rows").over(Window.partitionBy("slot").orderBy("v"))
    wanted = F.create_map(*[
        x for i, span in enumerate(spans)
        for x in (F.lit(i), F.array(*[F.lit(r - span.base) for r in span.ranks]))
    ])
    reached = F.filter(
        wanted[F.col("slot")],
        lambda at: (F.col("upto") - F.col("rows") <= at) & (at < F.col("upto")),
    )
    hits = (
        counted.withColumn("upto", upto)
        .select("slot", "v", F.explode(reached).alias("at")).collect()
    )
    return [(spans[h["slot"]], h["at"] + spans[h["slot"]].base, h["v"]) for h in hits]


def exact_quantiles(
    df: DataFrame, exprs: Mapping[str, Column], probs: Sequence[float],
    exact_rows: int = EXACT_ROWS,
) -> dict[str, list[float | None]]:
    """Exact interpolated quantiles of several columns; None for a column without values.

    One task merges the counted values of the built-in aggregate, so it serves only up to
    ``exact_rows`` values in all columns together; beyond, the ranks are searched.
    """
    cols = {n: e.cast("double") for n, e in exprs.items()}
    cols = {n: F.when(~F.isnan(c), c) for n, c in cols.items()}
    if not cols:
        return {}
    counts = df.agg(*[F.count(c).alias(n) for n, c in cols.items()]).first().asDict()
    if sum(counts.values()) <= exact_rows:
        row = df.agg(*[F.percentile(c, list(probs)).alias(n) for n, c in cols.items()]).first()
        return {n: list(row[n]) if row[n] is not None else [None] * len(probs) for n in cols}
    ranks = {}
    for n, count in counts.items():
        at = [p * (count - 1) for p in probs] if count else []
        ranks[n] = sorted({f(a) for a in at for f in (math.floor, math.ceil)})
    values = order_statistics(df, cols, ranks, exact_rows, counts)
    out: dict[str, list[float | None]] = {}
    for n, count in counts.items():
        out[n] = []
        for p in probs:
            if not count:
                out[n].append(None)
                continue
            at = p * (count - 1)
            lo, hi = math.floor(at), math.ceil(at)
            a, b = values[n][lo], values[n][hi]
            out[n].append(a if lo == hi else (hi - at) * a + (at - lo) * b)
    return out


def medians_without_fold(
    df: DataFrame, exprs: Mapping[str, Column], fold: str, counts: Mapping[int, Mapping[str, int]],
    folds: Sequence[int], exact_rows: int = EXACT_ROWS,
) -> dict[str, dict[int, float | None]]:
    """For every column and held-out fold the exact median of the other folds' values.

    ``counts`` has the number of values per fold and column. The medians lie close together, so
    one bracket of a column, from a sample, is proposed for all of them, and one pass grouped
    by fold proves it: the counts of a training set are sums over its folds. Columns whose
    bracket misses or holds too many values are searched fold by fold instead. The values at the
    bracket's ends, however many, are counted in that pass; only those between are read off.
    """
    cols = {n: e.cast("double") for n, e in exprs.items()}
    cols = {n: F.when(~F.isnan(c), c) for n, c in cols.items()}
    out: dict[str, dict[int, float | None]] = {n: dict.fromkeys(folds) for n in cols}

    def others(h: int, of: Callable) -> int:
        return sum(of(f) for f in counts if f != h)

    sizes = {n: {h: others(h, lambda f: counts[f][n]) for h in folds} for n in cols}
    whole = {n: sum(c[n] for c in counts.values()) for n in cols}
    left = [n for n in cols if any(sizes[n].values())]
    if not left:
        return out
    wanted = {n: {h: (math.floor((c - 1) / 2), math.ceil((c - 1) / 2)) for h, c in sizes[n].items() if c} for n in left}
    most = max(whole[n] for n in left)
    part = min(1.0, min(max(most / 100, SAMPLE_ROWS), MOST_SAMPLED) / most)
    shares = {n: Span(n, [whole[n] // 2], whole[n]).shares(part * whole[n]) for n in left}
    sample = df if part == 1.0 else df.sample(part, seed=0)
    _, found = sketched_quantiles(sample, [(cols[n], shares[n]) for n in left])
    ends = dict(zip(left, found, strict=True))
    tried = [n for n in left if ends[n]]
    strictly = {n: (cols[n] > F.lit(ends[n][0])) & (cols[n] < F.lit(ends[n][1])) for n in tried}
    seen = {
        r[fold]: r for r in df.groupBy(fold).agg(F.lit(0), *[
            F.count_if(test).alias(f"{tag}{i}") for i, n in enumerate(tried)
            for tag, test in (
                ("below", cols[n] < F.lit(ends[n][0])), ("upto", cols[n] <= F.lit(ends[n][0])),
                ("before", cols[n] < F.lit(ends[n][1])), ("in", cols[n] <= F.lit(ends[n][1])), ("strict", strictly[n]),
            )
        ]).collect()
    }
    proven, room, values, between = [], exact_rows, {}, []
    for i, n in enumerate(tried):
        below, upto, before, within = (
            {h: others(h, lambda f: seen[f][f"{tag}{i}"]) for h in folds} for tag in ("below", "upto", "before", "in")
        )
        rows = sum(r[f"strict{i}"] for r in seen.values())
        if rows > room or any(a < below[h] or b >= within[h] for h, (a, b) in wanted[n].items()):
            continue
        proven.append(n)
        room -= rows
        lo, hi = ends[n]
        reads = {h: set() for h in folds}
        for h, ranks in wanted[n].items():
            for r in ranks:
                if r < upto[h]:
                    values[n, h, r] = lo
                elif r >= before[h]:
                    values[n, h, r] = hi
                else:
                    reads[h].add(r)
        if any(reads.values()):
            between.append((n, reads, upto))
    if between:
        found = _read_off_by_fold(df, [F.when(strictly[n], cols[n]) for n, _, _ in between], fold, [
            [{r - upto[h] for r in reads[h]} for h in folds] for _, reads, upto in between
        ], folds)
        for slot, (n, reads, upto) in enumerate(between):
            values |= {(n, h, r): found[slot, i, r - upto[h]] for i, h in enumerate(folds) for r in reads[h]}
    for n in proven:
        for h, ranks in wanted[n].items():
            a, b = (values[n, h, r] for r in ranks)
            out[n][h] = a if a == b else 0.5 * a + 0.5 * b
    rest = {f"{i}_{h}": (n, h) for i, n in enumerate(left) if n not in proven for h in folds}
    searched = exact_quantiles(
        df, {k: F.when(F.col(fold) != h, cols[n]) for k, (n, h) in rest.items()}, [0.5], exact_rows
    )
    for k, (n, h) in rest.items():
        out[n][h] = searched[k][0]
    return out


def _read_off_by_fold(df, inside, fold, ranks, folds) -> dict[tuple[int, int, int], float]:
    """(slot, held-out fold, rank) to value, from values counted by fold; the rows were bounded before."""
    members = F.array(*[F.struct(F.lit(i).alias("slot"), c.alias("v")) for i, c in enumerate(inside)])
    members = F.filter(members, lambda m: m["v"].isNotNull())
    counted = df.select(F.col(fold).alias("_fold"), F.explode(members).alias("m")).groupBy(
        "m.slot", "m.v"
    ).agg(*[F.count_if(F.col("_fold") != h).alias(f"n{i}") for i, h in enumerate(folds)])
    upto = Window.partitionBy("slot").orderBy("v")

    def reached(i: int) -> Column:
        at = F.create_map(*[
            x for slot, per in enumerate(ranks)
            for x in (F.lit(slot), F.array(*map(F.lit, sorted(per[i]))).cast("array<bigint>"))
        ])[F.col("slot")]
        here = F.filter(at, lambda r: (F.col(f"u{i}") - F.col(f"n{i}") <= r) & (r < F.col(f"u{i}")))
        return F.transform(here, lambda r: F.struct(F.lit(i).alias("held"), r.alias("at")))

    hits = F.concat(*map(reached, range(len(folds))))
    rows = counted.withColumns({f"u{i}": F.sum(f"n{i}").over(upto) for i in range(len(folds))}).select(
        "slot", "v", F.explode(hits).alias("x")
    ).collect()
    return {(r["slot"], r["x"]["held"], r["x"]["at"]): r["v"] for r in rows}


def first_rows(
    df: DataFrame, order: Column, tie: str, n: int, exact_rows: int = EXACT_ROWS,
    small: int = 10_000,
) -> DataFrame:
    """The first ``n`` rows by a numeric order, ties by ``tie``.

    A small ``n`` is a plain top-n. A large one would merge ``n`` rows of every partition in
    one task, so the n-th value is found first and the rows below it are a plain filter.
    """
    numbered = df.withColumn("_order", order.cast("double"))
    if n <= small:
        return numbered.orderBy("_order", tie).limit(n).drop("_order")
    total = df.agg(F.count(F.lit(1))).first()[0]
    if n >= total:
        return df
    cut = order_statistics(
        numbered, {"_order": F.col("_order")}, {"_order": [n - 1]}, exact_rows, {"_order": total}
    )
    cut = cut["_order"][n - 1]
    below = numbered.where(F.col("_order") < cut)
    rest = n - below.count()
    ties = numbered.where(F.col("_order") == cut).orderBy(tie).limit(rest)
    return below.unionByName(ties).drop("_order")


def dense_codes(values: DataFrame, col: str, name: str = "code", rows: int = BROADCAST_ROWS):
    """0-based code of each distinct value in sort order, as a table ``(col, code)``.

    Up to ``rows`` values one window is enough. Beyond, the values are range partitioned, so
    a code is the partition's start plus the position inside it; the partitioned values are
    written first, which fixes both.
    """
    distinct = materialise(values.select(col).where(F.col(col).isNotNull()).distinct())
    if distinct.limit(rows + 1).count() <= rows:
        code = F.row_number().over(Window.orderBy(col)) - 1
        return distinct.select(col, code.cast("bigint").alias(name))
    parts = max(values.rdd.getNumPartitions(), 2)
    placed = materialise(
        distinct.repartitionByRange(parts, col).sortWithinPartitions(col)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    start = F.sum("_rows").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select("_part", F.coalesce(start, F.lit(0)).alias("_start"))
    return (
        placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
        .select(col, (F.col("_start") + inside).cast("bigint").alias(name))
    )


def lookup_join(
    df: DataFrame, table: DataFrame, on: Sequence[str], weight: str | None = None,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join to a table with unique keys, chosen by the table's measured size.

    Up to ``limit`` rows and BROADCAST_BYTES the table is broadcast. Beyond, the keys that carry
    over 1/HOT_KEYS of the rows or over HOT_ROWS of them (one in HOT_ROWS rows at most) are
    broadcast on their own and the other rows are shuffled, so one hot key never lands in one
    task; rows without a key need no join. ``weight`` is a column of the table that counts the rows of each key; without it
    they are counted. The table is written once, so measuring it does not compute it twice.
    """
    on = list(on)
    table = materialise(table)
    n, size = table.limit(limit + 1).agg(
        F.count(F.lit(1)), F.sum(F.length(F.to_json(F.struct("*"))))
    ).first()
    if n <= limit and (size or 0) <= BROADCAST_BYTES:
        return df.join(F.broadcast(table), on, "left")
    if weight is None:
        counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
        total = df.agg(F.count(F.lit(1))).first()[0]
    else:
        counts = table.select(*on, F.col(weight).alias("_rows"))
        total = table.agg(F.sum(weight)).first()[0]
    heavy = materialise(counts.where(F.col("_rows") > F.lit(min(total / HOT_KEYS, HOT_ROWS))).select(*on))
    keyed = F.lit(True)
    for c in on:
        keyed = keyed & F.col(c).isNotNull()
    hot = F.broadcast(table.join(F.broadcast(heavy), on, "left_semi"))
    cold = table.join(F.broadcast(heavy), on, "left_anti")
    rows = df.where(keyed)
    head = rows.join(F.broadcast(heavy), on, "left_semi").join(hot, on, "left")
    tail = rows.join(F.broadcast(heavy), on, "left_anti").join(cold, on, "left")
    rest = df.where(~keyed).withColumns({
        f.name: F.lit(None).cast(f.dataType) for f in table.schema.fields if f.name not in on
    })
    return head.unionByName(tail).unionByName(rest)
