"""Key hashes. md5 is used because every SQL engine computes the same value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 42
HASH_RANGE = 1 << 32


def row_key(*cols: str | Column) -> Column:
    """Join key columns into one string. Pass fractional columns as integers (e.g. cents)."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    if len(parts) == 1:
        return parts[0].cast("string")
    return F.concat_ws("|", *[p.cast("string") for p in parts])


def digest(key: Column, salt: object = SEED) -> Column:
    """Hex digest of ``salt|key``: the order used by seeded samples and shuffled folds."""
    return F.md5(F.concat(F.lit(f"{salt}|"), key.cast("string")))


def hash32(key: Column, salt: object = SEED) -> Column:
    """First 32 bits of the digest as a non-negative bigint."""
    return F.conv(F.substring(digest(key, salt), 1, 8), 16, 10).cast("bigint")


def hash52(key: Column, salt: object = SEED) -> Column:
    """First 52 bits of the digest: the largest prefix a double holds exactly."""
    return F.conv(F.substring(digest(key, salt), 1, 13), 16, 10).cast("bigint")


def unit_hash(key: Column, salt: object = SEED) -> Column:
    """Uniform draw in [0, 1) from the key."""
    return hash32(key, salt).cast("double") / F.lit(float(HASH_RANGE))
