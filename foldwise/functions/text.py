"""Text functions over columns of replies, paths, identifiers and JSON records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats of replies and truncation marks.
FENCE_BODY = r"(?s)```python\n(.*?)\n```"
FENCE_WHOLE = r"(?s)```python.*?```"
HEAD_LIMIT = 8000
HEAD_MARK = "\n... [TRUNCATED FOR BREVITY] ..."
TAIL_LIMIT = 1500
TAIL_MARK = "...[TRUNCATED]...\n"
WHITESPACE = " \t\n\r\f\x0b"


def strip(c: Column) -> Column:
    """Trim every ASCII whitespace character, not only blanks."""
    return F.btrim(c, F.lit(WHITESPACE))


def extract_code(c: Column) -> Column:
    """First fenced block, else the whole text; NULL when nothing is left."""
    fenced = F.when(c.rlike(FENCE_BODY), F.regexp_extract(c, FENCE_BODY, 1)).otherwise(c)
    return F.nullif(strip(fenced), F.lit(""))


def without_code(c: Column, empty: str = "No reasoning provided by LLM.") -> Column:
    """The prose around fenced blocks; a fixed phrase when there is none."""
    prose = strip(F.regexp_replace(c, FENCE_WHOLE, ""))
    return F.when(prose == "", F.lit(empty)).otherwise(prose)


def truncate_head(c: Column, limit: int = HEAD_LIMIT, mark: str = HEAD_MARK) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit)), F.lit(mark))).otherwise(c)


def truncate_tail(c: Column, limit: int = TAIL_LIMIT, mark: str = TAIL_MARK) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.lit(mark), F.right(c, F.lit(limit)))).otherwise(c)


def one_line(c: Column) -> Column:
    return strip(F.replace(c, F.lit("\n"), F.lit(" ")))


def short_id(c: Column, length: int = 7) -> Column:
    return F.left(c.cast("string"), F.lit(length))


def slug(c: Column) -> Column:
    """Name made of ``[a-zA-Z0-9._-]``; empty or reserved names become ``default``."""
    cleaned = F.regexp_replace(strip(F.coalesce(c, F.lit(""))), "[^a-zA-Z0-9._-]+", "-")
    cleaned = F.btrim(cleaned, F.lit("-."))
    return F.when(cleaned.isin("", "main"), F.lit("default")).otherwise(cleaned)


def path_parts(c: Column) -> Column:
    """Path components; an absolute path starts with the component ``/``."""
    names = F.filter(F.split(c, "/"), lambda p: (p != "") & (p != "."))
    root = F.array(F.lit("/"))
    return F.when(c.startswith("/"), F.concat(root, names)).otherwise(names)


def path_stem(name: Column) -> Column:
    """File name without its last suffix; a leading or trailing dot starts no suffix."""
    return F.regexp_replace(name, r"^(.+)\.[^.]+$", "$1")


def dataset_name(c: Column) -> Column:
    """``data/<x>/f.csv`` gives x, ``data/f.csv`` gives f, else the parent folder or the stem."""
    parts = path_parts(c)
    n = F.size(parts)
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    stem = path_stem(F.get(parts, n - 1))
    parent = F.get(parts, n - 2)
    return slug(
        F.when((n >= 3) & (first == "data"), second)
        .when((n == 2) & (first == "data"), stem)
        .when((n >= 2) & (parent != "/"), parent)
        .otherwise(stem)
    )


def segment_after(c: Column, marker: str = "data") -> Column:
    """Component after the first ``marker`` component, NULL when there is none."""
    parts = path_parts(c)
    at = F.array_position(parts, marker)
    return F.when(at > 0, F.get(parts, at.cast("int")))


def json_number(c: Column, key: str) -> Column:
    """Struct ``(value, status)``; status is ok, missing_key or malformed, and no row is lost."""
    parsed = F.from_json(
        c,
        f"`{key}` STRING, _broken STRING",
        {"columnNameOfCorruptRecord": "_broken", "mode": "PERMISSIVE"},
    )
    broken = c.isNull() | parsed.isNull() | parsed["_broken"].isNotNull()
    number = parsed[key].try_cast("double")
    status = (
        F.when(broken, "malformed").when(parsed[key].isNull(), "missing_key")
        .when(number.isNull(), "malformed").otherwise("ok")
    )
    return F.struct(F.when(~broken, number).alias("value"), status.alias("status"))


def is_timeout(c: Column) -> Column:
    """Whether an error message reports a timeout."""
    return F.coalesce(c.contains("Timed Out") | c.contains("TimeoutExpired"), F.lit(False))
