"""Compare registered queries with their SQL on the same Parquet tables."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("FOLDWISE_DATA", "/root/testdata/sf0.001")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def cell(v):
        if v is None or (isinstance(v, float) and v != v) or v is pd.NaT or v is pd.NA:
            return ""
        if hasattr(v, "tolist"):
            v = v.tolist()
        if isinstance(v, float):
            return repr(v + 0.0)
        if isinstance(v, list):
            return str([cell(x) for x in v])
        return str(v)

    return sorted(tuple(cell(v) for v in row) for row in frame.astype(object).itertuples(index=False))


def compare(spark, con, name, query, sql, folder) -> list[str]:
    """Differences between the Spark result and the SQL result, empty when they agree."""
    got = query(spark, folder).toPandas()
    want = con.execute(sql).fetch_df()
    problems = []
    if sorted(got.columns) != sorted(want.columns):
        return [f"{name}: columns {sorted(got.columns)} != {sorted(want.columns)}"]
    for c in sorted(got.columns):
        if got[c].dtype != want[c].dtype and len(got):
            problems.append(f"{name}: {c} is {got[c].dtype} in Spark, {want[c].dtype} in SQL")
    if len(got) != len(want):
        problems.append(f"{name}: {len(got)} rows != {len(want)}")
    a, b = canonical(got), canonical(want)
    if a != b:
        extra = [r for r in a if r not in set(b)][:3]
        missing = [r for r in b if r not in set(a)][:3]
        problems.append(f"{name}: values differ\n  spark {extra}\n  sql   {missing}")
    if not len(got):
        problems.append(f"{name}: no rows")
    return problems


def main() -> int:
    from foldwise.plans import registry
    from foldwise.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else DATA
    names = sys.argv[2:] or list(registry.QUERIES)
    spark, con, bad = local_session(8), connect(folder), 0
    for name in names:
        start = time.time()
        try:
            if name in registry.ORACLE:
                problems = compare(
                    spark, con, name, registry.QUERIES[name], registry.ORACLE[name], folder
                )
            else:
                rows = registry.QUERIES[name](spark, folder).count()
                problems = [] if rows else [f"{name}: no rows"]
        except Exception as e:  # report and go on with the next query
            problems = [f"{name}: {type(e).__name__} {str(e)[:1500]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s", flush=True)
        for p in problems:
            print("    ", p, flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
