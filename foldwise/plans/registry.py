"""All registered queries."""

from foldwise.plans import (
    formatting, leaderboard, models, preparing, profiling, runlogs, streams, texts,
)

MODULES = (leaderboard, profiling, preparing, formatting, runlogs, texts, models, streams)

QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
