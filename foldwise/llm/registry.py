"""All queries of this subpackage."""

from foldwise.llm import (
    centroids, chat, decontam, htmltext, linededup, packing, quality, runs, secrets, simhash, substrings, topk, toxicity,
)

MODULES = (
    htmltext, decontam, toxicity, quality, packing, secrets, linededup, simhash, topk, chat, runs, centroids, substrings,
)

QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
