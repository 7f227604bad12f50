"""All queries and oracles by name."""

from __future__ import annotations

from tokenloom.plans import corpus, generation, runs, scaling, subwords, tokens

MODULES = [corpus, tokens, subwords, generation, runs, scaling]
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
