"""Name -> query and name -> SQL of the engine's own operators; each query runs over its whole tables."""

from __future__ import annotations

from tessera.plans import queries_ask, queries_graph, queries_layers, queries_parse, queries_search, queries_text

PARTS = (queries_layers, queries_search, queries_graph, queries_parse, queries_text, queries_ask)
QUERIES: dict = {name: run for part in PARTS for name, run in part.QUERIES.items()}
SQL: dict = {name: sql for part in PARTS for name, sql in part.SQL.items()}
