"""All queries over the engine's own operators, by name, with their SQL counterparts."""

from __future__ import annotations

from . import decision_queries, frame_queries, kernel_queries, map_queries, record_queries

_PARTS = (frame_queries, map_queries, kernel_queries, record_queries, decision_queries)


def queries() -> dict:
    return {name: query for part in _PARTS for name, (query, _) in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, (_, sql) in part.QUERIES.items() if sql}
