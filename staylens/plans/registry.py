"""All queries of the review operators and their SQL, by name."""

from __future__ import annotations

from staylens.plans import chart_queries, link_queries, source_queries, text_queries

MODULES = [chart_queries, text_queries, link_queries, source_queries]


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
