"""All queries and their SQL counterparts."""

from __future__ import annotations

from oreline.plans import analytic_queries, dimension_queries, layout_queries, load_queries, quality_queries, upkeep_queries

_MODULES = (analytic_queries, layout_queries, load_queries, dimension_queries, quality_queries, upkeep_queries)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
