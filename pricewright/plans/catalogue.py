"""The query catalogue: every query by name, and DuckDB SQL for each that SQL can express."""

from __future__ import annotations

from . import audit_queries, identity_queries, market_queries, quality_queries, service_queries, valuation_queries

MODULES = (valuation_queries, market_queries, identity_queries, quality_queries, audit_queries, service_queries)

QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
