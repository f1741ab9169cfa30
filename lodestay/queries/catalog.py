"""All queries of the warehouse by name."""

from __future__ import annotations

from lodestay.queries import operations, relational, warehouse

PARTS = (warehouse.registry, relational.registry, operations.registry)
QUERIES = {k: q for p in PARTS for k, q in p.queries.items()}
SQL = {k: q for p in PARTS for k, q in p.sql.items()}
