"""All queries of the package over the driver's tables, with SQL for those that SQL can express."""

from __future__ import annotations

from stereobate.plans import catalogues, derived, evidence, gates, lines, mesh, rings, rulesets, shapes, shells, silhouettes, sites

QUERIES: dict = {}
ORACLE_SQL: dict = {}
for _plans in (mesh, lines, catalogues, rulesets, evidence, derived, shapes, shells, gates, rings, sites, silhouettes):
    QUERIES |= _plans.R.queries
    ORACLE_SQL |= _plans.R.sql
