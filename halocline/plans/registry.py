"""Queries over the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

from halocline.plans import (
    catalog_queries,
    check_queries,
    coast_queries,
    flow_queries,
    label_queries,
    lineage_queries,
    region_queries,
    section_queries,
    space_queries,
    store_queries,
    time_queries,
)
from halocline.plans.flow_queries import flagship

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]

MODULES = (flow_queries, time_queries, region_queries, space_queries, check_queries, label_queries, catalog_queries, coast_queries, section_queries, store_queries, lineage_queries)
QUERIES = {name: f for m in MODULES for name, f in m.REG.queries.items()}
ORACLE_SQL = {name: sql for m in MODULES for name, sql in m.REG.sql.items()}
