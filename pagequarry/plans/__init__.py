"""All queries on the reference data planes, registered by module."""

from __future__ import annotations

from . import evidence_queries, measure_queries, package_queries, page_queries, storage_queries, table_queries
from .registry import QUERIES, SQL

MODULES = (evidence_queries, page_queries, table_queries, measure_queries, package_queries, storage_queries)


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
