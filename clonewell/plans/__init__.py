"""Queries over the tables, and SQL that must give the same rows."""

from __future__ import annotations

from clonewell.plans import assay_queries, clone_queries, general, library_queries, match_queries, quality_queries

QUERIES: dict = {}
SQL: dict = {}
for _module in (general, library_queries, assay_queries, match_queries, clone_queries, quality_queries):
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL
