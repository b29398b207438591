"""Queries of the numbered problems that belong to training data, over whole tables."""

from __future__ import annotations

from clonewell.llm import text_queries
from clonewell.llm.table_queries import QUERIES as _TABLES, SQL as _TABLES_SQL

QUERIES = _TABLES | text_queries.QUERIES
SQL = _TABLES_SQL | text_queries.SQL
