"""Registered plans: each query reads the given tables and returns a DataFrame, next to its DuckDB oracle."""

from tallyframe.plans.catalog import ORACLE, QUERIES, all_queries, oracle_sql  # noqa: F401
