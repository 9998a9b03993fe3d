"""Query registry. ``register(name, sql)`` records a plan and, when it is SQL-expressible, its oracle."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

_MODULES = [
    "tallyframe.plans.pmf_plans",
    "tallyframe.plans.cdf_plans",
    "tallyframe.plans.monoid_plans",
    "tallyframe.plans.bayes_plans",
    "tallyframe.plans.sketch_plans",
    "tallyframe.plans.fold_plans",
    "tallyframe.plans.dist_plans",
    "tallyframe.plans.stream_plans",
]


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def _load_all() -> None:
    for m in _MODULES:
        importlib.import_module(m)


def all_queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
