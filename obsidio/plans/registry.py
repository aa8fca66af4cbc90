"""Every registered query and its SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

MODULES = ("history", "relational", "matching", "cleaning", "documents", "marts", "models", "predicates", "raw", "resolution", "streams")

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function by its name, with the SQL that gives the same rows, where there is one."""

    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"obsidio.plans.{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
