"""The builders by name, and ``build``, which makes a table from raw ones by way of all that it needs."""

from __future__ import annotations

import importlib
import inspect
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from ..sources.raw import write_table

MODELS: dict[str, Callable[..., DataFrame]] = {}


def model(builder: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Register a builder. Its parameters without a default are the tables that it reads, by name."""
    MODELS[builder.__name__] = builder
    return builder


def needs(name: str) -> list[str]:
    """The tables that a builder reads."""
    return [p.name for p in inspect.signature(MODELS[name]).parameters.values() if p.default is p.empty]


def order(name: str, given: Mapping[str, DataFrame] = {}) -> list[str]:  # noqa: B006
    """The builders that have to run for a table, each after those that it needs."""
    found: list[str] = []

    def visit(table: str, above: tuple[str, ...]) -> None:
        if table in given or table in found:
            return
        if table not in MODELS:
            raise KeyError(f"no table and no builder named {table}, needed by {above[-1] if above else 'the caller'}")
        if table in above:
            raise ValueError(f"{table} needs itself: {' > '.join(above)}")
        for other in needs(table):
            visit(other, (*above, table))
        found.append(table)

    visit(name, ())
    return found


def load() -> None:
    """Import the builders."""
    for part in ("staging", "core", "marts"):
        importlib.import_module(f"obsidio.models.{part}")


def build(name: str, tables: Mapping[str, DataFrame], folder: str | None = None, made: dict[str, DataFrame] | None = None, **settings) -> DataFrame:
    """The table ``name``, from ``tables`` by their names.

    With a ``folder`` every table on the way is written there as Parquet and read back, so that one that several others
    read is made once; without one the whole is one plan. ``settings`` go to the builders that have such parameters.
    ``made`` holds tables that were made before, and gets those that are made now.
    """
    load()
    made = {} if made is None else made
    for table in order(name, {**tables, **made}):
        builder = MODELS[table]
        known = {k: v for k, v in settings.items() if k in inspect.signature(builder).parameters}
        df = builder(*[tables[t] if t in tables else made[t] for t in needs(table)], **known)
        made[table] = write_table(df, f"{folder.rstrip('/')}/{table}") if folder else df
    return tables[name] if name in tables else made[name]
