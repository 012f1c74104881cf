"""Registry of the queries exposed to ``__spark_entry__``.

Each entry binds one or more operators to the driver's tables. ``sql`` is the same
result written in plain SQL over the table views (DuckDB dialect); it is ``None`` where
the operator is iterative and is then checked against brute force in tests.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    operators: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def register(name: str, operators: tuple[str, ...], sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, operators)
        return fn
    return deco


def load_all_bindings() -> dict[str, Query]:
    # Importing the modules fills the registry.
    from starloom.plans import (  # noqa: F401
        bind_blocks, bind_cubes, bind_dims, bind_extract, bind_facts, bind_intake, bind_mart_checks, bind_mart_reports, bind_mart_tables, bind_marts, bind_quality, bind_reports, bind_snapshots,
    )
    return REGISTRY
