"""Where query modules register their Spark form and SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

MODULES = (
    "scans", "sinks", "filters", "joining", "grouping", "ordering", "unions",
    "scalars", "streams", "logs", "changing", "schemas", "governing", "metering",
    "checking", "custom", "jobs", "weblogs",
)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``name``; leave ``sql`` out where SQL cannot express the result."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def load_all() -> None:
    for module in MODULES:
        import_module(f"millrace.plans.{module}")
