"""The registry of queries and of the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

MODULES = ("ingest", "projections", "scores", "routing", "aggregates", "joins", "windows", "streams", "live")

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the equivalent SQL if there is one."""

    def register(fn: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query {name} is registered twice")
        _queries[name] = fn
        if sql is not None:
            _sql[name] = sql
        return fn

    return register


def _load() -> None:
    for module in MODULES:
        import_module(f"reviewlens.plans.{module}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def all_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
