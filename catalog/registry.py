"""Collects queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

_MODULES = [
    "catalog.profile_queries",
    "catalog.quality_queries",
    "catalog.cleaning_queries",
    "catalog.feature_queries",
    "catalog.forecast_queries",
]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its SQL twin."""

    def register(function: Query) -> Query:
        _QUERIES[function.__name__] = function
        if sql is not None:
            _ORACLES[function.__name__] = sql
        return function

    return register


def _load() -> None:
    for module in _MODULES:
        import_module(module)


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
