"""Registry of named queries: a DataFrame function over :class:`Inputs` and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strainwise.plans.derived import Inputs, render
from strainwise.session import configure

_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(inputs) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Inputs], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return register


def oracle(name: str) -> str:
    """The SQL of a query registered before, to be built upon."""
    return _ORACLES[name]


def _load() -> None:
    from strainwise.plans import decisions, genomics, intake, laboratory, primitives  # noqa: F401


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: (lambda spark, folder, fn=fn: fn(Inputs(configure(spark), folder))) for name, fn in _QUERIES.items()}


def all_oracles() -> dict[str, str]:
    _load()
    return {name: render(sql) for name, sql in _ORACLES.items()}
