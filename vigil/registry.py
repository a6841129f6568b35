"""Query registry: name -> (spark callable, DuckDB oracle SQL or None).

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame over the whole adapter tables of that
folder. Registration happens in the modules that own the operators; this module only collects them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle_sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        _QUERIES[name] = fn
        if oracle_sql is not None:
            _ORACLES[name] = oracle_sql
        return fn

    return deco


def _load_all() -> None:
    # importing the modules registers their queries
    from vigil import queries  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)
