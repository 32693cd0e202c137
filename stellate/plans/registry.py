"""Registry of named queries: a Spark builder and, where SQL can say it, the DuckDB oracle text.

Each builder takes (spark, sf_dir) and returns a DataFrame over the given tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Builder] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in _QUERIES:
            raise ValueError(f"duplicate query name {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules fills the registry.
    from stellate.plans import (  # noqa: F401
        q_catalog,
        q_star,
        q_gates,
        q_metrics,
        q_model,
        q_profile,
    )


def queries() -> dict[str, Builder]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)
