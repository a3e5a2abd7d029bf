"""Query registry: name -> (Spark query, optional DuckDB oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

_QUERIES: dict[str, Callable] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``sql`` is
    the independent oracle computed straight from the flat tables."""
    def deco(fn):
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql.strip()
        return fn
    return deco


def queries() -> dict[str, Callable]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
