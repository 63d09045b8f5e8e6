"""Named queries and their SQL oracles.

Each registered query is a function ``(spark, base_dir) -> DataFrame`` that
reads the test tables under ``base_dir`` and runs a library operator over
all of their rows.  ``oracle`` is DuckDB SQL over views of the same tables
with the same output column names; queries that SQL cannot express leave it
out and are checked by row count only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle.strip()
        return fn
    return deco


def _load_all() -> None:
    # importing the catalog modules fills the registry
    from tidepool.plans import (  # noqa: F401
        cat_basic, cat_aggregates, cat_windows, cat_joins, cat_nested,
        cat_analytics, cat_changes, cat_medallion, cat_quality, cat_governance,
        cat_streaming, cat_io,
    )


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)
