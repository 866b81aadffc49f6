"""Registry of named queries: a Spark plan plus the equivalent DuckDB SQL.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables. ``oracle_sql`` holds, for the same name, ANSI SQL that
DuckDB runs over views of the same parquet files; column names match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLES)


def _load_all() -> None:
    # Importing the modules registers their queries.
    from sluice.plans import q_documents, q_incremental, q_logs, q_sinks, q_star, q_weather  # noqa: F401
