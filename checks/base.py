"""Registry of checked queries: each is a Spark query and, where SQL can say it, its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardstone.sources.tables import read_table, spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, name, *columns))


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(name: str, columns: list[str], rows) -> str:
    """A CTE of literals for the DuckDB side."""

    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, (int, float)):
            return repr(v)
        if isinstance(v, (list, tuple)):
            return "[" + ", ".join(lit(x) for x in v) + "]::VARCHAR[]"
        return quote(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"{name}({', '.join(columns)}) AS (VALUES {body})"
