"""Reading tables, and small fixed tables as DataFrames."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spread(df: DataFrame) -> DataFrame:
    """Spread rows over the cores when the input has fewer splits than cores.

    One unsplittable file means one task, whatever work follows. Big inputs have far more
    splits than cores and pass through unchanged, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def read_table(spark: SparkSession, directory: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{directory}/{name}.parquet")
    return df.select(*columns) if columns else df


def cut(df: DataFrame) -> DataFrame:
    """The same rows, computed once and written to the folder that the session names in spark.checkpoint.dir.

    Where it names none, as in tests, a temporary folder is set.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="wardstone-"))
    return df.checkpoint()


def sql_literal(value) -> str:
    """A Python value as Spark SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value) + ("D" if isinstance(value, float) else "")
    if isinstance(value, (list, tuple)):
        inner = ", ".join(sql_literal(v) for v in value)
        return f"array({inner})" if value else "CAST(array() AS array<string>)"
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def fixed_table(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence]) -> DataFrame:
    """A table of literals, which the optimizer sees as a local relation of known size."""
    body = ", ".join("(" + ", ".join(sql_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(columns)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")


def lookup(df: DataFrame, dim: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Join to a fixed table. Its size is known when it is written, so it is broadcast."""
    return df.join(F.broadcast(dim), on, how)


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Rows of a small configuration table; refuses a table that is not small."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows; this is not a configuration table")
    return rows
