"""Detector catalogues: built in, replaced by the user, or synced from a remote list."""

from __future__ import annotations

from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardstone.functions.text import java_pattern
from wardstone.sources import fixed_values as fixed
from wardstone.sources.tables import bounded_rows, fixed_table

MAX_DETECTORS = 1_000

# Built-in detectors whose outermost characters are not always word characters.
_OPEN_START = {"email", "phone", "private_key"}
_OPEN_END = {"api_key", "private_key"}


class Detector(NamedTuple):
    name: str
    prefix: str
    pattern: str  # Java form
    priority: int
    builtin: bool = False


def builtin_catalogue() -> list[Detector]:
    return [
        Detector(
            name,
            prefix,
            java_pattern(pattern, nocase, name not in _OPEN_START, name not in _OPEN_END),
            i,
            True,
        )
        for i, (name, prefix, nocase, pattern) in enumerate(fixed.DETECTORS)
    ]


def catalogue_table(spark: SparkSession) -> DataFrame:
    """The built-in catalogue as a table: priority, name, prefix, ignore_case, pattern."""
    rows = [(i, n, p, c, x) for i, (n, p, c, x) in enumerate(fixed.DETECTORS)]
    return fixed_table(spark, ["priority", "name", "prefix", "ignore_case", "pattern"], rows)


def prefix_table(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, ["threat_type", "prefix"], fixed.REMOTE_PREFIXES)


def usable_remote(remote: DataFrame) -> DataFrame:
    """Remote rows (ordinal, pattern, threat_type, confidence) as catalogue rows, in order.

    Rows of unknown type are dropped; a leading ``(?i)`` is stripped, since all synced patterns
    ignore case; order is by the confidence of the first remote row that has the same short
    name, highest first, then as they came.
    """
    spark = remote.sparkSession
    named = remote.withColumn("name", F.regexp_replace("threat_type", "^pii_", ""))
    # One row per short name: a partial aggregate, so a name with many rows stays cheap.
    first = named.groupBy("name").agg(
        F.coalesce(F.min_by("confidence", "ordinal"), F.lit(0.0)).alias("first_confidence")
    )
    return (
        named.join(F.broadcast(prefix_table(spark)), "threat_type", "inner")
        .join(first, "name", "inner")
        .select(
            "ordinal",
            "name",
            "prefix",
            F.regexp_replace("pattern", r"^\(\?i\)", "").alias("pattern"),
            "first_confidence",
        )
    )


def ranked_remote(remote: DataFrame) -> DataFrame:
    """``usable_remote`` with its 1-based place in the synced catalogue.

    The single-partition window runs over a configuration table, at most MAX_DETECTORS rows.
    """
    order = Window.orderBy(F.desc("first_confidence"), "ordinal")
    return usable_remote(remote).withColumn("place", F.row_number().over(order).cast("long"))


def _compiles(spark: SparkSession, pattern: str | None) -> bool:
    """Whether the engine that runs the detectors takes a pattern; null is none."""
    if pattern is None:
        return False
    try:
        spark.sparkContext._jvm.java.util.regex.Pattern.compile(java_pattern(pattern, True))
    except (Py4JJavaError, IllegalArgumentException):
        return False
    return True


def sync_catalogue(
    remote: DataFrame | None, fallback: list[Detector] | None = None, keep_builtin: bool = False
) -> list[Detector]:
    """Catalogue of a remote list; the fallback when the list is missing or nothing in it works.

    A successful sync replaces the catalogue, so built-in detectors without a remote type go
    away; ``keep_builtin=True`` appends those whose prefix the remote list does not have.
    """
    fallback = builtin_catalogue() if fallback is None else fallback
    if remote is None:
        return fallback
    rows = bounded_rows(ranked_remote(remote), MAX_DETECTORS, "remote catalogue")
    rows.sort(key=lambda r: r["place"])
    synced = [
        Detector(r["name"], r["prefix"], java_pattern(r["pattern"], True), i)
        for i, r in enumerate(r for r in rows if _compiles(remote.sparkSession, r["pattern"]))
    ]
    if not synced:
        return fallback
    if keep_builtin:
        have = {d.prefix for d in synced}
        for d in fallback:
            if d.prefix not in have:
                synced.append(d._replace(priority=len(synced)))
    return synced


def custom_catalogue(patterns: list[tuple[str, str, str, bool]]) -> list[Detector]:
    """Catalogue of (name, prefix, pattern, ignore_case) tuples, in priority order."""
    return [
        Detector(name, prefix, java_pattern(pattern, nocase), i)
        for i, (name, prefix, pattern, nocase) in enumerate(patterns)
    ]
