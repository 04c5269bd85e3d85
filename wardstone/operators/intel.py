"""Threat intelligence: what detectors saw, per category and pattern."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstone.functions.text import truthy
from wardstone.operators.quota import millis
from wardstone.operators.verdict import normalise_threat


def categorised(findings: DataFrame, type_col: str) -> DataFrame:
    """Findings with the reported type as category, reduced to the columns used here."""
    named = normalise_threat(findings.withColumnRenamed(type_col, "__raw"), "__raw", "category")
    return named.select("category", truthy(F.col("pattern")).alias("pattern"), "confidence", "ts")


def _per_pattern(found: DataFrame) -> DataFrame:
    """Counts per (category, pattern): everything else is computed from these few rows."""
    return found.groupBy("category", "pattern").agg(
        F.count(F.lit(1)).alias("hits"), F.sum("confidence").alias("sum_confidence"),
        F.count("confidence").alias("n_confidence"), F.max(millis(F.col("ts"))).alias("last_ms"),
    )


def coverage(found: DataFrame, category: str | None = None) -> DataFrame:
    """Per category: patterns, detections, mean confidence, time of the last detection."""
    if category is not None:
        found = found.filter(F.col("category") == category)
    return _per_pattern(found).groupBy("category").agg(
        F.count("pattern").alias("pattern_count"), F.sum("hits").alias("detections"),
        F.round(F.sum("sum_confidence") / F.sum("n_confidence"), 6).alias("avg_confidence"),
        F.max("last_ms").alias("last_updated_ms"),
    )


def pattern_hits(found: DataFrame, active_from: int, category: str | None = None) -> DataFrame:
    """Full view: each pattern with its hits; active from ``active_from`` hits on, else a candidate."""
    if category is not None:
        found = found.filter(F.col("category") == category)
    per = _per_pattern(found.filter("pattern IS NOT NULL"))
    return per.select(
        "category", "pattern", F.col("hits").alias("hit_count"),
        F.round(F.col("sum_confidence") / F.col("n_confidence"), 6).alias("avg_confidence"),
        (F.col("hits") >= active_from).alias("active"),
    )


def statistics(found: DataFrame, active_from: int) -> DataFrame:
    """One row: active and candidate patterns, detections, mean confidence, categories seen."""
    named = F.col("pattern").isNotNull()
    return _per_pattern(found).agg(
        F.count_if(named & (F.col("hits") >= active_from)).alias("active_patterns"),
        F.count_if(named & (F.col("hits") < active_from)).alias("candidate_patterns"),
        F.coalesce(F.sum("hits"), F.lit(0)).alias("total_detections"),
        F.round(F.sum("sum_confidence") / F.sum("n_confidence"), 6).alias("avg_confidence"),
        F.count_distinct("category").alias("n_categories"),
    )


def threat_intel(found: DataFrame, category: str | None = None, include: str = "summary", active_from: int = 20) -> DataFrame:
    """``summary`` gives the coverage per category, ``full`` each pattern."""
    if include == "full":
        return pattern_hits(found, active_from, category)
    return coverage(found, category)
