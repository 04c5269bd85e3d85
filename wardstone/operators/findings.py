"""Findings: defaults, summaries, and the recommended action.

Two shapes carry the same finding. Inside a scan each request holds an array of them, so a whole
scan needs no shuffle. A stored findings table holds one row each; its summaries are plain
aggregates (counts, maxima, first by position), which combine before the shuffle and never
gather a request's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstone.functions.mapping import LEVELS, severity_of_rank, severity_rank
from wardstone.functions.text import truthy

FINDING = (
    "struct<type:string,severity:string,confidence:double,action:string,detected_by:string,"
    "message:string,policy_id:string,policy_name:string,pattern:string,location:string>"
)
FINDINGS = f"array<{FINDING}>"


def finding(
    type: Column | str, severity: Column | str, confidence: Column | float = 0.8, action: Column | str = "flag",
    detected_by: Column | str = "rules", message: Column | str = "", policy_id: Column | str = "",
    policy_name: Column | str = "", pattern: Column | str | None = None, location: Column | str | None = None,
) -> Column:
    """One finding as a struct of the standard type."""

    def col(v) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    return F.struct(
        col(type).cast("string").alias("type"),
        col(severity).cast("string").alias("severity"),
        col(confidence).cast("double").alias("confidence"),
        col(action).cast("string").alias("action"),
        col(detected_by).cast("string").alias("detected_by"),
        col(message).cast("string").alias("message"),
        col(policy_id).cast("string").alias("policy_id"),
        col(policy_name).cast("string").alias("policy_name"),
        col(pattern).cast("string").alias("pattern"),
        col(location).cast("string").alias("location"),
    )


def no_findings() -> Column:
    return F.array().cast(FINDINGS)


def only(*candidates: Column) -> Column:
    """Array of the candidates that are not null."""
    return F.array_compact(F.array(*candidates))


def finding_defaults(get) -> dict[str, Column]:
    """Defaults of one reported finding; ``get(name)`` gives its raw field.

    Empty counts as missing, except for the confidence, where zero is a value.
    """

    def either(name: str, default: str) -> Column:
        return F.coalesce(truthy(get(name)), F.lit(default))

    return {
        "type": either("threat_type", "unknown"),
        "severity": either("severity", "medium"),
        "confidence": F.coalesce(get("confidence"), F.lit(0.8)),
        "action": either("action", "flag"),
        "detected_by": either("detected_by", "unknown"),
        "message": F.coalesce(
            truthy(get("reasoning")), truthy(get("policy_name")), truthy(get("threat_type")),
            F.lit("Security violation detected"),
        ),
        "policy_id": either("policy_id", "unknown"),
        "policy_name": either("policy_name", "Unknown Policy"),
        "pattern": get("pattern"),
    }


def with_defaults(df: DataFrame) -> DataFrame:
    """Row form of ``finding_defaults`` over threat_type, severity, confidence, ... columns."""
    new = finding_defaults(F.col)
    keep = [c for c in df.columns if c not in {"threat_type", "reasoning", *new}]
    return df.select(*keep, *[c.alias(n) for n, c in new.items()])


def specialized_finding(safe: Column, threat: Column, severity: Column, reason: Column, default_message: str,
                        location: str | None = None, default_type: str | None = None) -> Column:
    """The single finding of a specialised check, or null.

    Without ``default_type`` an unsafe answer that names no threat gives none.
    """
    unsafe = ~F.coalesce(safe, F.lit(False))
    named = truthy(threat)
    if default_type is not None:
        named = F.coalesce(named, F.lit(default_type))
    one = finding(
        named, F.coalesce(truthy(severity), F.lit("high")), F.lit(None), F.lit(None), "backend",
        F.coalesce(truthy(reason), F.lit(default_message)), F.lit(None), F.lit(None), None, location,
    )
    return F.when(unsafe & named.isNotNull(), one)


# --- array form -----------------------------------------------------------------------


def count_where(findings: Column, test) -> Column:
    return F.size(F.filter(findings, test)).cast("long")


def max_confidence(findings: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(findings, lambda f: f["confidence"])), F.lit(0.0))


def recommended_action(findings: Column) -> Column:
    def has(field: str, *values: str) -> Column:
        return F.exists(findings, lambda f: f[field].isin(*values))

    return (
        F.when(has("action", "block") | has("severity", "critical"), "block")
        .when(has("action", "redact"), "redact")
        .when(has("action", "flag") | has("severity", "high", "medium"), "flag")
        .otherwise("allow")
    )


def highest_severity(findings: Column) -> Column:
    ranks = F.transform(findings, lambda f: severity_rank(f["severity"]))
    return severity_of_rank(F.array_max(ranks), "medium")


def any_severity(findings: Column, level: str) -> Column:
    return F.exists(findings, lambda f: f["severity"] == level)


# --- row form -------------------------------------------------------------------------


def summary_aggregates() -> list[Column]:
    """Counts per request; severities count case-sensitively, as they were reported."""
    counts = [F.count_if(F.col("severity") == level).alias(f"{level}_count") for level in LEVELS]
    return [
        F.count(F.lit(1)).alias("total"),
        *counts,
        F.count_if(F.col("action") == "block").alias("blocked_count"),
        F.count_if(F.col("action") == "flag").alias("flagged_count"),
        F.count_if(F.col("action") == "redact").alias("redact_count"),
        F.coalesce(F.max("confidence"), F.lit(0.0)).alias("confidence"),
        F.max(severity_rank("severity")).alias("severity_rank"),
    ]


def action_of_summary() -> Column:
    c = F.col
    return (
        F.when((c("blocked_count") > 0) | (c("critical_count") > 0), "block")
        .when(c("redact_count") > 0, "redact")
        .when((c("flagged_count") > 0) | (c("high_count") > 0) | (c("medium_count") > 0), "flag")
        .otherwise("allow")
    )


def summarise(findings: DataFrame, key: str = "request_id", pos: str = "pos") -> DataFrame:
    """One row per request: counts, confidence, action, severity and the first finding."""
    first = F.min_by(F.struct("type", "policy_name"), F.col(pos))
    out = findings.groupBy(key).agg(*summary_aggregates(), first.alias("first"))
    return out.select(
        key, "total", *[f"{level}_count" for level in LEVELS], "blocked_count", "flagged_count",
        "confidence", action_of_summary().alias("action"),
        severity_of_rank(F.col("severity_rank"), "medium").alias("severity"),
        F.col("first.type").alias("primary_type"), F.col("first.policy_name").alias("primary_policy"),
    )
