"""One verdict for a file write from the answers about its path and its content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstone.functions.mapping import severity_action, severity_rank, threat_level
from wardstone.operators.findings import only, specialized_finding
from wardstone.operators.verdict import APPROVAL

PART_FIELDS = ["safe", "threat_type", "severity", "reason", "confidence"]


def join_parts(path_answers: DataFrame, content_answers: DataFrame, key: str) -> DataFrame:
    """Path and content answers of the same request side by side."""

    def prefixed(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(key, *[F.col(c).alias(f"{prefix}_{c}") for c in PART_FIELDS])

    return prefixed(path_answers, "path").join(prefixed(content_answers, "content"), key, "full_outer")


def combine_parts(df: DataFrame) -> DataFrame:
    """Adds findings, safe, threat_level, action, confidence and approval.

    Safe when both parts are. The severity is the path's unless the content's is strictly worse;
    the confidence is the lowest of the unsafe parts, 1 if none. Content findings come first.
    """
    c = F.col
    p_bad = ~F.coalesce(c("path_safe"), F.lit(False))
    c_bad = ~F.coalesce(c("content_safe"), F.lit(False))
    worse = severity_rank("content_severity") > severity_rank("path_severity")
    no_path_severity = ~p_bad | (F.coalesce(c("path_severity"), F.lit("")) == "")
    worst = F.when(c_bad & (no_path_severity | worse), c("content_severity")).when(p_bad, c("path_severity"))
    safe = ~p_bad & ~c_bad
    findings = only(
        specialized_finding(
            c("content_safe"), c("content_threat_type"), c("content_severity"), c("content_reason"),
            "File content security issue detected", "content", "content_violation",
        ),
        specialized_finding(
            c("path_safe"), c("path_threat_type"), c("path_severity"), c("path_reason"),
            "File path security issue detected", "path", "path_violation",
        ),
    )
    approvals = [c(n) for n in ("content_approval", "path_approval") if n in df.columns]
    return df.withColumns(
        {
            "findings": findings,
            "safe": safe,
            "threat_level": F.when(safe, "none").otherwise(threat_level(worst)),
            "action": F.when(safe, "allow").otherwise(severity_action(worst)),
            "confidence": F.least(
                F.lit(1.0),
                F.when(p_bad, c("path_confidence")),
                F.when(c_bad, c("content_confidence")),
            ),
            "approval": F.coalesce(*approvals, F.lit(None).cast(APPROVAL)),
        }
    )
