"""Verdicts: from an internal result to what a caller may see.

An internal result is a row with: request_id, ts, tool, safe, action, confidence, primary_type,
primary_policy, severity, approval, session_risk_score, correlation_patterns. Only the columns
of ``EXTERNAL`` leave ``build_verdict``: never who detected what, by which pattern or policy id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstone.functions.mapping import (
    confidence_bucket, minutes_left, severity_action, threat_key, threat_level,
)
from wardstone.functions.text import truthy
from wardstone.operators.findings import finding, highest_severity
from wardstone.sources import fixed_values as fixed
from wardstone.sources.tables import fixed_table, lookup

APPROVAL = (
    "struct<requires_approval:boolean,approval_id:string,approval_level:string,action_summary:string,"
    "policy_name:string,expires_in_seconds:long,threat_type:string,severity:string,owasp_category:string,"
    "risk_factors:array<string>,original_action:string>"
)
CORRELATIONS = (
    "array<struct<pattern_id:string,pattern_name:string,category:string,confidence:double,description:string>>"
)
EXTERNAL = [
    "request_id", "blocked", "action", "threat_type", "owasp_category", "severity", "confidence", "guidance",
    "agent_instruction", "user_message", "approval_id", "approval_context", "audit",
]
SCAN_TOOLS = ["scan_prompt", "scan_response"]


def alias_table(spark) -> DataFrame:
    return fixed_table(spark, ["__alias", "threat_type"], fixed.THREAT_ALIASES)


def type_table(spark) -> DataFrame:
    rows = [(t, o, [o] + refs, g, m) for t, o, refs, g, m in fixed.THREAT_TYPES]
    return fixed_table(
        spark, ["threat_type", "owasp_category", "framework_references", "guidance", "type_message"], rows
    )


def tool_table(spark) -> DataFrame:
    fallback = dict(fixed.FALLBACK_TYPES)
    rows = [(t, fallback[t], text) for t, text in fixed.AGENT_INSTRUCTIONS]
    return fixed_table(spark, ["tool", "fallback_type", "blocked_instruction"], rows)


def by_tool(tool: Column, pairs: list[tuple[str, str]]) -> Column:
    """The value of a tool. A plan with one tool folds it to a constant, where a join would not."""
    out = F.lit(None).cast("string")
    for name, value in pairs:
        out = F.when(tool == name, value).otherwise(out)
    return out


def normalise_threat(df: DataFrame, source: str, out: str = "threat_type") -> DataFrame:
    """Adds the reported type of an internal threat name; unknown names give ``unknown``."""
    aliases = alias_table(df.sparkSession).withColumnRenamed("threat_type", "__type")
    keyed = df.withColumn("__alias", threat_key(source))
    joined = lookup(keyed, aliases, "__alias")
    return joined.withColumn(out, F.coalesce("__type", F.lit("unknown"))).drop("__alias", "__type")


def with_threat_details(df: DataFrame) -> DataFrame:
    """Adds owasp_category, framework_references, guidance and type_message for threat_type."""
    return lookup(df, type_table(df.sparkSession), "threat_type")


def approval_context(a: Column) -> Column:
    """Approval facts for the caller; the threat is only named when a block is being overridden."""
    override = F.coalesce(a["original_action"] == "block", F.lit(False))

    def named(field: str) -> Column:
        return F.when(override, truthy(a[field])).alias(field)

    return F.struct(
        a["action_summary"].alias("action_summary"), a["policy_name"].alias("policy_name"),
        a["approval_level"].alias("approval_level"), a["expires_in_seconds"].alias("expires_in_seconds"),
        named("threat_type"), named("severity"), named("owasp_category"),
        F.when(override & (F.size(a["risk_factors"]) > 0), a["risk_factors"]).alias("risk_factors"),
        F.when(override, F.lit("block")).alias("original_action"),
    )


def hold_texts(a: Column) -> tuple[Column, Column]:
    """(agent instruction, user message) of a held request."""
    override = F.coalesce(a["original_action"] == "block", F.lit(False))
    threat = F.coalesce(truthy(a["threat_type"]), F.lit("threat detected"))
    minutes = minutes_left(a["expires_in_seconds"]).cast("string")
    instruction = F.when(override, F.format_string(fixed.HOLD_OVERRIDE, threat)).otherwise(fixed.HOLD_SAFE)
    message = F.when(
        override, F.format_string(fixed.HOLD_OVERRIDE_MESSAGE, threat, a["approval_id"], minutes)
    ).otherwise(F.format_string(fixed.HOLD_SAFE_MESSAGE, a["approval_id"], minutes))
    return instruction, message


def build_verdict(df: DataFrame, *carry: str) -> DataFrame:
    """External verdict of internal results, with the ``carry`` columns passed through.

    In order: held for approval; safe and allowed (prompt and response scans also let redacted
    content pass); everything else is blocked, flagged content included.
    """
    fallback = by_tool(F.col("tool"), fixed.FALLBACK_TYPES)
    named = F.coalesce(truthy(F.col("primary_type")), fallback, F.lit("unknown"))
    df = normalise_threat(df.withColumn("__named", named), "__named")
    df = with_threat_details(df)

    a = F.col("approval")
    held = F.coalesce(a["requires_approval"], F.lit(False))
    is_scan = F.col("tool").isin(SCAN_TOOLS)
    passing = (F.col("action") == "allow") | (is_scan & (F.col("action") == "redact"))
    allowed = ~held & F.coalesce(F.col("safe"), F.lit(False)) & F.coalesce(passing, F.lit(False))
    blocked = ~held & ~allowed
    hold_instruction, hold_message = hold_texts(a)
    policy = F.when(
        is_scan, F.coalesce(truthy(F.col("primary_policy")), F.lit("Security Policy"))
    ).otherwise("Security Policy")
    patterns = F.when(F.size("correlation_patterns") > 0, F.col("correlation_patterns"))
    audit = F.struct(
        F.col("request_id").alias("scan_id"),
        F.col("ts").alias("timestamp"),
        F.when(held, a["policy_name"]).when(blocked, policy).alias("policy_name"),
        F.when(blocked, F.col("framework_references")).alias("framework_references"),
        F.when(~held & is_scan, F.col("session_risk_score")).alias("session_risk_score"),
        F.when(~held & is_scan, patterns).alias("correlation_patterns"),
    )
    columns = {
        "request_id": F.col("request_id"),
        "blocked": ~allowed,
        "action": F.when(held, "require_approval").when(allowed, "allow").otherwise("block"),
        "threat_type": F.when(blocked, F.col("threat_type")),
        "owasp_category": F.when(blocked, F.col("owasp_category")),
        "severity": F.when(blocked, F.col("severity")),
        "confidence": F.when(blocked, confidence_bucket("confidence")),
        "guidance": F.when(blocked, F.col("guidance")),
        "agent_instruction": F.when(held, hold_instruction)
        .when(allowed, fixed.ALLOWED_INSTRUCTION)
        .otherwise(by_tool(F.col("tool"), fixed.AGENT_INSTRUCTIONS)),
        "user_message": F.when(held, hold_message).when(blocked, F.col("type_message")),
        "approval_id": F.when(held, a["approval_id"]),
        "approval_context": F.when(held, approval_context(a)),
        "audit": audit,
    }
    return df.select(*carry, *[columns[name].alias(name) for name in EXTERNAL])


def result_columns(findings: Column) -> dict[str, Column]:
    """Columns of an internal result that follow from the array of findings."""
    first = F.get(findings, F.lit(0))
    return {
        "primary_type": first["type"],
        "primary_policy": first["policy_name"],
        "severity": highest_severity(findings),
    }


def internal_result(df: DataFrame, tool: str, **columns: Column) -> DataFrame:
    """Fills the columns ``build_verdict`` reads that a scan did not set."""
    defaults = {
        "tool": F.lit(tool),
        "ts": F.lit(None).cast("timestamp"),
        "approval": F.lit(None).cast(APPROVAL),
        "session_risk_score": F.lit(None).cast("double"),
        "correlation_patterns": F.lit(None).cast(CORRELATIONS),
    }
    new = {**{k: v for k, v in defaults.items() if k not in df.columns}, **columns}
    return df.withColumns(new)


def fail_closed_finding(reason: Column, scan: str = "Security scan") -> Column:
    text = F.concat(F.lit(f"{scan} could not complete: "), reason, F.lit(". Blocking as precaution."))
    return finding(
        "scan_error", "high", 1.0, "block", "fail_closed_policy", text, "pol-fail-closed",
        "Fail-Closed Security Policy",
    )


def size_finding(message: Column, type: str = "size_limit_exceeded", location: str | None = None) -> Column:
    return finding(
        type, "high", 1.0, "block", "client_validation", message, "pol-size-limit", "Content Size Limit", None, location
    )


def timed_out(reason: Column) -> Column:
    return F.coalesce(reason.contains("timeout"), F.lit(False))


def response_policy(df: DataFrame) -> DataFrame:
    """For responses a flag is a note for reviewers: the response stays safe and passes."""
    flagged = F.col("action") == "flag"
    return df.withColumns(
        {
            "safe": F.when(flagged, True).otherwise(F.col("safe")),
            "action": F.when(flagged, "allow").otherwise(F.col("action")),
        }
    )


def specialized_result(safe: Column, severity: Column) -> dict[str, Column]:
    """Level and action of a specialised check from its own answer."""
    ok = F.coalesce(safe, F.lit(False))
    return {
        "safe": ok,
        "threat_level": threat_level(severity),
        "action": F.when(ok, "allow").otherwise(severity_action(severity)),
    }
