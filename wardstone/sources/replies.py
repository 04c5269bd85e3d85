"""Replies of a scanning service as JSON text: parsing, findings, and failing closed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstone.functions.text import truthy
from wardstone.operators.findings import (
    FINDINGS, finding_defaults, max_confidence, no_findings, recommended_action,
)
from wardstone.operators.verdict import (
    APPROVAL, CORRELATIONS, fail_closed_finding, internal_result, result_columns, timed_out,
)

REPLY = (
    "struct<safe:boolean,threat_level:string,violations:array<struct<policy_id:string,policy_name:string,"
    "action:string,severity:string,threat_type:string,confidence:double,ai_reasoning:string,matched_text:string,"
    "pattern:string,scan_stage:string,detected_by:string>>,performance_metrics:struct<total_scan_time_ms:long,"
    "policies_evaluated:long,llm_analysis_used:boolean,cache_hits:long>,llm_analysis:struct<analyzed:boolean,"
    "is_malicious:boolean,confidence:double,threat_type:string,reasoning:string,detected_by:string,"
    f"analysis_time_ms:long>,approval_info:{APPROVAL},session_risk_score:double,"
    f"correlation_patterns:{CORRELATIONS},broken:string>"
)
SPECIAL_REPLY = (
    "struct<safe:boolean,threat_type:string,severity:string,reason:string,confidence:double,content_type:string,"
    "scan_time_ms:long,command_analysis:struct<parsed_command:string,parsed_args:array<string>,"
    f"pipe_chain:array<string>,risk_factors:array<string>>,approval_info:{APPROVAL},broken:string>"
)


def parse_reply(text: Column, schema: str = REPLY) -> Column:
    """The reply as a struct; ``broken`` holds the text when it is not JSON."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"})


def reply_findings(reply: Column) -> Column:
    """Violations with their defaults, in the order they were reported."""

    def one(v: Column) -> Column:
        def get(name: str) -> Column:
            return v["ai_reasoning" if name == "reasoning" else name]

        fields = finding_defaults(get)
        return F.struct(
            *[c.alias(n) for n, c in fields.items()], F.lit(None).cast("string").alias("location")
        )

    return F.coalesce(F.transform(reply["violations"], one).cast(FINDINGS), no_findings())


def reply_results(df: DataFrame, reply_col: str, tool: str, error_col: str | None = None) -> DataFrame:
    """Internal results of prompt or response replies; no reply or a broken one fails closed."""
    df = df.withColumn("__reply", parse_reply(F.col(reply_col)))
    reply = F.col("__reply")
    error = truthy(F.col(error_col)) if error_col else F.lit(None)
    reason = F.when(
        F.col(reply_col).isNull(), F.coalesce(error, F.lit("Scan error"))
    ).when(reply["broken"].isNotNull() | (F.trim(F.col(reply_col)) == ""), "Scan error")
    df = df.withColumn("failure", reason)
    failed = F.col("failure").isNotNull()
    scan = "Response scan" if tool == "scan_response" else "Security scan"
    found = F.when(failed, F.array(fail_closed_finding(F.col("failure"), scan))).otherwise(reply_findings(reply))
    df = df.withColumn("findings", found)
    session = {}
    if tool == "scan_prompt":  # only prompt verdicts carry session facts
        session = {n: reply[n] for n in ("session_risk_score", "correlation_patterns")}
    return internal_result(
        df, tool,
        safe=~failed & F.coalesce(reply["safe"], F.lit(False)),
        action=recommended_action(F.col("findings")),
        confidence=max_confidence(F.col("findings")),
        threat_level=F.when(failed, "high").otherwise(F.coalesce(truthy(reply["threat_level"]), F.lit("none"))),
        timed_out=timed_out(F.col("failure")),
        approval=reply["approval_info"],
        **session,
        **result_columns(F.col("findings")),
    ).drop("__reply")


def attempts_left_open(attempts: DataFrame, completed: DataFrame, key: str) -> DataFrame:
    """Attempted scans with their completed reply, if any (left join on the request id)."""
    return attempts.join(completed, key, "left")
