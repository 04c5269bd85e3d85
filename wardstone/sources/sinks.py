"""Audit lines and bypass reports: what is written, and writing it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstone.operators.validate import bypass_text


def log_entry(df: DataFrame, tool: str, customer: Column, *carry: str) -> DataFrame:
    """Internal log entry of each result; arrays follow the order of its findings."""
    found = F.col("findings")
    first = F.get(found, F.lit(0))
    full = tool in ("scan_prompt", "scan_response")
    patterns = F.filter(F.transform(found, lambda f: f["pattern"]), lambda p: p.isNotNull() & (p != ""))
    layers = F.transform(found, lambda f: f["detected_by"]) if full else F.array(F.lit("backend"))
    policies = F.transform(found, lambda f: f["policy_id"]) if full else F.array().cast("array<string>")
    return df.select(
        *carry,
        F.lit("info").alias("level"),
        F.lit("scan_detail").alias("type"),
        F.col("request_id"),
        F.col("ts").alias("timestamp"),
        customer.alias("customer_id"),
        F.lit(tool).alias("tool_name"),
        (~F.coalesce(F.col("safe"), F.lit(False)) | (F.col("action") != "allow")).alias("blocked"),
        first["type"].alias("threat_type"),
        F.col("confidence").alias("raw_confidence"),
        layers.alias("detection_layers"),
        policies.alias("policy_ids"),
        patterns.alias("matched_patterns"),
    )


def audit_lines(df: DataFrame, tool: str, customer: Column) -> DataFrame:
    """One JSON line per result, with the columns to partition by."""
    entry = log_entry(df, tool, customer)
    return entry.select(
        F.to_json(F.struct("*")).alias("line"),
        F.to_date("timestamp").alias("day"),
        F.col("tool_name").alias("tool"),
    )


def write_audit(lines: DataFrame, path: str) -> None:
    """Append audit lines by day and tool."""
    lines.write.mode("append").partitionBy("day", "tool").text(path)


def stream_audit(lines: DataFrame, path: str, checkpoint: str):
    """Append audit lines as they arrive."""
    return (
        lines.writeStream.outputMode("append").format("text").partitionBy("day", "tool")
        .option("path", path).option("checkpointLocation", checkpoint).start()
    )


def ingest_bypass_reports(reports: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted reports, rejected reports); accepted ones are appended to ``path`` if given."""
    built = bypass_text(reports)
    accepted = built.filter("error IS NULL").drop("error")
    if path is not None:
        accepted.write.mode("append").parquet(path)
    return accepted, built.filter("error IS NOT NULL")
