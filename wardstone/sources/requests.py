"""The typed inputs of each scan, for batch and streaming reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "scan_prompt": "row_id long, content string, context string, redact_pii boolean",
    "scan_response": "row_id long, response string, original_prompt string, "
    "pii_tokens array<struct<token:string,original:string,type:string>>",
    "scan_sql_query": "row_id long, query string, database string, allow_destructive boolean",
    "scan_command": "row_id long, command string, shell string, working_directory string, "
    "execution_context string, piped_from string",
    "scan_file_write": "row_id long, path string, content string, mode string",
    "scan_web_search": "row_id long, query string, target_domains array<string>",
    "scan_a2a_message": "row_id long, message string, sender_agent_id string, receiver_agent_id string, "
    "task_id string, role string",
    "scan_agent_card": "row_id long, agent_card string, verify_signature boolean",
    "check_approval": "row_id long, approval_id string, decision string, justification string",
    "report_bypass": "row_id long, prompt string, file_path string, file_content string, sql_query string, "
    "search_query string, mutation_type string, category string, notes string",
}


def read_requests(spark: SparkSession, tool: str, path: str, format: str = "json") -> DataFrame:
    return spark.read.schema(SCHEMAS[tool]).format(format).load(path)


def stream_requests(spark: SparkSession, tool: str, path: str, format: str = "json") -> DataFrame:
    return spark.readStream.schema(SCHEMAS[tool]).format(format).load(path)


def conform(df: DataFrame, tool: str, *carry: str) -> DataFrame:
    """The request columns of a tool, in order and typed, and ``carry``; absent ones become null."""
    from pyspark.sql.types import StructType

    fields, have = StructType.fromDDL(SCHEMAS[tool]), set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in fields
        ],
        *carry,
    )
