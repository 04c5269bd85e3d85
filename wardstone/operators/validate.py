"""Checks before any scanning: required fields, sizes, routing, enabled tools, bypass texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstone.functions.text import kilobytes, missing, truthy
from wardstone.sources import fixed_values as fixed
from wardstone.sources.tables import fixed_table, lookup

REQUIRED = {
    "scan_prompt": ["content"],
    "scan_response": ["response"],
    "scan_sql_query": ["query"],
    "scan_command": ["command"],
    "scan_file_write": ["path", "content"],
    "scan_web_search": ["query"],
    "check_approval": ["approval_id"],
    "scan_a2a_message": ["message"],
    "scan_agent_card": ["agent_card"],
    "get_threat_intel": [],
    "reset_session": [],
}
BYPASS_FIELDS = ["prompt", "file_path", "file_content", "sql_query", "search_query"]


def required_error(tool: str, field: dict[str, Column] | None = None) -> Column:
    """Message of the first missing required field, null when the request is complete."""

    def col(name: str) -> Column:
        return field[name] if field else F.col(name)

    if tool == "report_bypass":
        none_given = F.lit(True)
        for name in BYPASS_FIELDS:
            none_given = none_given & missing(col(name))
        return F.when(
            none_given,
            "At least one of prompt, filePath, fileContent, sqlQuery, or searchQuery is required",
        )
    error = F.lit(None).cast("string")
    for name in reversed(REQUIRED[tool]):
        error = F.when(missing(col(name)), f"{name} is required").otherwise(error)
    return error


def split_required(df: DataFrame, tool: str) -> tuple[DataFrame, DataFrame]:
    """(complete requests, quarantined requests with their message)."""
    checked = df.withColumn("error", required_error(tool))
    return checked.filter("error IS NULL").drop("error"), checked.filter("error IS NOT NULL")


def text_size(first: Column, second: Column | None = None) -> Column:
    size = F.coalesce(F.length(first), F.lit(0))
    return size if second is None else size + F.coalesce(F.length(second), F.lit(0))


def size_error(size: Column, limit: int = fixed.MAX_TEXT_CHARS, what: str = "Content") -> Column:
    """Message where the size is over the limit (a size equal to it passes), else null."""
    text = F.concat(
        F.lit(f"{what} too large ("), kilobytes(size).cast("string"), F.lit(f"KB > {limit // 1024}KB limit)")
    )
    return F.when(size > limit, text)


def route(df: DataFrame, type_col: str) -> DataFrame:
    """Adds tool, and error where the type is missing or unknown."""
    types = fixed_table(df.sparkSession, [type_col, "tool"], fixed.TYPE_TO_TOOL)
    valid = ", ".join(t for t, _ in fixed.TYPE_TO_TOOL)
    unknown = F.concat(F.lit("Unknown scan type: "), F.col(type_col), F.lit(f". Valid types: {valid}"))
    return lookup(df, types, type_col).withColumn(
        "error",
        F.when(missing(F.col(type_col)), "type and input are required").when(F.col("tool").isNull(), unknown),
    )


def enabled_tools(request_tools: Column, job_tools: list[str] | None = None) -> Column:
    """Tools on for a request: its own list, else the job's, else all; unknown names dropped."""
    known = [F.lit(t) for t in fixed.TOOLS]
    rest = F.array(*known)
    if job_tools is not None:
        rest = F.array(*[F.lit(t) for t in job_tools if t in fixed.TOOLS]).cast("array<string>")
    own = F.filter(request_tools, lambda t: t.isin(*fixed.TOOLS))
    return F.when(F.coalesce(F.size(request_tools), F.lit(0)) > 0, own).otherwise(rest)


def bypass_text(df: DataFrame) -> DataFrame:
    """Adds bypass_text, category, mutation_type, source, confidence; error where nothing is given."""
    prompt, path, body, sql, search = (truthy(F.col(c)) for c in BYPASS_FIELDS)
    parts = F.concat_ws(
        "\n", F.concat(F.lit("FILE_PATH: "), path), F.concat(F.lit("FILE_CONTENT:\n"), body)
    )
    file_given = path.isNotNull() | body.isNotNull()
    text = F.coalesce(
        prompt,
        F.when(file_given, parts),
        F.concat(F.lit("SQL_QUERY: "), sql),
        F.concat(F.lit("SEARCH_QUERY: "), search),
    )
    category = F.coalesce(
        truthy(F.col("category")),
        F.when(file_given, "secrets_exposure")
        .when(sql.isNotNull(), "sql_injection")
        .when(search.isNotNull(), "pii_in_search")
        .otherwise("prompt_injection"),
    )
    return df.withColumns(
        {
            "bypass_text": text,
            "category": category,
            "mutation_type": F.coalesce(truthy(F.col("mutation_type")), F.lit("unknown")),
            "source": F.lit("mcp-agent"),
            "confidence": F.lit(0.9),
            "error": F.when(text.isNull(), fixed.BYPASS_REJECTED),
        }
    )
