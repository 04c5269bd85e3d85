"""Scalar mappings of severities, confidences, statements, paths and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardstone.functions.text import SPACE, truthy
from wardstone.sources import fixed_values as fixed

LEVELS = ["critical", "high", "medium", "low"]


def _text(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def severity_rank(severity: str | Column) -> Column:
    """critical 4, high 3, medium 2, low 1, anything else 0; case does not matter."""
    s = F.lower(_text(severity))
    rank = F.lit(0)
    for i, level in enumerate(reversed(LEVELS)):
        rank = F.when(s == level, i + 1).otherwise(rank)
    return rank


def severity_of_rank(rank: Column, default: str) -> Column:
    out = F.lit(default)
    for i, level in enumerate(reversed(LEVELS)):
        out = F.when(rank == i + 1, level).otherwise(out)
    return out


def threat_level(severity: str | Column) -> Column:
    s = F.lower(_text(severity))
    return F.when(s.isin(LEVELS), s).otherwise("none")


def severity_action(severity: str | Column) -> Column:
    s = F.lower(_text(severity))
    return F.when(s.isin("critical", "high"), "block").when(s == "medium", "flag").otherwise("allow")


def confidence_bucket(score: str | Column) -> Column:
    c = _text(score)
    return F.when(c >= 0.9, "high").when(c >= 0.7, "medium").otherwise("low")


def confidence_or_half(score: str | Column) -> Column:
    """0.5 where the score is missing or zero."""
    c = F.coalesce(_text(score), F.lit(0.0))
    return F.when(c == 0, 0.5).otherwise(c)


def threat_key(name: str | Column) -> Column:
    """The form under which a threat name is looked up."""
    return F.replace(F.lower(_text(name)), F.lit("-"), F.lit("_"))


def statement_kind(query: str | Column) -> Column:
    """First of the known kinds that the trimmed statement starts with."""
    q = F.upper(F.regexp_replace(_text(query), f"^[{SPACE}]+", ""))
    out = F.lit("UNKNOWN")
    for kind in reversed(fixed.STATEMENT_KINDS):
        out = F.when(q.startswith(kind), kind).otherwise(out)
    return out


def file_extension(path: str | Column) -> Column:
    ext = F.regexp_extract(_text(path), r"\.([^./\\]+)$", 1)
    return F.lower(F.coalesce(truthy(ext), F.lit("none")))


def request_id(ts: Column, row_id: Column) -> Column:
    """``req_<milliseconds, base 36>_<8 characters>``, the same whenever a task is retried."""
    millis = F.lower(F.conv(F.unix_millis(ts.cast("timestamp")).cast("string"), 10, 36))
    digest = F.substring(F.sha2(row_id.cast("string"), 256), 1, 8)
    return F.concat(F.lit("req_"), millis, F.lit("_"), digest)


def context_map(optional: dict[str, Column], constants: dict[str, str]) -> Column:
    """Optional fields that are present, plus the constant identity fields."""
    pairs: list[Column] = []
    for key, value in optional.items():
        pairs += [F.lit(key), value.cast("string")]
    for key, const in constants.items():
        pairs += [F.lit(key), F.lit(const)]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull() & (v != ""))


def minutes_left(seconds: Column) -> Column:
    return F.ceil(seconds / 60).cast("long")
