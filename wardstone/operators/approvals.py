"""Approval ledger: state of each request, refused decisions, verdicts, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstone.functions.mapping import minutes_left
from wardstone.functions.text import truthy
from wardstone.operators.quota import millis
from wardstone.sources import fixed_values as fixed
from wardstone.sources.tables import cut, fixed_table, lookup


def refusal_code(
    known: Column, requester: Column, created_at: Column, severity: Column, decider: Column, decided_via: Column, decided_at: Column,
    expiry_seconds: int = fixed.APPROVAL_EXPIRY_SECONDS, cooldown_seconds: int = fixed.APPROVAL_COOLDOWN_SECONDS,
) -> Column:
    """The code a decision on a request is refused with, or null where it counts.

    High and critical requests need the dashboard; others accept nothing from an agent within the
    cooldown; the scanner's own route decides nothing; nobody decides on their own request; nothing is
    accepted after expiry. What is not known is refused: a decision of no known request, a severity
    other than low or medium counts as high, a channel that is not named as an agent's, and a decider
    or requester who is not named as the same person.
    """
    age = millis(decided_at) - millis(created_at)
    serious = ~F.coalesce(F.lower(severity).isin("low", "medium"), F.lit(False))
    by_dashboard = F.coalesce(decided_via == "dashboard", F.lit(False))
    return (
        F.when(~F.coalesce(known, F.lit(False)), "APPROVAL_NOT_FOUND")
        .when(decided_via == "scanner", "SCANNER_ROUTE_DENIED")
        .when(serious & ~by_dashboard, "DASHBOARD_REQUIRED")
        .when(~serious & ~by_dashboard & F.coalesce(age < cooldown_seconds * 1000, F.lit(True)), "COOLDOWN_ACTIVE")
        .when(F.coalesce(decider == requester, F.lit(True)), "SELF_APPROVAL_BLOCKED")
        .when(F.coalesce(age >= expiry_seconds * 1000, F.lit(True)), "EXPIRED")
    )


def decision_refusals(
    requests: DataFrame, decisions: DataFrame, expiry_seconds: int = fixed.APPROVAL_EXPIRY_SECONDS,
    cooldown_seconds: int = fixed.APPROVAL_COOLDOWN_SECONDS,
) -> DataFrame:
    """Each decision with the code it was refused with (``refusal_code``), or null where it counts."""
    c = F.col
    joined = decisions.join(
        requests.select("approval_id", "requester", "created_at", "severity", F.lit(True).alias("__known")), "approval_id", "left"
    )
    code = refusal_code(c("__known"), c("requester"), c("created_at"), c("severity"), c("decider"), c("decided_via"), c("decided_at"), expiry_seconds, cooldown_seconds)
    return joined.withColumn("refusal", code).drop("__known")


def approval_states(
    requests: DataFrame, decisions: DataFrame, as_of: str, expiry_seconds: int = fixed.APPROVAL_EXPIRY_SECONDS,
    cooldown_seconds: int = fixed.APPROVAL_COOLDOWN_SECONDS,
) -> DataFrame:
    """Status of each request at a time: cancelled, decided, expired or pending."""
    at = F.unix_millis(F.lit(as_of).cast("timestamp"))
    counted = decision_refusals(requests, decisions, expiry_seconds, cooldown_seconds).filter(
        F.col("refusal").isNull() & (millis(F.col("decided_at")) <= at)
    )
    # The first decision that counts settles a request: a plain aggregate, combined early.
    settled = counted.groupBy("approval_id").agg(
        F.min_by(F.struct("decision", "justification", "decided_at"), F.struct("decided_at", "decision")).alias("d")
    )
    left = F.ceil((millis(F.col("created_at")) + expiry_seconds * 1000 - at) / 1000).cast("long")
    status = (
        F.when(F.col("cancelled"), "cancelled")
        .when(F.col("d").isNotNull(), F.col("d.decision"))
        .when(left <= 0, "expired")
        .otherwise("pending")
    )
    return (
        requests.filter(millis(F.col("created_at")) <= at)
        .join(settled, "approval_id", "left")
        .select(
            "approval_id", status.alias("status"),
            F.when(status == "pending", left).otherwise(0).cast("long").alias("expires_in_seconds"),
            F.col("d.justification").alias("justification"),
        )
    )


def _verdict_columns(df: DataFrame, columns: dict[str, Column], *carry: str) -> DataFrame:
    empty = F.lit(None).cast("string")
    names = [
        "blocked", "action", "threat_type", "owasp_category", "severity", "confidence", "guidance",
        "agent_instruction", "user_message",
    ]
    return df.select(*carry, *[columns.get(n, empty).alias(n) for n in names])


def status_verdicts(states: DataFrame) -> DataFrame:
    """Verdict of a polled status; whatever is not a known final status is still pending."""
    texts = fixed_table(
        states.sparkSession,
        ["status", "t_blocked", "t_action", "t_severity", "t_guidance", "t_instruction", "t_message"],
        fixed.STATUS_TEXTS,
    )
    df = lookup(states, texts, "status")
    final = F.col("t_action").isNotNull()
    stop = F.col("t_blocked")
    reason = truthy(F.col("justification"))
    rejected = F.col("status") == "rejected"
    because = F.concat(F.lit(" Reason: "), reason)
    minutes = minutes_left(F.coalesce("expires_in_seconds", F.lit(0))).cast("string")
    guidance = F.when(rejected, F.concat("t_guidance", F.coalesce(because, F.lit("")))).otherwise(F.col("t_guidance"))
    message = F.when(
        rejected, F.concat("t_message", F.coalesce(because, F.lit(fixed.NO_REASON_HINT)))
    ).otherwise(F.col("t_message"))
    columns = {
        "blocked": F.coalesce(stop, F.lit(True)),
        "action": F.coalesce("t_action", F.lit("require_approval")),
        "threat_type": F.when(stop, "unknown"),
        "owasp_category": F.when(stop, "N/A"),
        "severity": F.col("t_severity"),
        "confidence": F.when(stop, "high"),
        "guidance": guidance,
        "agent_instruction": F.when(final, F.col("t_instruction")).otherwise(
            F.format_string(fixed.PENDING_INSTRUCTION, minutes)
        ),
        "user_message": F.when(final, message).otherwise(F.format_string(fixed.PENDING_MESSAGE, minutes)),
    }
    return _verdict_columns(df, columns, "approval_id", "status", "expires_in_seconds")


def decision_outcomes(df: DataFrame) -> DataFrame:
    """Verdict of submitted decisions: approval_id, decision, justification, error_code, error_message.

    A decision with neither code nor message went through.
    """
    refusals = fixed_table(
        df.sparkSession, ["error_code", "r_owasp", "r_severity", "r_guidance", "r_instruction", "r_message"],
        fixed.REFUSALS,
    )
    df = lookup(df, refusals, "error_code")
    known = F.col("r_owasp").isNotNull()
    failed = F.col("error_code").isNotNull() | F.col("error_message").isNotNull()
    server = F.coalesce(truthy(F.col("error_message")), F.lit("Forbidden"))
    rejected = F.col("decision") == "rejected"
    because = F.concat(F.lit(" Reason: "), truthy(F.col("justification")))
    guidance = (
        F.when(known, F.coalesce(F.col("r_guidance"), server))
        .when(failed, server)
        .when(rejected, F.concat(F.lit(fixed.DECIDED_REJECTED_GUIDANCE), F.coalesce(because, F.lit(""))))
    )
    instruction = (
        F.when(known, F.col("r_instruction"))
        .when(failed, F.format_string(fixed.APPROVAL_ERROR_INSTRUCTION, server))
        .when(rejected, fixed.DECIDED_REJECTED_INSTRUCTION)
        .otherwise(fixed.DECIDED_APPROVED_INSTRUCTION)
    )
    message = (
        F.when(known, F.replace("r_message", F.lit("%s"), server))
        .when(failed, F.format_string(fixed.APPROVAL_ERROR_MESSAGE, server))
        .when(
            rejected,
            F.concat(F.lit(fixed.DECIDED_REJECTED_MESSAGE), F.coalesce(because, F.lit(fixed.NO_REASON_HINT))),
        )
    )
    stop = failed | rejected
    columns = {
        "blocked": stop,
        "action": F.when(stop, "block").otherwise("allow"),
        "threat_type": F.when(failed, "scan_error").when(rejected, "unknown"),
        "owasp_category": F.when(known, F.col("r_owasp")).when(stop, "N/A"),
        "severity": F.when(known, F.col("r_severity")).when(stop, "medium"),
        "confidence": F.when(stop, "high"),
        "guidance": guidance,
        "agent_instruction": instruction,
        "user_message": message,
    }
    return _verdict_columns(df, columns, "approval_id", "decision")


def content_hash(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def _next_times(points: DataFrame, width: int, chunk: int) -> DataFrame:
    """Each time of a key with ``to``, the first time of the key ``width`` or more after it, if there is one.

    A time looks for its successor in one chunk of time; where that has none, the next chunk that holds a time gives its
    first. So a busy key is dealt out by chunks, and only one row per chunk meets in a window over the key.
    """
    probes = points.select("key", (F.col("ms") + width).alias("at"), F.col("ms").alias("of"), F.lit(None).cast("long").alias("time"))
    both = probes.unionByName(points.select("key", F.col("ms").alias("at"), F.lit(None).cast("long").alias("of"), F.col("ms").alias("time")))
    both = both.withColumn("chunk", F.floor(F.col("at") / chunk))
    rest = Window.partitionBy("key", "chunk").orderBy(F.col("at").desc()).rangeBetween(Window.unboundedPreceding, 0)
    within = both.withColumn("to", F.min("time").over(rest)).where("of IS NOT NULL").select("key", "chunk", F.col("of").alias("ms"), "to")
    later = Window.partitionBy("key").orderBy(F.col("chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    chunks = both.groupBy("key", "chunk").agg(F.min("time").alias("time"))
    after = chunks.select("key", "chunk", F.min("time").over(later).alias("after"))
    return within.join(after, ["key", "chunk"]).select("key", "ms", F.coalesce("to", "after").alias("to"))


def window_openings(points: DataFrame, width: int, chunk: int) -> DataFrame:
    """The times (key, ms) that open a window: the first, then always the first one ``width`` or more after the last.

    Pointer doubling: each time points to the one that would open the next window after it. Pointers that leap two, four,
    eight windows follow by joining the pointers with themselves, and the openings found so far leap with them, so the
    rounds are as many as the logarithm of the windows, and a busy key is dealt out by its times.
    """
    leaps = cut(_next_times(points, width, chunk).where("to IS NOT NULL"))
    found = cut(points.groupBy("key").agg(F.min("ms").alias("ms")))
    while True:
        more = cut(found.join(leaps, ["key", "ms"]).select("key", F.col("to").alias("ms")))
        if more.isEmpty():
            return found
        found = cut(found.unionAll(more))
        onward = leaps.select("key", F.col("ms").alias("to"), F.col("to").alias("far"))
        leaps = cut(leaps.join(onward, ["key", "to"]).select("key", "ms", F.col("far").alias("to")))


def distinct_requests(
    requests: DataFrame, hash_col: str, ts: str, seq: str, window_seconds: int = fixed.APPROVAL_EXPIRY_SECONDS,
    chunk_ms: int = 600_000,
) -> DataFrame:
    """Requests with ``duplicate``: whether they repeat one that still counts.

    The first request of a content opens a window; the same content within it is a repeat, the
    first one after it opens the next window. Repeats in one millisecond are reduced before
    anything is shuffled by content, and a popular content is dealt out by its times.
    """
    timed = requests.withColumn("ms", millis(F.col(ts)))
    points = timed.groupBy(hash_col, "ms").agg(F.min(seq).alias("first_seq"))
    opened = window_openings(points.select(F.col(hash_col).alias("key"), "ms"), window_seconds * 1000, chunk_ms)
    marks = opened.join(points.withColumnRenamed(hash_col, "key"), ["key", "ms"]).select(
        F.col("key").alias(hash_col), F.col("first_seq").alias(seq), F.lit(True).alias("__opens")
    )
    return timed.join(marks, [hash_col, seq], "left").select(
        *requests.columns, F.col("__opens").isNull().alias("duplicate")
    )
