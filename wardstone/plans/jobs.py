"""The jobs: from a table of requests to a table of verdicts.

Every job is a chain of row expressions: findings stay with their row, fixed tables are
broadcast, and nothing is shuffled. Input columns pass through before the verdict only where
named. ``ts`` (when the request came in) is optional.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstone.functions import mapping
from wardstone.functions.text import java_pattern, missing
from wardstone.operators import approvals, cascade, domains, files, findings, intel, redact, screen, sessions, turns, validate, verdict
from wardstone.operators.findings import only
from wardstone.sources import fixed_values as fixed
from wardstone.sources import rules as packs
from wardstone.sources.catalogue import Detector
from wardstone.sources.requests import conform
from wardstone.sources.rules import Rule
from wardstone.sources.sinks import ingest_bypass_reports

Catalogue = list[Detector] | None


def _start(req: DataFrame) -> DataFrame:
    ts = F.col("ts").cast("timestamp") if "ts" in req.columns else F.lit(None).cast("timestamp")
    req = req.withColumn("ts", ts)
    return req.withColumn("request_id", mapping.request_id(F.coalesce("ts", F.timestamp_seconds(F.lit(0))), F.col("row_id")))


def _guarded(size_error: Column, *columns: str) -> dict[str, Column]:
    """Columns emptied where the request is too big, so that nothing scans it."""
    return {f"__{c}": F.when(size_error.isNull(), F.col(c)) for c in columns}


RESULT = [
    "request_id", "ts", "tool", "safe", "action", "confidence", "primary_type", "primary_policy", "severity",
    "approval", "session_risk_score", "correlation_patterns",
]


def _depth(req: DataFrame) -> Column | None:
    """The deepest layer of each request, where requests name their tier."""
    return cascade.tier_depth(F.col("tier")) if "tier" in req.columns else None


def _finish(df: DataFrame, internal: bool, *carry: str) -> DataFrame:
    """The verdict, or the internal result it would be built from."""
    return df.select("row_id", *RESULT) if internal else verdict.build_verdict(df, "row_id", *carry)


def _scan_result(df: DataFrame, tool: str, found: str) -> DataFrame:
    """Internal result of a prompt or response from all its findings."""
    f = F.col(found)
    df = verdict.internal_result(
        df, tool, safe=F.size(f) == 0, action=findings.recommended_action(f), confidence=findings.max_confidence(f),
        **verdict.result_columns(f),
    )
    return verdict.response_policy(df) if tool == "scan_response" else df


def _special_result(df: DataFrame, tool: str, found: str, message: str, confidence=None) -> DataFrame:
    """Internal result of a specialised scan, whose answer is its worst finding."""
    df = screen.answer_of(df, found)
    issue = findings.specialized_finding(
        F.col("safe"), F.col("threat_type"), F.col("severity"), F.col("reason"), message
    )
    df = df.withColumn("findings", only(issue))
    columns = verdict.specialized_result(F.col("safe"), F.col("severity"))
    if confidence is not None:
        columns["confidence"] = confidence(F.col("confidence"))
    df = df.withColumns(columns).withColumns(verdict.result_columns(F.col("findings")))
    return verdict.internal_result(df, tool)


def scan_prompts(
    req: DataFrame, catalogue: Catalogue = None, rules: list[Rule] | None = None, internal: bool = False
) -> DataFrame:
    """Verdict per prompt, with the redacted content, its tokens and a summary where asked for.

    Content and context go through the layers of ``cascade``; ``decided_by`` names the one that decided. A column
    ``tier`` cuts the layers off that the tier does not have.
    """
    rules = packs.PROMPT if rules is None else rules
    df = _start(req)
    too_big = validate.size_error(validate.text_size(F.col("content"), F.col("context")))
    df = df.withColumn("__size", too_big).withColumns(_guarded(F.col("__size"), "content", "context"))
    df = redact.redact_request(df, "__content", "__context", catalogue, F.col("redact_pii"))
    size = F.when(F.col("__size").isNotNull(), verdict.size_finding(F.col("__size")))
    df = cascade.screened(df, [("masked_content", "content"), ("masked_context", "context")], rules, "__found", depth=_depth(req), before=only(size))
    df = df.withColumn("redacted_content", F.when(F.col("pii_detected"), F.col("redacted_content")))
    df = df.withColumn("redaction_summary", redact.summary_map(F.col("redactions")))
    return _finish(
        _scan_result(df, "scan_prompt", "__found"), internal, "pii_detected", "redacted_content", "redaction_count",
        "redactions", "redaction_summary", "decided_by",
    )


def scan_responses(
    req: DataFrame, catalogue: Catalogue = None, rules: list[Rule] | None = None,
    least_overlap: float = 0.02, tone_limit: float = 0.02, leak_limit: float = 0.3, internal: bool = False,
) -> DataFrame:
    """Verdict per response; those that pass are rehydrated from their tokens.

    Checks the response with rules, for personal data the prompt did not have, for a change of
    topic or tone (both only flagged), and for parts of ``system_prompt`` where that is given. The rules also go through
    the layers of ``cascade``; a ``tier`` without response layers gets none of the other checks.
    """
    rules = [*packs.LEAK, *packs.TOXIC, *packs.SECRETS] if rules is None else rules
    df = _start(req)
    too_big = validate.size_error(validate.text_size(F.col("response"), F.col("original_prompt")))
    df = df.withColumn("__size", too_big).withColumns(_guarded(F.col("__size"), "response", "original_prompt"))
    tokens = F.coalesce("pii_tokens", F.array().cast("array<struct<token:string,original:string,type:string>>"))
    df = df.withColumn("__tokens", tokens)
    masked = redact.mask_tokens_and_originals
    df = df.withColumn("__r", masked(F.col("__response"), F.col("__tokens")))
    df = df.withColumn("__p", masked(F.coalesce("__original_prompt", F.lit("")), F.col("__tokens")))
    size = F.when(F.col("__size").isNotNull(), verdict.size_finding(F.col("__size")))
    df = cascade.screened(df, [("__r", "response")], rules, "__f1", depth=_depth(req), before=only(size))
    if "tier" in req.columns:  # the checks below read nothing where the tier lacks them
        on = cascade.tier_depth(F.col("tier")) >= cascade.RESPONSE_DEPTH
        df = df.withColumns({c: F.when(on, F.col(c)) for c in ("__r", "__p", *(["system_prompt"] if "system_prompt" in req.columns else []))})
    df = redact.find_spans(df, "__r", "__rs", catalogue)
    df = redact.find_spans(df, "__p", "__ps", catalogue)
    df = df.withColumn("__leaked", screen.leaked_originals(F.col("__ps"), F.col("__rs")))
    df = df.withColumn("__overlap", screen.topic_overlap(screen.word_set(F.col("__r")), screen.word_set(F.col("__p"))))
    tones = {
        "tonality_drift_profanity": packs.PROFANE, "tonality_drift_casual": packs.CASUAL,
        "tonality_drift_hostile": packs.HOSTILE,
    }
    drift = [
        F.when(
            screen.tone_ratio(F.col("__r"), words) > screen.tone_ratio(F.col("__p"), words) + tone_limit,
            findings.finding(kind, "medium", 0.7, "flag", "L8", "Tone differs from the prompt", kind, "Response tone"),
        )
        for kind, words in tones.items()
    ]
    leaked = F.when(
        F.size("__leaked") > 0,
        findings.finding("unexpected_pii_leakage", "high", 0.9, "block", "L8", "Personal data not in the prompt", "pii-diff", "Response data"),
    )
    off_topic = F.when(
        ~missing(F.col("__p")) & (F.col("__overlap") < least_overlap),
        findings.finding("topic_mismatch", "low", 0.6, "flag", "L8", "Topic differs from the prompt", "topic", "Response topic"),
    )
    prompt_leak = F.lit(None).cast(findings.FINDING)
    if "system_prompt" in req.columns:
        held = screen.containment(screen.shingles(F.col("system_prompt")), screen.shingles(F.col("__r")))
        prompt_leak = F.when(
            F.coalesce(held, F.lit(0.0)) >= leak_limit,
            findings.finding("system_prompt_leak", "critical", 0.9, "block", "L8", "Repeats the system prompt", "prompt-leak", "Response leak"),
        )
    df = df.withColumn("__found", F.concat(F.col("__f1"), only(leaked, off_topic, *drift, prompt_leak)))
    out = _finish(_scan_result(df, "scan_response", "__found"), internal, "response", "__tokens", "decided_by")
    if internal:
        return out
    restored = redact.rehydrate(F.col("response"), F.col("__tokens"))
    passes = ~F.col("blocked") & (F.size("__tokens") > 0)
    return out.withColumn("rehydrated_response", F.when(passes, restored)).drop("response", "__tokens")


def scan_sql(req: DataFrame, rules: list[Rule] | None = None, internal: bool = False) -> DataFrame:
    """Verdict per SQL text; destructive statements pass where they are allowed."""
    rules = packs.SQL if rules is None else rules
    off = {r.rule_id: "allow_destructive" for r in packs.SQL_DESTRUCTIVE}
    df = screen.apply_rules(_start(req), "query", rules, "__found", off=off)
    df = df.withColumns(
        {"statement_kind": mapping.statement_kind("query"), "query_length": validate.text_size(F.col("query"))}
    )
    df = _special_result(df, "scan_sql_query", "__found", "SQL security issue detected")
    return _finish(df, internal, "statement_kind", "query_length")


def pipe_chain(command: Column, piped_from: Column) -> Column:
    """Whether a stage that reads secrets comes before a stage that sends data away."""
    stages = F.split(F.concat_ws("|", F.when(~missing(piped_from), piped_from), command), r"\|")
    source, sink = java_pattern(packs.PIPE_SOURCE, True), java_pattern(packs.PIPE_SINK, True)
    reads = F.transform(stages, lambda s, i: F.when(s.rlike(source), i))
    sends = F.transform(stages, lambda s, i: F.when(s.rlike(sink), i))
    return F.coalesce(F.array_min(reads) < F.array_max(sends), F.lit(False))


def scan_commands(req: DataFrame, rules: list[Rule] | None = None, internal: bool = False) -> DataFrame:
    """Verdict per shell command, pipe chains included."""
    rules = packs.COMMAND if rules is None else rules
    df = screen.apply_rules(_start(req), "command", rules, "__rules")
    chain = F.when(pipe_chain(F.col("command"), F.col("piped_from")), screen.rule_finding(packs.PIPE_RULE))
    df = df.withColumn("__found", F.concat(F.col("__rules"), only(chain)))
    df = df.withColumn("command_length", validate.text_size(F.col("command")))
    df = _special_result(df, "scan_command", "__found", "Command security issue detected")
    return _finish(df, internal, "command_length")


def scan_file_writes(
    req: DataFrame, catalogue: Catalogue = None, path_rules: list[Rule] | None = None,
    content_rules: list[Rule] | None = None, internal: bool = False,
) -> DataFrame:
    """Verdict per file write from its path and its content."""
    path_rules = packs.PATH if path_rules is None else path_rules
    content_rules = packs.FILE_CONTENT if content_rules is None else content_rules
    df = _start(req)
    size = validate.text_size(F.col("content"))
    df = df.withColumn("__size", validate.size_error(size, fixed.MAX_FILE_CHARS, "File content"))
    df = df.withColumns(_guarded(F.col("__size"), "path", "content"))
    df = screen.apply_rules(df, "__path", path_rules, "__pf", "path")
    df = screen.apply_rules(df, "__content", content_rules, "__cf", "content")
    df = redact.find_spans(df, "__content", "__spans", catalogue)
    df = df.withColumn("__cf", F.concat(F.col("__cf"), screen.pii_findings(F.col("__spans"), location="content")))
    df = screen.answer_of(screen.answer_of(df, "__pf", "path_"), "__cf", "content_")
    df = files.combine_parts(df)
    too_big = F.col("__size").isNotNull()
    limit = F.array(verdict.size_finding(F.col("__size"), "size_limit", "content"))
    df = df.withColumns(
        {
            "findings": F.when(too_big, limit).otherwise(F.col("findings")),
            "safe": F.col("safe") & ~too_big,
            "action": F.when(too_big, "block").otherwise(F.col("action")),
            "file_extension": mapping.file_extension("path"),
            "path_length": validate.text_size(F.col("path")),
            "content_length": size,
        }
    )
    df = df.withColumns(verdict.result_columns(F.col("findings")))
    df = verdict.internal_result(df, "scan_file_write")
    return _finish(df, internal, "file_extension", "path_length", "content_length")


def scan_searches(
    req: DataFrame, catalogue: Catalogue = None, rules: list[Rule] | None = None, internal: bool = False
) -> DataFrame:
    """Verdict per web search from its query and its target domains."""
    rules = packs.SEARCH if rules is None else rules
    df = screen.apply_rules(_start(req), "query", rules, "__q")
    df = redact.find_spans(df, "query", "__spans", catalogue)
    df = df.withColumn("__q", F.concat(F.col("__q"), screen.pii_findings(F.col("__spans"))))
    df = screen.answer_of(df, "__q")
    issue = findings.specialized_finding(
        F.col("safe"), F.col("threat_type"), F.col("severity"), F.col("reason"), "Security issue detected in search query"
    )
    df = df.withColumn("findings", F.concat(only(issue), domains.domain_findings(F.col("target_domains"))))
    df = domains.escalate(df).withColumns(
        {
            "query_length": validate.text_size(F.col("query")),
            "domains_checked": F.coalesce(F.size("target_domains"), F.lit(0)),
            **verdict.result_columns(F.col("findings")),
        }
    )
    return _finish(verdict.internal_result(df, "scan_web_search"), internal, "query_length", "domains_checked")


def scan_messages(
    req: DataFrame, catalogue: Catalogue = None, rules: list[Rule] | None = None, internal: bool = False
) -> DataFrame:
    """Verdict per message between agents, by the layers of ``cascade`` and for personal data."""
    rules = packs.MESSAGE if rules is None else rules
    df = cascade.screened(_start(req), [("message", "message")], rules, "__rules", depth=_depth(req))
    df = redact.find_spans(df, "message", "__spans", catalogue)
    df = df.withColumn("__found", F.concat(F.col("__rules"), screen.pii_findings(F.col("__spans"))))
    df = df.withColumn("message_length", validate.text_size(F.col("message")))
    df = _special_result(
        df, "scan_a2a_message", "__found", "A2A message security issue detected", mapping.confidence_or_half
    )
    return _finish(df, internal, "message_length", "decided_by")


CARD = (
    "struct<name:string,description:string,url:string,provider:struct<organization:string,url:string>,"
    "skills:array<struct<id:string,name:string,description:string>>,broken:string>"
)


def scan_agent_cards(
    req: DataFrame, rules: list[Rule] | None = None, url_rules: list[Rule] | None = None, internal: bool = False
) -> DataFrame:
    """Verdict per agent card; a card that is not JSON fails closed."""
    rules = packs.CARD_TEXT if rules is None else rules
    url_rules = packs.CARD_URL if url_rules is None else url_rules
    df = _start(req)
    card = F.from_json("agent_card", CARD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"})
    df = df.withColumn("__card", card)
    c = F.col("__card")
    skills = F.array_join(
        F.transform(c["skills"], lambda s: F.concat_ws("\n", s["name"], s["description"])), "\n"
    )
    df = df.withColumns(
        {
            "__text": F.concat_ws("\n", c["name"], c["description"], c["provider"]["organization"], skills),
            "__url": c["url"],
            "__hosts": F.array_compact(F.array(F.nullif(F.regexp_extract(c["url"], "(?i)^[a-z]+://([^/:?#]+)", 1), F.lit("")))),
        }
    )
    df = screen.apply_rules(df, "__text", rules, "__f1")
    df = screen.apply_rules(df, "__url", url_rules, "__f2", "url")
    broken = F.when(c.isNull() | c["broken"].isNotNull(), verdict.fail_closed_finding(F.lit("Scan error")))
    host = domains.domain_findings(F.col("__hosts"))
    df = df.withColumn("__found", F.concat(only(broken), F.col("__f1"), F.col("__f2"), host))
    df = df.withColumn("card_length", validate.text_size(F.col("agent_card")))
    df = _special_result(
        df, "scan_agent_card", "__found", "Agent card security issue detected", mapping.confidence_or_half
    )
    return _finish(df, internal, "card_length")


def approval_status(requests: DataFrame, decisions: DataFrame, as_of: str) -> DataFrame:
    """Verdict of every request of the ledger at a time."""
    return approvals.status_verdicts(approvals.approval_states(requests, decisions, as_of))


def apply_decisions(requests: DataFrame, decisions: DataFrame) -> DataFrame:
    """Verdict of every submitted decision, refusals included."""
    df = approvals.decision_refusals(requests, decisions)
    return approvals.decision_outcomes(
        df.withColumn("error_code", F.col("refusal")).withColumn(
            "error_message", F.concat(F.lit("Decision refused: "), F.col("refusal"))
        )
    )


def threat_intel(found: DataFrame, type_col: str = "threat_type", category: str | None = None, include: str = "summary") -> DataFrame:
    return intel.threat_intel(intel.categorised(found, type_col), category, include)


def session_intel(built: DataFrame, flags: DataFrame, as_of_ms: int, high_risk: float, idle_seconds: int = fixed.SESSION_IDLE_SECONDS) -> DataFrame:
    """One row: the statistics of the active sessions (``sessions.sessions``), and a map of the hits of each turn pattern."""
    hits = sessions.pattern_hits(flags, *turns.PATTERNS).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("pattern", "hits")))).alias("pattern_hit_counts"))
    stats = sessions.session_statistics(built, as_of_ms, high_risk, idle_seconds)
    return stats.withColumn("one", F.lit(1)).join(hits.withColumn("one", F.lit(1)), "one").drop("one")  # a row each


def reset_sessions(requests: DataFrame, resets: DataFrame, key: str, ts: str, risk: str) -> DataFrame:
    """Sessions of the turns when every reset starts its owner afresh."""
    return sessions.sessions(requests, key, ts, risk, resets)


VERDICT_COLUMNS = ["row_id", "tool", "error", *verdict.EXTERNAL]
SCANS = {
    "scan_prompt": scan_prompts,
    "scan_response": scan_responses,
    "scan_sql_query": scan_sql,
    "scan_command": scan_commands,
    "scan_file_write": scan_file_writes,
    "scan_web_search": scan_searches,
    "scan_a2a_message": scan_messages,
    "scan_agent_card": scan_agent_cards,
}


def scan(req: DataFrame, enabled: list[str] | None = None) -> DataFrame:
    """Verdicts of mixed requests: row_id, scan_type, and the input columns of the scans used.

    Incomplete requests, unknown types and tools that are not enabled are blocked with an error.
    Requests for tools that are not scans (approvals, reports, intelligence, resets) are checked
    here and answered by their own jobs; they come back with a null ``blocked``.
    """
    given = req.columns
    df = validate.route(req, "scan_type")
    wanted = F.lit(None).cast("array<string>")
    if "enabled_tools" in given:
        wanted = F.col("enabled_tools")
    on = F.array_contains(validate.enabled_tools(wanted, enabled), F.col("tool"))
    not_on = F.concat(F.lit("Tool '"), F.col("tool"), F.lit("' is not enabled"))
    df = df.withColumn("error", F.coalesce("error", F.when(~on, not_on)))

    def field(tool: str) -> dict[str, Column]:
        names = validate.BYPASS_FIELDS if tool == "report_bypass" else validate.REQUIRED[tool]
        return {n: F.col(n) if n in given else F.lit(None).cast("string") for n in names}

    incomplete = F.lit(None).cast("string")
    for tool in fixed.TOOLS:
        incomplete = F.when(F.col("tool") == tool, validate.required_error(tool, field(tool))).otherwise(incomplete)
    # Behind a generator, so that the filters below test two columns and not all of the above.
    error = F.coalesce("error", incomplete)
    df = redact.computed(df, given, F.col("tool"), error.alias("error"))

    # One verdict step for the internal results of all scans.
    results = None
    for tool, job in SCANS.items():
        mine = df.filter(F.col("error").isNull() & (F.col("tool") == tool))
        mine = conform(mine, tool, *(c for c in ("ts", "tier") if c in given))
        part = job(mine, internal=True)
        results = part if results is None else results.unionByName(part)
    verdicts = verdict.build_verdict(results, "row_id", "tool").withColumn("error", F.lit(None).cast("string"))

    not_scanned = df.filter(F.col("error").isNotNull() | ~F.col("tool").isin(list(SCANS)))
    is_error = F.col("error").isNotNull()
    others = not_scanned.select(
        "row_id", "tool", "error", F.when(is_error, True).alias("blocked"), F.when(is_error, "block").alias("action")
    )
    return verdicts.select(*VERDICT_COLUMNS).unionByName(others, allowMissingColumns=True)


__all__ = [
    "apply_decisions", "approval_status", "ingest_bypass_reports", "reset_sessions", "scan",
    "scan_agent_cards", "scan_commands", "scan_file_writes", "scan_messages", "scan_prompts", "scan_responses",
    "scan_searches", "scan_sql", "session_intel", "threat_intel",
]
