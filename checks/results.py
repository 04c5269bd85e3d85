"""Projections, findings, aggregates and verdicts (P*, A1-A7, A12, V*, J1, J5, J7, O3, O4, S1, S5-S9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import check, table, values
from checks.sqltext import (
    ALIASES, DIMS, FILLED, LADDER, NO_APPROVAL, SUMMARY, TYPES, action, bucket, level, of_rank, q, rank, verdict,
)
from checks.views import (
    BYPASSES, CARDS, COMMANDS, FINDINGS, MESSAGES, PATHS, REPLIES, SEARCHES, SMALL_FINDINGS, SPECIAL, SQL_TEXT,
    duck_view, spark_view,
)
from wardstone.functions import mapping
from wardstone.operators import domains, files, validate
from wardstone.operators import findings as fnd
from wardstone.operators import verdict as vd
from wardstone.sources import fixed_values as fixed
from wardstone.sources import replies, requests, sinks
from wardstone.sources.tables import fixed_table, lookup

_SP = r"\t\n\x{0B}\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"


def long(col):
    return (F.col(col) if isinstance(col, str) else col).cast("long")


def flat(df, *carry):
    """A verdict as plain columns, with nulls as empty strings."""
    c = F.col

    def s(col):
        return F.coalesce(col, F.lit(""))

    ctx = c("approval_context")
    return df.select(
        *carry, "request_id", "blocked", "action",
        *[s(c(n)).alias(n) for n in ("threat_type", "owasp_category", "severity", "confidence", "guidance",
                                     "agent_instruction", "user_message", "approval_id")],
        s(c("audit.policy_name")).alias("policy_name"),
        s(F.array_join("audit.framework_references", "|")).alias("refs"),
        s(F.array_join(ctx["risk_factors"], "|")).alias("risk_factors"),
        s(F.concat_ws("/", ctx["threat_type"], ctx["severity"], ctx["owasp_category"], ctx["original_action"])).alias("override_of"),
    )


# --- sources ---------------------------------------------------------------------------

_PROMPTS = "SELECT conv_id * 1000 + turn AS row_id, text AS content, role AS context, turn % 2 = 0 AS redact_pii FROM {conversations}"
_RESPONSES = "SELECT conv_id * 1000 + turn AS row_id, text AS response, role AS original_prompt FROM {conversations}"
_DECISIONS = "SELECT event_id AS row_id, CAST(user_id AS STRING) AS approval_id, event_type AS decision, CASE event_id % 3 WHEN 0 THEN NULL ELSE 'because' END AS justification FROM {events}"
_ALL_VIEWS = [("scan_sql_query", SQL_TEXT), ("scan_file_write", PATHS), ("scan_web_search", SEARCHES), ("scan_command", COMMANDS), ("scan_a2a_message", MESSAGES),
              ("scan_agent_card", CARDS), ("scan_prompt", _PROMPTS), ("scan_response", _RESPONSES), ("check_approval", _DECISIONS), ("report_bypass", BYPASSES)]


def _text_fields(tool: str) -> list[str]:
    return [f.split()[0] for f in requests.SCHEMAS[tool].split(", ") if f.endswith(" string")]


def _typed_sql(tool: str, view: str) -> str:
    there = [c for c in _text_fields(tool) if f"AS {c}" in view]
    parts = " UNION ALL ".join(f"SELECT '{tool}' AS tool, '{c}' AS field, {c if c in there else 'NULL'} AS x FROM {tool}" for c in _text_fields(tool))
    return f"SELECT tool, field, count(*) AS n, count(x) AS n_given, CAST(coalesce(sum(length(x)), 0) AS BIGINT) AS chars, CAST(coalesce(min(x), '') AS VARCHAR) AS least FROM ({parts}) GROUP BY ALL"


@check("s1_typed_requests", "WITH " + ", ".join(duck_view(t, v) for t, v in _ALL_VIEWS) + " " + " UNION ALL ".join(_typed_sql(t, v) for t, v in _ALL_VIEWS))
def s1(spark, d):
    out = None
    for tool, view in _ALL_VIEWS:
        df = requests.conform(spark_view(spark, d, view), tool)
        fields = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("x")) for c in _text_fields(tool)))).alias("f")
        part = df.select(fields).groupBy(F.lit(tool).alias("tool"), F.col("f.field").alias("field")).agg(
            F.count(F.lit(1)).alias("n"), F.count("f.x").alias("n_given"), F.coalesce(F.sum(F.length("f.x")), F.lit(0)).alias("chars"), F.coalesce(F.min("f.x"), F.lit("")).alias("least"))
        out = part if out is None else out.unionByName(part)
    return out


@check("s4_domain_lists", "WITH " + duck_view("s", SEARCHES) + ", " + values("lists", ["kind", "entry"],
       [("host", x) for x in fixed.BLOCKED_HOSTS] + [("tld", x) for x in fixed.SUSPICIOUS_TLDS] + [("word", x) for x in fixed.SUSPICIOUS_WORDS])
       + """, dom AS (SELECT row_id, lower(unnest(target_domains)) AS dom FROM s)
  SELECT kind, entry, count(dom) AS n_domains FROM lists LEFT JOIN dom ON
    CASE kind WHEN 'tld' THEN ends_with(dom, entry) ELSE contains(dom, entry) END GROUP BY ALL""")
def s4(spark, d):
    rows = ([("host", x) for x in fixed.BLOCKED_HOSTS] + [("tld", x) for x in fixed.SUSPICIOUS_TLDS]
            + [("word", x) for x in fixed.SUSPICIOUS_WORDS])
    lists = fixed_table(spark, ["kind", "entry"], rows)
    hit = F.when(F.col("kind") == "tld", F.endswith("dom", "entry")).otherwise(F.contains("dom", "entry"))
    dom = spark_view(spark, d, SEARCHES).select(F.explode("target_domains").alias("d")).select(F.lower("d").alias("dom"))
    # The list side is 41 literals: a broadcast theta join, counted per entry before the shuffle.
    used = dom.join(F.broadcast(lists), hit).groupBy("kind", "entry").agg(F.count(F.lit(1)).alias("n"))
    return lists.join(used, ["kind", "entry"], "left").select("kind", "entry", F.coalesce("n", F.lit(0)).alias("n_domains"))


@check("s5_taxonomy", "WITH " + duck_view("findings", FINDINGS) + ", " + DIMS + """
  SELECT t.ttype AS threat_type, owasp AS owasp_category, array_to_string(refs, '|') AS refs, guidance, tmessage AS user_message, count(f.pos) AS n
  FROM types t LEFT JOIN (SELECT coalesce(a.ttype, 'unknown') AS ttype, pos FROM findings LEFT JOIN aliases a
    ON a.alias = replace(lower(threat_type), '-', '_')) f ON f.ttype = t.ttype GROUP BY ALL""")
def s5(spark, d):
    used = vd.normalise_threat(spark_view(spark, d, FINDINGS), "threat_type").groupBy("threat_type").agg(F.count(F.lit(1)).alias("n"))
    return vd.type_table(spark).join(used, "threat_type", "left").select(
        "threat_type", "owasp_category", F.array_join("framework_references", "|").alias("refs"), "guidance",
        F.col("type_message").alias("user_message"), F.coalesce("n", F.lit(0)).alias("n"))


@check("s6_category_listing", "WITH " + duck_view("findings", FINDINGS) + ", " + ALIASES + ", " + values("cats", ["id", "description"], fixed.CATEGORY_LISTING) + """
  SELECT id, description, count(f.pos) AS n_findings FROM cats LEFT JOIN (SELECT a.ttype, pos FROM findings JOIN aliases a
    ON a.alias = replace(lower(threat_type), '-', '_')) f ON f.ttype = id GROUP BY ALL""")
def s6(spark, d):
    cats = fixed_table(spark, ["id", "description"], fixed.CATEGORY_LISTING)
    used = vd.normalise_threat(spark_view(spark, d, FINDINGS), "threat_type").groupBy(F.col("threat_type").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return cats.join(used, "id", "left").select("id", "description", F.coalesce("n", F.lit(0)).alias("n_findings"))


_JSON = """parsed AS (SELECT row_id, error, reply, reply IS NOT NULL AND json_valid(reply) AS ok,
    CASE WHEN reply IS NOT NULL AND json_valid(reply) THEN CAST(reply AS JSON) END AS j FROM replies),
  violations AS (SELECT row_id, i AS pos, json_extract(j, '$.violations[' || i || ']') AS v FROM parsed,
    unnest(range(CAST(coalesce(json_array_length(j, '$.violations'), 0) AS BIGINT))) AS t(i) WHERE ok),
  findings AS (SELECT row_id AS request_id, pos, v->>'$.threat_type' AS threat_type, v->>'$.severity' AS severity,
    CAST(v->>'$.confidence' AS DOUBLE) AS confidence, v->>'$.action' AS action, v->>'$.detected_by' AS detected_by,
    v->>'$.ai_reasoning' AS reasoning, v->>'$.policy_id' AS policy_id, v->>'$.policy_name' AS policy_name,
    v->>'$.pattern' AS pattern FROM violations)"""


@check("s7_parse_replies", "WITH " + duck_view("replies", REPLIES) + ", " + _JSON + ", " + FILLED + """,
  failed AS (SELECT row_id AS request_id, 0 AS pos, 'scan_error' AS type, 'high' AS severity, 1.0 AS confidence, 'block' AS action,
    'Security scan could not complete: ' || CASE WHEN reply IS NULL THEN error ELSE 'Scan error' END || '. Blocking as precaution.' AS message
    FROM parsed WHERE NOT ok)
  SELECT request_id AS row_id, pos, type, severity, confidence, action, message FROM filled
  UNION ALL SELECT * FROM failed""")
def s7(spark, d):
    df = replies.reply_results(spark_view(spark, d, REPLIES), "reply", "scan_prompt", "error")
    return df.select("row_id", F.posexplode("findings").alias("pos", "f")).select(
        "row_id", long("pos").alias("pos"), "f.type", "f.severity", "f.confidence", "f.action", "f.message")


_LINE_FIELDS = ["level", "type", "request_id", "customer_id", "tool_name", "blocked", "threat_type", "detection_layers", "policy_ids"]


def _list_sql(col: str, failed: str) -> str:
    body = "'\"' || " + col + " || '\"'"
    return f"CASE WHEN NOT ok THEN '[\"{failed}\"]' ELSE '[' || coalesce(string_agg({body}, ',' ORDER BY pos), '') || ']' END"


@check("s8_audit_lines", "WITH " + duck_view("replies", REPLIES) + ", " + _JSON + ", " + FILLED + f"""
  SELECT 'info' AS level, 'scan_detail' AS type, CAST(row_id AS VARCHAR) AS request_id, 'anonymous' AS customer_id, 'scan_prompt' AS tool_name,
    CASE WHEN NOT ok OR NOT coalesce(CAST(j->>'$.safe' AS BOOLEAN), false) OR coalesce(bool_or(action IN ('block', 'redact', 'flag') OR severity IN ('critical', 'high', 'medium')), false) THEN 'true' ELSE 'false' END AS blocked,
    CASE WHEN NOT ok THEN 'scan_error' ELSE coalesce(arg_min(type, pos), '') END AS threat_type,
    {_list_sql('detected_by', 'fail_closed_policy')} AS detection_layers, {_list_sql('policy_id', 'pol-fail-closed')} AS policy_ids
  FROM parsed p LEFT JOIN filled f ON f.request_id = p.row_id GROUP BY row_id, ok, j""")
def s8(spark, d):
    df = replies.reply_results(spark_view(spark, d, REPLIES).withColumn("request_id", F.col("row_id").cast("string")), "reply", "scan_prompt", "error")
    lines = sinks.audit_lines(df, "scan_prompt", F.lit("anonymous"))
    return lines.select(*[F.coalesce(F.get_json_object("line", f"$.{f}"), F.lit("")).alias(f) for f in _LINE_FIELDS])


_BYPASS = """SELECT row_id, CASE WHEN nullif(prompt, '') IS NOT NULL THEN prompt
    WHEN nullif(file_path, '') IS NOT NULL OR nullif(file_content, '') IS NOT NULL THEN
      concat_ws(chr(10), 'FILE_PATH: ' || nullif(file_path, ''), 'FILE_CONTENT:' || chr(10) || nullif(file_content, ''))
    WHEN nullif(sql_query, '') IS NOT NULL THEN 'SQL_QUERY: ' || sql_query
    WHEN nullif(search_query, '') IS NOT NULL THEN 'SEARCH_QUERY: ' || search_query ELSE '' END AS bypass_text,
  CASE WHEN nullif(category, '') IS NOT NULL THEN category
    WHEN nullif(file_path, '') IS NOT NULL OR nullif(file_content, '') IS NOT NULL THEN 'secrets_exposure'
    WHEN nullif(sql_query, '') IS NOT NULL THEN 'sql_injection' WHEN nullif(search_query, '') IS NOT NULL THEN 'pii_in_search'
    ELSE 'prompt_injection' END AS category, coalesce(mutation_type, 'unknown') AS mutation_type FROM b"""


@check("s9_bypass_sink", "WITH " + duck_view("b", BYPASSES) + f""" SELECT row_id, bypass_text, category, mutation_type, 'mcp-agent' AS source,
  0.9::DOUBLE AS confidence FROM ({_BYPASS}) WHERE bypass_text <> ''""")
def s9(spark, d):
    df = validate.bypass_text(spark_view(spark, d, BYPASSES)).filter("error IS NULL")
    return df.select("row_id", "bypass_text", "category", "mutation_type", "source", "confidence")


@check("p20_bypass_text", "WITH " + duck_view("b", BYPASSES) + f" SELECT row_id, bypass_text, CASE WHEN bypass_text = '' THEN {q(fixed.BYPASS_REJECTED)} ELSE '' END AS error FROM ({_BYPASS})")
def p20(spark, d):
    df = validate.bypass_text(spark_view(spark, d, BYPASSES))
    return df.select("row_id", F.coalesce("bypass_text", F.lit("")).alias("bypass_text"), F.coalesce("error", F.lit("")).alias("error"))


@check("p21_bypass_category", "WITH " + duck_view("b", BYPASSES) + f" SELECT row_id, category FROM ({_BYPASS})")
def p21(spark, d):
    return validate.bypass_text(spark_view(spark, d, BYPASSES)).select("row_id", "category")


# --- projections -----------------------------------------------------------------------

def _req(view, name, tool, case):
    @check(name, "WITH " + duck_view("v", view) + f" SELECT row_id, {case} AS error FROM v")
    def run(spark, d):
        df = spark_view(spark, d, view)
        return df.select("row_id", F.coalesce(validate.required_error(tool), F.lit("")).alias("error"))


_req(SQL_TEXT, "p1_required_sql", "scan_sql_query", "CASE WHEN coalesce(query, '') = '' THEN 'query is required' ELSE '' END")
_req(PATHS, "p1_required_file", "scan_file_write", "CASE WHEN coalesce(path, '') = '' THEN 'path is required' WHEN coalesce(content, '') = '' THEN 'content is required' ELSE '' END")
_req(BYPASSES, "p1_required_bypass", "report_bypass", "CASE WHEN coalesce(prompt,'')||coalesce(file_path,'')||coalesce(file_content,'')||coalesce(sql_query,'')||coalesce(search_query,'') = '' THEN 'At least one of prompt, filePath, fileContent, sqlQuery, or searchQuery is required' ELSE '' END")


@check("p2_size_guard", """SELECT doc_id, n, CASE WHEN n > 102400 THEN 'Content too large (' || CAST(floor(n / 1024.0 + 0.5) AS BIGINT) || 'KB > 100KB limit)' ELSE '' END AS error,
  CASE WHEN length(text) > 1048576 THEN 'File content too large (' || CAST(floor(length(text) / 1024.0 + 0.5) AS BIGINT) || 'KB > 1024KB limit)' ELSE '' END AS file_error
  FROM (SELECT doc_id, text, length(text) + length(lang) + 25 * n_chars AS n FROM documents)""")
def p2(spark, d):
    df = table(spark, d, "documents", "doc_id", "text", "lang", "n_chars")
    size = validate.text_size(F.col("text"), F.col("lang")) + 25 * F.col("n_chars")
    file_size = validate.text_size(F.col("text"))
    return df.select("doc_id", size.alias("n"), F.coalesce(validate.size_error(size), F.lit("")).alias("error"),
                     F.coalesce(validate.size_error(file_size, fixed.MAX_FILE_CHARS, "File content"), F.lit("")).alias("file_error"))


_KIND = "CASE " + " ".join(f"WHEN starts_with(u, '{k}') THEN '{k}'" for k in fixed.STATEMENT_KINDS) + " ELSE 'UNKNOWN' END"


@check("p3_statement_kind", "WITH " + duck_view("v", SQL_TEXT) + f" SELECT row_id, {_KIND} AS kind FROM (SELECT row_id, upper(regexp_replace(query, '^[{_SP}]+', '')) AS u FROM v)")
def p3(spark, d):
    return spark_view(spark, d, SQL_TEXT).select("row_id", mapping.statement_kind("query").alias("kind"))


@check("p4_file_extension", "WITH " + duck_view("v", PATHS) + r" SELECT row_id, lower(coalesce(nullif(regexp_extract(path, '\.([^./\\]+)$', 1), ''), 'none')) AS extension FROM v")
def p4(spark, d):
    return spark_view(spark, d, PATHS).select("row_id", mapping.file_extension("path").alias("extension"))


@check("p5_measures", "WITH " + ", ".join(duck_view(t, v) for t, v in _ALL_VIEWS) + """
  SELECT 'scan_sql_query' AS tool, row_id, length(query) AS n_chars, 0 AS n_more FROM scan_sql_query
  UNION ALL SELECT 'scan_file_write', row_id, length(path), length(content) FROM scan_file_write
  UNION ALL SELECT 'scan_web_search', row_id, length(query), coalesce(len(target_domains), 0) FROM scan_web_search
  UNION ALL SELECT 'scan_command', row_id, length(command), 0 FROM scan_command
  UNION ALL SELECT 'scan_a2a_message', row_id, length(message), 0 FROM scan_a2a_message
  UNION ALL SELECT 'scan_agent_card', row_id, length(agent_card), 0 FROM scan_agent_card""")
def p5(spark, d):
    out = None
    measured = ["query", "path", "query", "command", "message", "agent_card"]
    for (tool, view), col in zip(_ALL_VIEWS, measured):
        df = spark_view(spark, d, view)
        more = F.lit(0)
        if tool == "scan_file_write":
            more = validate.text_size(F.col("content"))
        if tool == "scan_web_search":
            more = F.coalesce(F.size("target_domains"), F.lit(0))
        part = df.select(F.lit(tool).alias("tool"), "row_id", long(validate.text_size(F.col(col))).alias("n_chars"), long(more).alias("n_more"))
        out = part if out is None else out.unionByName(part)
    return out


ROUTED = """SELECT event_id AS row_id, CASE event_id % 15 WHEN 13 THEN 'mystery' WHEN 14 THEN '' """ + " ".join(
    f"WHEN {i} THEN '{t}'" for i, (t, _) in enumerate(fixed.TYPE_TO_TOOL)) + """ ELSE 'Prompt' END AS scan_type,
  CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN array('scan_prompt', 'scan_sql_query', 'no_such_tool') ELSE array('nothing_valid') END AS wanted FROM {events}"""
_TYPES = values("map", ["scan_type", "tool"], fixed.TYPE_TO_TOOL)
_VALID = ", ".join(t for t, _ in fixed.TYPE_TO_TOOL)


@check("p6_route", "WITH " + duck_view("v", ROUTED) + ", " + _TYPES + f""" SELECT row_id, coalesce(tool, '') AS tool,
  CASE WHEN v.scan_type = '' THEN 'type and input are required' WHEN tool IS NULL THEN 'Unknown scan type: ' || v.scan_type || '. Valid types: {_VALID}' ELSE '' END AS error
  FROM v LEFT JOIN map USING (scan_type)""")
def p6(spark, d):
    df = validate.route(spark_view(spark, d, ROUTED), "scan_type")
    return df.select("row_id", F.coalesce("tool", F.lit("")).alias("tool"), F.coalesce("error", F.lit("")).alias("error"))


_JOB_TOOLS = ["scan_prompt", "scan_command", "bogus"]


@check("p7_enabled_tools", "WITH " + duck_view("v", ROUTED) + ", " + _TYPES + """ SELECT row_id, tool,
  CASE WHEN wanted IS NULL THEN tool IN ('scan_prompt', 'scan_command') ELSE tool IN ('scan_prompt', 'scan_sql_query') AND list_contains(wanted, tool) END AS enabled
  FROM v JOIN map USING (scan_type)""")
def p7(spark, d):
    df = validate.route(spark_view(spark, d, ROUTED), "scan_type").filter("tool IS NOT NULL")
    on = validate.enabled_tools(F.col("wanted"), _JOB_TOOLS)
    return df.select("row_id", "tool", F.array_contains(on, F.col("tool")).alias("enabled"))


_CTX = ["shell", "working_directory", "execution_context", "piped_from"]


@check("p8_context_map", "WITH " + duck_view("v", COMMANDS) + " SELECT row_id, concat_ws(';', " + ", ".join(
    f"'{c}=' || nullif({c}, '')" for c in _CTX) + ", 'source_application=agent-scan') AS context FROM v")
def p8(spark, d):
    df = spark_view(spark, d, COMMANDS)
    m = mapping.context_map({c: F.col(c) for c in _CTX}, {"source_application": "agent-scan"})
    pairs = F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return df.select("row_id", F.array_join(pairs, ";").alias("context"))


_FILLED = "WITH " + duck_view("findings", FINDINGS) + ", " + FILLED


@check("p9_finding_defaults", _FILLED + " SELECT request_id, pos, type, severity, confidence, action, detected_by, message, policy_id, policy_name FROM filled")
def p9(spark, d):
    return fnd.with_defaults(spark_view(spark, d, FINDINGS)).select(
        "request_id", "pos", "type", "severity", "confidence", "action", "detected_by", "message", "policy_id", "policy_name")


@check("p10_specialized_finding", "WITH " + duck_view("v", SPECIAL) + """ SELECT row_id, threat_type AS type, coalesce(nullif(severity, ''), 'high') AS severity,
  coalesce(nullif(reason, ''), 'SQL security issue detected') AS message FROM v WHERE NOT coalesce(safe, false) AND coalesce(threat_type, '') <> ''""")
def p10(spark, d):
    one = fnd.specialized_finding(F.col("safe"), F.col("threat_type"), F.col("severity"), F.col("reason"), "SQL security issue detected")
    return spark_view(spark, d, SPECIAL).select("row_id", one.alias("f")).filter("f IS NOT NULL").select("row_id", "f.type", "f.severity", "f.message")


@check("p11_p12_p13_p19_mappings", "WITH " + duck_view("v", SPECIAL) + f""" SELECT row_id, {level('severity')} AS threat_level, {action('severity')} AS action,
  {bucket('confidence')} AS bucket, CASE WHEN coalesce(confidence, 0) = 0 THEN 0.5 ELSE confidence END AS confidence FROM v""")
def p11(spark, d):
    return spark_view(spark, d, SPECIAL).select(
        "row_id", mapping.threat_level("severity").alias("threat_level"), mapping.severity_action("severity").alias("action"),
        mapping.confidence_bucket("confidence").alias("bucket"), mapping.confidence_or_half("confidence").alias("confidence"))


@check("p14_normalise_threat", "WITH " + duck_view("findings", FINDINGS) + ", " + ALIASES + """ SELECT pos, findings.threat_type AS raw_type, coalesce(ttype, 'unknown') AS threat_type
  FROM findings LEFT JOIN aliases ON alias = replace(lower(findings.threat_type), '-', '_')""")
def p14(spark, d):
    df = spark_view(spark, d, FINDINGS).withColumnRenamed("threat_type", "raw_type")
    return vd.normalise_threat(df, "raw_type").select("pos", "raw_type", "threat_type")


@check("p15_p16_threat_details", "WITH " + duck_view("findings", FINDINGS) + ", " + DIMS + """ SELECT pos, t.ttype AS threat_type, guidance, owasp AS owasp_category, array_to_string(refs, '|') AS refs
  FROM findings LEFT JOIN aliases a ON alias = replace(lower(findings.threat_type), '-', '_') JOIN types t ON t.ttype = coalesce(a.ttype, 'unknown')""")
def p15(spark, d):
    df = vd.with_threat_details(vd.normalise_threat(spark_view(spark, d, FINDINGS), "threat_type"))
    return df.select("pos", "threat_type", "guidance", "owasp_category", F.array_join("framework_references", "|").alias("refs"))


@check("p17_agent_instruction", "WITH " + duck_view("v", ROUTED) + ", " + _TYPES + ", " + DIMS + """ SELECT row_id, coalesce(m.tool, '') AS tool,
  coalesce(t.instruction, p.instruction) AS instruction FROM v LEFT JOIN map m USING (scan_type) LEFT JOIN tools t ON t.tool = m.tool, (SELECT instruction FROM tools WHERE tool = 'scan_prompt') p""")
def p17(spark, d):
    df = validate.route(spark_view(spark, d, ROUTED), "scan_type")
    default = dict(fixed.AGENT_INSTRUCTIONS)["scan_prompt"]
    return lookup(df, vd.tool_table(spark), "tool").select(
        "row_id", F.coalesce("tool", F.lit("")).alias("tool"), F.coalesce("blocked_instruction", F.lit(default)).alias("instruction"))


@check("p18_request_id", "SELECT event_id AS row_id, 'req_' || lower(to_base(epoch_us(ts) // 1000, 36)) || '_' || substr(sha256(CAST(event_id AS VARCHAR)), 1, 8) AS request_id FROM events")
def p18(spark, d):
    df = table(spark, d, "events", "event_id", "ts")
    return df.select(F.col("event_id").alias("row_id"), mapping.request_id(F.col("ts"), F.col("event_id")).alias("request_id"))


# --- aggregates ------------------------------------------------------------------------

_SUM = _FILLED + ", " + SUMMARY
_COUNTS = ["total", "critical_count", "high_count", "medium_count", "low_count", "blocked_count", "flagged_count"]


def summary(spark, d, view=FINDINGS):
    return fnd.summarise(fnd.with_defaults(spark_view(spark, d, view)))


@check("a1_finding_summary", _SUM + f" SELECT request_id, {', '.join(_COUNTS)} FROM summary")
def a1(spark, d):
    return summary(spark, d).select("request_id", *_COUNTS)


_SMALL = "WITH " + duck_view("findings", SMALL_FINDINGS) + ", " + FILLED + ", " + SUMMARY


@check("a2_a3_a4_result", _SMALL + f" SELECT request_id, confidence, {LADDER} AS action, severity FROM summary")
def a2(spark, d):
    return summary(spark, d, SMALL_FINDINGS).select("request_id", "confidence", "action", "severity")


@check("o4_primary_finding", _SMALL + " SELECT request_id, primary_type, primary_policy FROM summary")
def o4(spark, d):
    return summary(spark, d, SMALL_FINDINGS).select("request_id", "primary_type", "primary_policy")


@check("a12_log_arrays", "WITH " + duck_view("replies", REPLIES) + ", " + _JSON + ", " + FILLED + """
  SELECT p.row_id, coalesce(CASE WHEN ok THEN string_agg(detected_by, ',' ORDER BY pos) ELSE 'fail_closed_policy' END, '') AS layers,
    coalesce(CASE WHEN ok THEN string_agg(policy_id, ',' ORDER BY pos) ELSE 'pol-fail-closed' END, '') AS policies,
    coalesce(string_agg(nullif(pattern, ''), ',' ORDER BY pos), '') AS patterns,
    NOT ok OR NOT coalesce(CAST(j->>'$.safe' AS BOOLEAN), false) OR coalesce(bool_or(action IN ('block', 'redact', 'flag') OR severity IN ('critical', 'high', 'medium')), false) AS blocked
  FROM parsed p LEFT JOIN filled f ON f.request_id = p.row_id GROUP BY p.row_id, ok, j""")
def a12(spark, d):
    df = replies.reply_results(spark_view(spark, d, REPLIES).withColumn("request_id", F.col("row_id").cast("string")), "reply", "scan_prompt", "error")
    df = sinks.log_entry(df, "scan_prompt", F.lit("anonymous"), "row_id")
    return df.select("row_id", F.array_join("detection_layers", ",").alias("layers"), F.array_join("policy_ids", ",").alias("policies"),
                     F.array_join("matched_patterns", ",").alias("patterns"), "blocked")


# --- verdicts --------------------------------------------------------------------------

_FROM_ROWS = f"""results AS (SELECT CAST(request_id AS VARCHAR) AS request_id, 'scan_prompt' AS tool, request_id % 3 = 0 AS safe, {LADDER} AS action,
  confidence, primary_type, primary_policy, severity, {NO_APPROVAL} FROM summary)"""


@check("v1_verdict_from_rows", _SMALL + ", " + DIMS + ", " + _FROM_ROWS + " " + verdict("results"))
def v1_rows(spark, d):
    df = summary(spark, d, SMALL_FINDINGS).withColumn("safe", F.col("request_id") % 3 == 0)
    df = df.withColumn("request_id", F.col("request_id").cast("string"))
    return flat(vd.build_verdict(vd.internal_result(df, "scan_prompt")))


_REPLY_RESULTS = f"""counted AS (SELECT p.row_id, p.ok, p.j, count(f.pos) FILTER (WHERE f.severity = 'critical') AS critical_count,
    count(f.pos) FILTER (WHERE f.severity = 'high') AS high_count, count(f.pos) FILTER (WHERE f.severity = 'medium') AS medium_count,
    count(f.pos) FILTER (WHERE f.action = 'block') AS blocked_count, count(f.pos) FILTER (WHERE f.action = 'flag') AS flagged_count,
    count(f.pos) FILTER (WHERE f.action = 'redact') AS redact_count, coalesce(max(f.confidence), 0) AS confidence,
    {of_rank('coalesce(max(' + rank('f.severity') + '), 0)', 'medium')} AS severity, arg_min(type, pos) AS primary_type, arg_min(policy_name, pos) AS primary_policy
    FROM parsed p LEFT JOIN filled f ON f.request_id = p.row_id GROUP BY p.row_id, p.ok, p.j),
  results AS (SELECT CAST(row_id AS VARCHAR) AS request_id, '{{tool}}' AS tool, ok AND coalesce(CAST(j->>'$.safe' AS BOOLEAN), false) AS safe,
    CASE WHEN NOT ok THEN 'block' ELSE {LADDER} END AS action, CASE WHEN ok THEN confidence ELSE 1.0 END AS confidence,
    CASE WHEN ok THEN primary_type ELSE 'scan_error' END AS primary_type, CASE WHEN ok THEN primary_policy ELSE 'Fail-Closed Security Policy' END AS primary_policy,
    CASE WHEN ok THEN severity ELSE 'high' END AS severity, coalesce(CAST(j->>'$.approval_info.requires_approval' AS BOOLEAN), false) AS held,
    j->>'$.approval_info.approval_id' AS ap_id, CAST(j->>'$.approval_info.expires_in_seconds' AS BIGINT) AS ap_seconds,
    j->>'$.approval_info.threat_type' AS ap_threat, j->>'$.approval_info.severity' AS ap_severity, j->>'$.approval_info.owasp_category' AS ap_owasp,
    j->>'$.approval_info.original_action' AS ap_original, j->>'$.approval_info.policy_name' AS ap_policy,
    CAST(json_extract(j, '$.approval_info.risk_factors') AS VARCHAR[]) AS ap_risks FROM counted)"""
_REPLIED = "WITH " + duck_view("replies", REPLIES) + ", " + _JSON + ", " + FILLED + ", " + DIMS + ", "


def _replied(spark, d, tool):
    df = spark_view(spark, d, REPLIES).withColumn("request_id", F.col("row_id").cast("string"))
    return replies.reply_results(df, "reply", tool, "error")


@check("v1_v3_v8_prompt_verdict", _REPLIED + _REPLY_RESULTS.replace("{tool}", "scan_prompt") + " " + verdict("results"))
def v1(spark, d):
    return flat(vd.build_verdict(_replied(spark, d, "scan_prompt")))


@check("v4_response_verdict", _REPLIED + _REPLY_RESULTS.replace("{tool}", "scan_response")
       + ", relaxed AS (SELECT * REPLACE (safe OR action = 'flag' AS safe, CASE WHEN action = 'flag' THEN 'allow' ELSE action END AS action) FROM results) " + verdict("relaxed"))
def v4(spark, d):
    return flat(vd.build_verdict(vd.response_policy(_replied(spark, d, "scan_response"))))


@check("v8_fail_closed", "WITH " + duck_view("replies", REPLIES) + """ SELECT row_id, CASE WHEN reply IS NULL THEN error WHEN NOT json_valid(reply) THEN 'Scan error' ELSE '' END AS failure,
  CASE WHEN reply IS NULL THEN contains(error, 'timeout') ELSE false END AS timed_out FROM replies""")
def v8(spark, d):
    return _replied(spark, d, "scan_prompt").select("row_id", F.coalesce("failure", F.lit("")).alias("failure"), "timed_out")


@check("v11_external_columns", _REPLIED + _REPLY_RESULTS.replace("{tool}", "scan_prompt") + f" SELECT request_id, 13 AS n_columns, blocked FROM ({verdict('results')})")
def v11(spark, d):
    out = vd.build_verdict(_replied(spark, d, "scan_prompt"))
    return out.select("request_id", F.lit(len(out.columns)).alias("n_columns"), "blocked")


_SPECIAL_TOOLS = ["scan_sql_query", "scan_web_search", "scan_command", "scan_a2a_message", "scan_agent_card"]
_SPECIAL_RESULTS = f"""results AS (SELECT CAST(row_id AS VARCHAR) AS request_id, tool, coalesce(safe, false) AS safe,
  CASE WHEN coalesce(safe, false) THEN 'allow' ELSE {action('severity')} END AS action, confidence,
  CASE WHEN NOT coalesce(safe, false) THEN nullif(threat_type, '') END AS primary_type, '' AS primary_policy,
  CASE WHEN NOT coalesce(safe, false) AND coalesce(threat_type, '') <> '' THEN {of_rank(rank("coalesce(nullif(severity, ''), 'high')"), 'medium')} ELSE 'medium' END AS severity,
  {NO_APPROVAL} FROM v, (SELECT unnest({_SPECIAL_TOOLS}) AS tool))"""


@check("v2_v7_specialized_verdict", "WITH " + duck_view("v", SPECIAL) + ", " + DIMS + ", " + _SPECIAL_RESULTS + " " + verdict("results", "s.tool AS tool,"))
def v2(spark, d):
    df = spark_view(spark, d, SPECIAL).withColumn("tool", F.explode(F.array(*[F.lit(t) for t in _SPECIAL_TOOLS])))
    one = fnd.specialized_finding(F.col("safe"), F.col("threat_type"), F.col("severity"), F.col("reason"), "issue")
    df = df.withColumn("findings", fnd.only(one)).withColumn("request_id", F.col("row_id").cast("string"))
    result = vd.specialized_result(F.col("safe"), F.col("severity"))
    df = vd.internal_result(df, "", **result, **vd.result_columns(F.col("findings")))
    return flat(vd.build_verdict(df, "tool"), "tool")


_DOMAIN_ISSUES = """dom AS (SELECT row_id, i, target_domains[i] AS raw, lower(target_domains[i]) AS dom FROM s, unnest(range(1, coalesce(len(target_domains), 0) + 1)) AS t(i)),
  issues AS (SELECT row_id, i, 1 AS k, 'blocked_domain' AS type, 'high' AS severity, 'Blocked domain: ' || raw AS message FROM dom WHERE """ + " OR ".join(
    f"contains(dom, '{x}')" for x in fixed.BLOCKED_HOSTS) + """
   UNION ALL SELECT row_id, i, 2, 'suspicious_tld', 'medium', 'Suspicious TLD in domain: ' || raw FROM dom WHERE """ + " OR ".join(
    f"ends_with(dom, '{x}')" for x in fixed.SUSPICIOUS_TLDS) + """
   UNION ALL SELECT row_id, i, 3, 'suspicious_domain', 'high', 'Suspicious keyword in domain: ' || raw FROM dom WHERE """ + " OR ".join(
    f"contains(dom, '{x}')" for x in fixed.SUSPICIOUS_WORDS) + ")"


@check("j3_domain_findings", "WITH " + duck_view("s", SEARCHES) + ", " + _DOMAIN_ISSUES + " SELECT row_id, row_number() OVER (PARTITION BY row_id ORDER BY i, k) - 1 AS pos, type, severity, message FROM issues")
def j3(spark, d):
    df = spark_view(spark, d, SEARCHES)
    return df.select("row_id", F.posexplode(domains.domain_findings(F.col("target_domains"))).alias("pos", "f")).select(
        "row_id", long("pos").alias("pos"), "f.type", "f.severity", "f.message")


_ANSWER = """ans AS (SELECT *, CASE row_id % 4 WHEN 0 THEN true WHEN 1 THEN false ELSE true END AS safe,
  CASE row_id % 4 WHEN 1 THEN 'low' WHEN 2 THEN 'Medium' ELSE '' END AS severity, CASE row_id % 5 WHEN 0 THEN NULL ELSE CAST(row_id % 100 AS DOUBLE) / 100 END AS confidence FROM {s})"""


@check("v5_search_escalation", "WITH " + duck_view("s", SEARCHES) + ", " + _DOMAIN_ISSUES + ", " + _ANSWER.format(s="s") + f""",
  sev AS (SELECT row_id, bool_or(severity = 'high') AS high, bool_or(severity = 'medium') AS medium FROM issues GROUP BY row_id),
  base AS (SELECT a.row_id, safe AND sev.row_id IS NULL AS safe, {level('severity')} AS lvl, CASE WHEN safe THEN 'allow' ELSE {action('severity')} END AS act,
    CASE WHEN coalesce(confidence, 0) = 0 THEN 0.5 ELSE confidence END AS c, coalesce(high, false) AS high, coalesce(medium, false) AS medium FROM ans a LEFT JOIN sev USING (row_id))
  SELECT row_id, safe, CASE WHEN high THEN CASE WHEN lvl = 'none' THEN 'high' ELSE lvl END WHEN medium AND lvl = 'none' THEN 'medium' ELSE lvl END AS threat_level,
    CASE WHEN high THEN 'block' WHEN medium AND lvl = 'none' THEN 'flag' ELSE act END AS action,
    CASE WHEN high THEN greatest(c, 0.85) WHEN medium AND lvl = 'none' THEN greatest(c, 0.7) ELSE c END AS confidence FROM base""")
def v5(spark, d):
    view = _ANSWER.format(s="{s}").removeprefix("ans AS (").removesuffix(")")
    df = spark.sql(view, s=spark_view(spark, d, SEARCHES)).withColumn("findings", domains.domain_findings(F.col("target_domains")))
    return domains.escalate(df).select("row_id", "safe", "threat_level", "action", "confidence")


@check("a7_any_severity", "WITH " + duck_view("s", SEARCHES) + ", " + _DOMAIN_ISSUES + """ SELECT s.row_id, coalesce(bool_or(severity = 'critical'), false) AS any_critical,
  coalesce(bool_or(severity = 'high'), false) AS any_high, coalesce(bool_or(severity = 'medium'), false) AS any_medium FROM s LEFT JOIN issues USING (row_id) GROUP BY s.row_id""")
def a7(spark, d):
    found = domains.domain_findings(F.col("target_domains"))
    df = spark_view(spark, d, SEARCHES).select("row_id", found.alias("f"))
    return df.select("row_id", *[fnd.any_severity(F.col("f"), s).alias(f"any_{s}") for s in ("critical", "high", "medium")])


_PARTS = "pa AS (SELECT * FROM v WHERE event_type <> 'view'), ca AS (SELECT row_id, safe, severity AS reason, threat_type, CASE WHEN row_id % 2 = 0 THEN 'low' ELSE severity END AS severity, 1 - confidence AS confidence FROM v)"
_COMBINED = f"""parts AS (SELECT c.row_id, p.row_id IS NULL OR NOT coalesce(p.safe, false) AS pbad, NOT coalesce(c.safe, false) AS cbad, p.severity AS ps, c.severity AS cs,
    p.threat_type AS pt, c.threat_type AS ct, p.confidence AS pc, c.confidence AS cc FROM ca c LEFT JOIN pa p USING (row_id)),
  worst AS (SELECT *, CASE WHEN cbad AND (NOT pbad OR coalesce(ps, '') = '' OR {rank('cs')} > {rank('ps')}) THEN cs WHEN pbad THEN ps END AS ws FROM parts)"""


@check("v6_a5_a6_o3_file_combination", "WITH " + duck_view("v", SPECIAL) + ", " + _PARTS + ", " + _COMBINED + f"""
  SELECT row_id, NOT pbad AND NOT cbad AS safe, CASE WHEN pbad OR cbad THEN {level('ws')} ELSE 'none' END AS threat_level,
    CASE WHEN pbad OR cbad THEN {action('ws')} ELSE 'allow' END AS action,
    least(1.0, CASE WHEN pbad THEN pc END, CASE WHEN cbad THEN cc END) AS confidence,
    concat_ws(';', CASE WHEN cbad THEN 'content:' || coalesce(nullif(ct, ''), 'content_violation') || ':' || coalesce(nullif(cs, ''), 'high') END,
      CASE WHEN pbad THEN 'path:' || coalesce(nullif(pt, ''), 'path_violation') || ':' || coalesce(nullif(ps, ''), 'high') END) AS issues FROM worst""")
def v6(spark, d):
    v = spark_view(spark, d, SPECIAL)
    content = v.select("row_id", "safe", "threat_type", F.col("severity").alias("reason"),
                       F.when(F.col("row_id") % 2 == 0, "low").otherwise(F.col("severity")).alias("severity"), (1 - F.col("confidence")).alias("confidence"))
    df = files.combine_parts(files.join_parts(v.filter("event_type <> 'view'"), content, "row_id"))
    issues = F.transform("findings", lambda f: F.concat_ws(":", f["location"], f["type"], f["severity"]))
    return df.select("row_id", "safe", "threat_level", "action", "confidence", F.array_join(issues, ";").alias("issues"))


@check("j5_file_parts", "WITH " + duck_view("v", SPECIAL) + ", " + _PARTS + " SELECT coalesce(c.row_id, p.row_id) AS row_id, p.row_id IS NOT NULL AS has_path, coalesce(p.severity, '') AS path_severity, coalesce(c.severity, '') AS content_severity FROM ca c FULL JOIN pa p ON p.row_id = c.row_id")
def j5(spark, d):
    v = spark_view(spark, d, SPECIAL)
    content = v.withColumn("severity", F.when(F.col("row_id") % 2 == 0, "low").otherwise(F.col("severity")))
    path = v.filter("event_type <> 'view'").withColumn("reason", F.lit("p"))
    df = files.join_parts(path, content, "row_id")
    return df.select("row_id", F.col("path_reason").isNotNull().alias("has_path"), F.coalesce("path_severity", F.lit("")).alias("path_severity"),
                     F.coalesce("content_severity", F.lit("")).alias("content_severity"))


@check("j7_attempts_fail_closed", "WITH " + duck_view("replies", REPLIES) + """ SELECT a.row_id, r.reply IS NULL OR NOT json_valid(r.reply) AS failed
  FROM replies a LEFT JOIN (SELECT * FROM replies WHERE reply IS NOT NULL AND row_id % 4 <> 3) r USING (row_id)""")
def j7(spark, d):
    v = spark_view(spark, d, REPLIES)
    done = v.filter("reply IS NOT NULL AND row_id % 4 <> 3").select("row_id", "reply")
    df = replies.attempts_left_open(v.select("row_id", "error"), done, "row_id")
    return replies.reply_results(df, "reply", "scan_prompt", "error").select("row_id", F.col("failure").isNotNull().alias("failed"))


@check("j1_dimension_lookup", "WITH " + duck_view("findings", FINDINGS) + ", " + DIMS + """ SELECT event_type, t.ttype AS threat_type, owasp AS owasp_category, count(*) AS n
  FROM findings LEFT JOIN aliases a ON alias = replace(lower(findings.threat_type), '-', '_') JOIN types t ON t.ttype = coalesce(a.ttype, 'unknown') GROUP BY ALL""")
def j1(spark, d):
    df = vd.with_threat_details(vd.normalise_threat(spark_view(spark, d, FINDINGS), "threat_type"))
    return df.groupBy("event_type", "threat_type", "owasp_category").agg(F.count(F.lit(1)).alias("n"))
