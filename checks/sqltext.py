"""SQL fragments shared by the DuckDB twins."""

from __future__ import annotations

from checks.base import values
from wardstone.sources import fixed_values as fixed

ALIASES = values("aliases", ["alias", "ttype"], fixed.THREAT_ALIASES)
TYPES = values(
    "types", ["ttype", "owasp", "refs", "guidance", "tmessage"],
    [(t, o, [o] + r, g, m) for t, o, r, g, m in fixed.THREAT_TYPES],
)
TOOLS = values(
    "tools", ["tool", "fallback", "instruction"],
    [(t, dict(fixed.FALLBACK_TYPES)[t], x) for t, x in fixed.AGENT_INSTRUCTIONS],
)
DIMS = f"{ALIASES}, {TYPES}, {TOOLS}"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rank(col: str) -> str:
    return f"CASE lower({col}) WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END"


def of_rank(expr: str, default: str) -> str:
    return f"CASE {expr} WHEN 4 THEN 'critical' WHEN 3 THEN 'high' WHEN 2 THEN 'medium' WHEN 1 THEN 'low' ELSE '{default}' END"


def level(col: str) -> str:
    return f"CASE WHEN lower({col}) IN ('critical','high','medium','low') THEN lower({col}) ELSE 'none' END"


def action(col: str) -> str:
    return f"CASE WHEN lower({col}) IN ('critical','high') THEN 'block' WHEN lower({col}) = 'medium' THEN 'flag' ELSE 'allow' END"


def bucket(col: str) -> str:
    return f"CASE WHEN {col} >= 0.9 THEN 'high' WHEN {col} >= 0.7 THEN 'medium' ELSE 'low' END"


FILLED = """filled AS (SELECT request_id, pos, coalesce(nullif(threat_type, ''), 'unknown') AS type,
  coalesce(nullif(severity, ''), 'medium') AS severity, coalesce(confidence, 0.8) AS confidence,
  coalesce(nullif(action, ''), 'flag') AS action, coalesce(nullif(detected_by, ''), 'unknown') AS detected_by,
  coalesce(nullif(reasoning, ''), nullif(policy_name, ''), nullif(threat_type, ''), 'Security violation detected') AS message,
  coalesce(nullif(policy_id, ''), 'unknown') AS policy_id, coalesce(nullif(policy_name, ''), 'Unknown Policy') AS policy_name,
  pattern FROM findings)"""

SUMMARY = f"""summary AS (SELECT request_id, count(*) AS total,
  count(*) FILTER (WHERE severity = 'critical') AS critical_count, count(*) FILTER (WHERE severity = 'high') AS high_count,
  count(*) FILTER (WHERE severity = 'medium') AS medium_count, count(*) FILTER (WHERE severity = 'low') AS low_count,
  count(*) FILTER (WHERE action = 'block') AS blocked_count, count(*) FILTER (WHERE action = 'flag') AS flagged_count,
  count(*) FILTER (WHERE action = 'redact') AS redact_count, coalesce(max(confidence), 0) AS confidence,
  {of_rank('max(' + rank('severity') + ')', 'medium')} AS severity,
  arg_min(type, pos) AS primary_type, arg_min(policy_name, pos) AS primary_policy FROM filled GROUP BY request_id)"""

LADDER = """CASE WHEN blocked_count > 0 OR critical_count > 0 THEN 'block' WHEN redact_count > 0 THEN 'redact'
  WHEN flagged_count > 0 OR high_count > 0 OR medium_count > 0 THEN 'flag' ELSE 'allow' END"""


def fill(template: str, *args: str) -> str:
    """A %s template as SQL concatenation."""
    parts = template.split("%s")
    out = [q(parts[0])]
    for arg, part in zip(args, parts[1:]):
        out += [arg, q(part)]
    return "(" + " || ".join(out) + ")"


def verdict(source: str, extra: str = "") -> str:
    """Flat verdict of a relation with request_id, tool, safe, action, confidence, primary_type,
    primary_policy, severity, held, and ap_* approval columns."""
    minutes = "CAST(CAST(ceil(ap_seconds / 60.0) AS BIGINT) AS VARCHAR)"
    threat = "coalesce(nullif(ap_threat, ''), 'threat detected')"
    override = "coalesce(ap_original = 'block', false)"
    scan = "s.tool IN ('scan_prompt', 'scan_response')"
    return f"""SELECT {extra} request_id, NOT allowed AS blocked,
  CASE WHEN held THEN 'require_approval' WHEN allowed THEN 'allow' ELSE 'block' END AS action,
  CASE WHEN bad THEN t.ttype ELSE '' END AS threat_type, CASE WHEN bad THEN owasp ELSE '' END AS owasp_category,
  CASE WHEN bad THEN severity ELSE '' END AS severity, CASE WHEN bad THEN {bucket('confidence')} ELSE '' END AS confidence,
  CASE WHEN bad THEN guidance ELSE '' END AS guidance,
  CASE WHEN held THEN CASE WHEN {override} THEN {fill(fixed.HOLD_OVERRIDE, threat)} ELSE {q(fixed.HOLD_SAFE)} END
    WHEN allowed THEN {q(fixed.ALLOWED_INSTRUCTION)} ELSE instruction END AS agent_instruction,
  CASE WHEN held THEN CASE WHEN {override} THEN {fill(fixed.HOLD_OVERRIDE_MESSAGE, threat, 'ap_id', minutes)}
      ELSE {fill(fixed.HOLD_SAFE_MESSAGE, 'ap_id', minutes)} END
    WHEN bad THEN tmessage ELSE '' END AS user_message,
  CASE WHEN held THEN ap_id ELSE '' END AS approval_id,
  coalesce(CASE WHEN held THEN ap_policy WHEN bad THEN CASE WHEN {scan} THEN coalesce(nullif(primary_policy, ''), 'Security Policy') ELSE 'Security Policy' END END, '') AS policy_name,
  CASE WHEN bad THEN array_to_string(refs, '|') ELSE '' END AS refs,
  coalesce(CASE WHEN held AND {override} THEN array_to_string(ap_risks, '|') END, '') AS risk_factors,
  coalesce(CASE WHEN held AND {override} THEN ap_threat || '/' || ap_severity || '/' || ap_owasp || '/' || ap_original END, '') AS override_of
FROM (SELECT *, NOT held AND NOT allowed AS bad FROM (
  SELECT s.*, fallback, instruction, NOT held AND coalesce(safe, false) AND (action = 'allow' OR ({scan} AND action = 'redact')) AS allowed
  FROM {source} s JOIN tools USING (tool))) s
LEFT JOIN aliases a ON a.alias = replace(lower(coalesce(nullif(primary_type, ''), fallback)), '-', '_')
LEFT JOIN types t ON t.ttype = coalesce(a.ttype, 'unknown')"""


NO_APPROVAL = """false AS held, '' AS ap_id, 0 AS ap_seconds, '' AS ap_threat, '' AS ap_severity, '' AS ap_owasp,
  '' AS ap_original, '' AS ap_policy, []::VARCHAR[] AS ap_risks"""
