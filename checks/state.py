"""Quotas, health, sessions, approvals and intelligence."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import check, table, values
from checks.results import long
from checks.sqltext import ALIASES, fill, q
from checks.views import APPROVALS, CALLS, FINDINGS, HOT_CALLS, TURNS, duck_view, spark_view
from wardstone.operators import approvals as ap
from wardstone.operators import health, intel, pairing, quota, sessions
from wardstone.operators import verdict as vd
from wardstone.sources import fixed_values as fixed

# Sparse test events: small limits over long periods make every branch happen.
CAP, PERIOD = 2, 86_400_000
MS = "epoch_us(ts) // 1000"


def bucket_ctes(cap: int, period: int, source: str = "calls") -> str:
    full = cap * period
    return f"""ordered AS (SELECT *, {MS} AS ms, row_number() OVER (PARTITION BY key ORDER BY ts, seq) AS rn FROM {source}),
  walk AS (
    SELECT key, seq, rn, ms, {full}::HUGEINT - {period} AS tok, true AS allowed FROM ordered WHERE rn = 1
    UNION ALL
    SELECT key, seq, rn, ms, CASE WHEN t >= {period} THEN t - {period} ELSE t END, t >= {period} FROM (
      SELECT o.key, o.seq, o.rn, o.ms, least({full}::HUGEINT, w.tok + (o.ms - w.ms) * {cap}) AS t
      FROM walk w JOIN ordered o ON o.key = w.key AND o.rn = w.rn + 1))"""


_T1_OUT = f"""SELECT key, seq, allowed, CASE WHEN allowed THEN CAST(tok // {PERIOD} AS BIGINT) ELSE 0 END AS remaining,
  CASE WHEN allowed THEN 0 ELSE CAST(ceil(({PERIOD} - tok) / {CAP}.0) AS BIGINT) END AS retry_after_ms FROM walk"""


@check("t1_token_bucket", "WITH RECURSIVE " + duck_view("calls", CALLS) + ", " + bucket_ctes(CAP, PERIOD) + _T1_OUT)
def t1(spark, d):
    df = quota.token_bucket(spark_view(spark, d, CALLS), "key", "ts", "seq", CAP, PERIOD, 6 * 3_600_000)
    return df.select("key", "seq", "allowed", "remaining", "retry_after_ms")


@check("t1_token_bucket_hot_key", "WITH RECURSIVE " + duck_view("calls", HOT_CALLS) + ", " + bucket_ctes(CAP, PERIOD) + _T1_OUT)
def t1_hot(spark, d):
    df = quota.token_bucket(spark_view(spark, d, HOT_CALLS), "key", "ts", "seq", CAP, PERIOD, 6 * 3_600_000)
    return df.select("key", "seq", "allowed", "remaining", "retry_after_ms")


AS_OF = "2024-01-20 00:00:00"
AS_OF_MS = 1705708800000


@check("t2_remaining_tokens", "WITH RECURSIVE " + duck_view("every", CALLS) + f", calls AS (SELECT * FROM every WHERE {MS} <= {AS_OF_MS}), " + bucket_ctes(CAP, PERIOD) + f"""
  SELECT c.c_custkey AS key, least({CAP}, coalesce((l.tok + ({AS_OF_MS} - l.ms) * {CAP}) // {PERIOD}, {CAP}))::BIGINT AS remaining
  FROM customer c LEFT JOIN (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY key ORDER BY rn DESC) = 1) l ON l.key = c.c_custkey""")
def t2(spark, d):
    keys = table(spark, d, "customer").select(F.col("c_custkey").alias("key"))
    return quota.remaining_tokens(spark_view(spark, d, CALLS), "key", "ts", keys, AS_OF, CAP, PERIOD, 6 * 3_600_000)


@check("t3_idle_eviction", "WITH " + duck_view("calls", CALLS) + f" SELECT key, max({MS}) AS last_ms, {AS_OF_MS} - max({MS}) > 3600000 AS evicted FROM calls WHERE {MS} <= {AS_OF_MS} GROUP BY key")
def t3(spark, d):
    return quota.idle_keys(spark_view(spark, d, CALLS), "key", "ts", AS_OF)


@check("a10_quota_statistics", "WITH " + duck_view("calls", CALLS) + f" SELECT count(*) AS active_keys, 100 AS capacity FROM (SELECT key FROM calls WHERE {MS} <= {AS_OF_MS} GROUP BY key HAVING {AS_OF_MS} - max({MS}) <= 3600000)")
def a10(spark, d):
    return quota.quota_statistics(spark_view(spark, d, CALLS), "key", "ts", AS_OF)


TIERED = """SELECT user_id AS key, ts, CASE user_id % 4 WHEN 0 THEN 'anonymous' WHEN 1 THEN 'community' WHEN 2 THEN 'pro' ELSE 'enterprise' END AS tier FROM {events}"""


@check("a11_tier_audit", "WITH " + duck_view("calls", TIERED) + ", " + values("tiers", ["tier", "deepest", "per_minute", "per_month"], fixed.TIERS) + """,
  m AS (SELECT key, tier, date_trunc('minute', ts) AS mi, count(*) AS n FROM calls GROUP BY ALL),
  mo AS (SELECT key, tier, date_trunc('month', mi) AS month, CAST(sum(n) AS BIGINT) AS calls, max(n) AS busiest_minute FROM m GROUP BY ALL)
  SELECT key, tier, strftime(month, '%Y-%m') AS month, calls, busiest_minute, coalesce(calls > per_month, false) AS over_month,
    coalesce(busiest_minute > per_minute, false) AS over_minute FROM mo JOIN tiers USING (tier)""")
def a11(spark, d):
    df = quota.tier_audit(spark_view(spark, d, TIERED), "key", "ts", "tier")
    return df.withColumn("month", F.date_format("month", "yyyy-MM"))


FAILS, GOODS, OPEN_FOR = 2, 2, 43_200_000


def health_sql(view: str) -> str:
    return "WITH RECURSIVE " + duck_view("calls", view) + f""", ordered AS (SELECT *, {MS} AS ms, row_number() OVER (PARTITION BY key ORDER BY {MS}, seq) AS rn FROM calls),
  walk AS (
    SELECT key, 0::BIGINT AS rn, NULL::BIGINT AS seq, 0::BIGINT AS ms, '' AS met, true AS admitted, 'closed' AS mode, 0 AS bad, 0 AS good, 0::BIGINT AS opened
    FROM ordered WHERE rn = 1
    UNION ALL
    SELECT key, rn, seq, ms, met, met <> 'open',
      CASE met WHEN 'open' THEN 'open' WHEN 'closed' THEN CASE WHEN failed AND bad + 1 >= {FAILS} THEN 'open' ELSE 'closed' END
        ELSE CASE WHEN failed THEN 'open' WHEN good + 1 >= {GOODS} THEN 'closed' ELSE 'half_open' END END,
      CASE met WHEN 'open' THEN bad WHEN 'closed' THEN CASE WHEN failed THEN bad + 1 ELSE 0 END
        ELSE CASE WHEN NOT failed AND good + 1 >= {GOODS} THEN 0 ELSE bad END END,
      CASE met WHEN 'open' THEN good WHEN 'closed' THEN CASE WHEN failed THEN good ELSE good + 1 END
        ELSE CASE WHEN failed OR good + 1 >= {GOODS} THEN 0 ELSE good + 1 END END,
      CASE WHEN met = 'open' THEN opened WHEN failed AND (met = 'half_open' OR bad + 1 >= {FAILS}) THEN ms ELSE opened END
    FROM (SELECT o.key, o.rn, o.seq, o.ms, o.failed, w.bad, w.good, w.opened,
        CASE WHEN w.mode = 'open' AND o.ms - w.opened >= {OPEN_FOR} THEN 'half_open' ELSE w.mode END AS met
      FROM walk w JOIN ordered o ON o.key = w.key AND o.rn = w.rn + 1))
  SELECT key, seq, ms, met, admitted, mode FROM walk WHERE rn > 0"""


@check("t4_health_timeline", health_sql(CALLS))
def t4(spark, d):
    return health.health_timeline(spark_view(spark, d, CALLS), "key", "ts", "seq", "failed", FAILS, GOODS, OPEN_FOR, 6 * 3_600_000)


@check("t4_health_timeline_hot_source", health_sql(HOT_CALLS))
def t4_hot(spark, d):
    return health.health_timeline(spark_view(spark, d, HOT_CALLS), "key", "ts", "seq", "failed", FAILS, GOODS, OPEN_FOR, 6 * 3_600_000)


IDLE = 7200
SESSION_SQL = f"""tagged AS (SELECT key, {MS} AS ms, event_type, CAST(round((seq % 100) / 100.0 * 1000) AS BIGINT) AS mr, seq FROM calls),
  eras AS (SELECT t.*, (SELECT count(*) FROM tagged r WHERE r.event_type = 'signup' AND r.key = t.key AND r.ms <= t.ms) AS era FROM tagged t WHERE event_type <> 'signup'),
  gaps AS (SELECT *, CASE WHEN ms - lag(ms) OVER w < {IDLE} * 1000 AND era = lag(era) OVER w THEN 0 ELSE 1 END AS st FROM eras WINDOW w AS (PARTITION BY key ORDER BY ms, seq)),
  numbered AS (SELECT *, CAST(sum(st) OVER (PARTITION BY key ORDER BY ms, seq) AS BIGINT) AS session_no FROM gaps),
  built AS (SELECT key, session_no, min(ms) AS first_ms, max(ms) AS last_ms, count(*) AS turns, CAST(sum(mr) AS BIGINT) / 1000 AS risk FROM numbered GROUP BY ALL)"""


def built_sessions(spark, d, view):
    calls = spark_view(spark, d, view)
    turns = calls.filter("event_type <> 'signup'").withColumn("risk", (F.col("seq") % 100) / 100)
    return sessions.sessions(turns, "key", "ts", "risk", calls.filter("event_type = 'signup'"), IDLE)


@check("t5_sessions", "WITH " + duck_view("calls", HOT_CALLS) + ", " + SESSION_SQL + " SELECT * FROM built")
def t5(spark, d):
    return built_sessions(spark, d, HOT_CALLS)


@check("a9_session_statistics", "WITH " + duck_view("calls", HOT_CALLS) + ", " + SESSION_SQL + f""" SELECT count(*) AS active_sessions, CAST(coalesce(sum(turns), 0) AS BIGINT) AS turns_tracked,
  count(*) FILTER (WHERE risk >= 1) AS high_risk_sessions, coalesce(round(avg(risk), 6), 0) AS avg_risk FROM built WHERE {AS_OF_MS} - last_ms < {IDLE} * 1000""")
def a9(spark, d):
    return sessions.session_statistics(built_sessions(spark, d, HOT_CALLS), AS_OF_MS, 1.0, IDLE)


CREATED, DECIDED = "epoch_us(created_at) // 1000", "epoch_us(decided_at) // 1000"
_REFUSED = f"""code AS (SELECT *, CASE WHEN decision IS NULL THEN 'NONE' WHEN decided_via = 'scanner' THEN 'SCANNER_ROUTE_DENIED' WHEN coalesce(severity, '') NOT IN ('low', 'medium') AND coalesce(decided_via, '') <> 'dashboard' THEN 'DASHBOARD_REQUIRED'
  WHEN severity IN ('low', 'medium') AND coalesce(decided_via, '') <> 'dashboard' AND {DECIDED} - {CREATED} < 60000 THEN 'COOLDOWN_ACTIVE' WHEN decider IS NULL OR decider = requester THEN 'SELF_APPROVAL_BLOCKED'
  WHEN {DECIDED} - {CREATED} >= 1800000 THEN 'EXPIRED' ELSE '' END AS refusal FROM a)"""
_STATES = _REFUSED + f""", states AS (SELECT approval_id, status, CASE WHEN status = 'pending' THEN CAST(ceil(({CREATED} + 1800000 - {AS_OF_MS}) / 1000.0) AS BIGINT) ELSE 0 END AS expires_in_seconds,
   CASE WHEN counts THEN justification END AS justification FROM (
   SELECT *, refusal = '' AND {DECIDED} <= {AS_OF_MS} AS counts, CASE WHEN cancelled THEN 'cancelled' WHEN refusal = '' AND {DECIDED} <= {AS_OF_MS} THEN decision
     WHEN {CREATED} + 1800000 - {AS_OF_MS} <= 0 THEN 'expired' ELSE 'pending' END AS status FROM code WHERE {CREATED} <= {AS_OF_MS}))"""


def ledger(spark, d):
    a = spark_view(spark, d, APPROVALS)
    requests = a.select("approval_id", "requester", "created_at", "severity", "cancelled")
    decisions = a.filter("decision IS NOT NULL").select("approval_id", "decision", "decided_at", "decider", "decided_via", "justification")
    return requests, decisions


@check("t6_j6_approval_states", "WITH " + duck_view("a", APPROVALS) + ", " + _STATES + " SELECT approval_id, status, expires_in_seconds, coalesce(justification, '') AS justification FROM states")
def t6(spark, d):
    df = ap.approval_states(*ledger(spark, d), AS_OF)
    return df.withColumn("justification", F.coalesce("justification", F.lit("")))


@check("t6_decision_refusals", "WITH " + duck_view("a", APPROVALS) + ", " + _REFUSED + " SELECT approval_id, refusal FROM code WHERE refusal <> 'NONE'")
def t6_refusals(spark, d):
    return ap.decision_refusals(*ledger(spark, d)).select("approval_id", F.coalesce("refusal", F.lit("")).alias("refusal"))


_VERDICT_COLS = ["threat_type", "owasp_category", "severity", "confidence", "guidance", "agent_instruction", "user_message"]


def plain(df, *carry):
    return df.select(*carry, "blocked", "action", *[F.coalesce(c, F.lit("")).alias(c) for c in _VERDICT_COLS])


_STATUS = values("texts", ["status", "blocked", "action", "severity", "guidance", "instruction", "message"], fixed.STATUS_TEXTS)
_ODD = "(SELECT * REPLACE (CASE WHEN approval_id LIKE '%3' THEN 'weird' ELSE status END AS status) FROM states)"
_MIN = "CAST(CAST(ceil(expires_in_seconds / 60.0) AS BIGINT) AS VARCHAR)"


@check("v9_status_verdict", "WITH " + duck_view("a", APPROVALS) + ", " + _STATES + ", " + _STATUS + f"""
  SELECT approval_id, coalesce(blocked, true) AS blocked, coalesce(action, 'require_approval') AS action, CASE WHEN blocked THEN 'unknown' ELSE '' END AS threat_type,
   CASE WHEN blocked THEN 'N/A' ELSE '' END AS owasp_category, coalesce(severity, '') AS severity, CASE WHEN blocked THEN 'high' ELSE '' END AS confidence,
   coalesce(guidance || CASE WHEN s.status = 'rejected' THEN coalesce(' Reason: ' || nullif(justification, ''), '') ELSE '' END, '') AS guidance,
   CASE WHEN action IS NULL THEN {fill(fixed.PENDING_INSTRUCTION, _MIN)} ELSE instruction END AS agent_instruction,
   coalesce(CASE WHEN action IS NULL THEN {fill(fixed.PENDING_MESSAGE, _MIN)} WHEN s.status = 'rejected' THEN message || coalesce(' Reason: ' || nullif(justification, ''), {q(fixed.NO_REASON_HINT)}) ELSE message END, '') AS user_message
  FROM {_ODD} s LEFT JOIN texts USING (status)""")
def v9(spark, d):
    df = ap.approval_states(*ledger(spark, d), AS_OF)
    df = df.withColumn("status", F.when(F.col("approval_id").endswith("3"), "weird").otherwise(F.col("status")))
    return plain(ap.status_verdicts(df), "approval_id")


_REF = values("ref", ["refusal", "owasp", "rsev", "rguid", "rinstr", "rmsg"], fixed.REFUSALS)


@check("v10_decision_outcome", "WITH " + duck_view("a", APPROVALS) + ", " + _REFUSED + ", " + _REF + f""", x AS (SELECT *, refusal <> '' AS failed, 'refused: ' || refusal AS msg FROM code LEFT JOIN ref USING (refusal) WHERE refusal <> 'NONE')
  SELECT approval_id, failed OR decision = 'rejected' AS blocked, CASE WHEN failed OR decision = 'rejected' THEN 'block' ELSE 'allow' END AS action,
   CASE WHEN failed THEN 'scan_error' WHEN decision = 'rejected' THEN 'unknown' ELSE '' END AS threat_type,
   CASE WHEN owasp IS NOT NULL THEN owasp WHEN failed OR decision = 'rejected' THEN 'N/A' ELSE '' END AS owasp_category,
   CASE WHEN owasp IS NOT NULL THEN rsev WHEN failed OR decision = 'rejected' THEN 'medium' ELSE '' END AS severity,
   CASE WHEN failed OR decision = 'rejected' THEN 'high' ELSE '' END AS confidence,
   CASE WHEN owasp IS NOT NULL THEN coalesce(rguid, msg) WHEN failed THEN msg WHEN decision = 'rejected' THEN 'Action rejected.' || coalesce(' Reason: ' || nullif(justification, ''), '') ELSE '' END AS guidance,
   CASE WHEN owasp IS NOT NULL THEN rinstr WHEN failed THEN {fill(fixed.APPROVAL_ERROR_INSTRUCTION, 'msg')} WHEN decision = 'rejected' THEN {q(fixed.DECIDED_REJECTED_INSTRUCTION)} ELSE {q(fixed.DECIDED_APPROVED_INSTRUCTION)} END AS agent_instruction,
   CASE WHEN owasp IS NOT NULL THEN replace(rmsg, '%s', msg) WHEN failed THEN {fill(fixed.APPROVAL_ERROR_MESSAGE, 'msg')} WHEN decision = 'rejected' THEN {q(fixed.DECIDED_REJECTED_MESSAGE)} || coalesce(' Reason: ' || nullif(justification, ''), {q(fixed.NO_REASON_HINT)}) ELSE '' END AS user_message
  FROM x""")
def v10(spark, d):
    df = ap.decision_refusals(*ledger(spark, d))
    df = df.withColumn("error_code", F.col("refusal")).withColumn("error_message", F.concat(F.lit("refused: "), "refusal"))
    return plain(ap.decision_outcomes(df), "approval_id")


_REPEATS = "(SELECT event_id, event_id % 7 AS what, {MS} AS ms FROM a)"


def _dedup_sql(what: str) -> str:
    return "WITH RECURSIVE " + duck_view("a", APPROVALS) + f""", ordered AS (SELECT event_id, {what} AS what, epoch_us(created_at) // 1000 AS ms,
    row_number() OVER (PARTITION BY {what} ORDER BY epoch_us(created_at) // 1000, event_id) AS rn FROM a),
  walk AS (SELECT what, rn, event_id, ms AS opened, false AS duplicate FROM ordered WHERE rn = 1
    UNION ALL SELECT o.what, o.rn, o.event_id, CASE WHEN o.ms - w.opened >= 14400000 THEN o.ms ELSE w.opened END, o.ms - w.opened < 14400000
    FROM walk w JOIN ordered o ON o.what = w.what AND o.rn = w.rn + 1) SELECT event_id, duplicate FROM walk"""


@check("t7_approval_dedup", _dedup_sql("event_id % 7"))
def t7(spark, d):
    a = spark_view(spark, d, APPROVALS).withColumn("hash", ap.content_hash(F.lit("action"), (F.col("event_id") % 7).cast("string")))
    return ap.distinct_requests(a, "hash", "created_at", "event_id", 14_400).select("event_id", "duplicate")


@check("t7_approval_dedup_hot_content", _dedup_sql("CASE WHEN event_id % 20 < 17 THEN 0 ELSE event_id % 20 END"))
def t7_hot(spark, d):
    what = F.when(F.col("event_id") % 20 < 17, 0).otherwise(F.col("event_id") % 20)
    a = spark_view(spark, d, APPROVALS).withColumn("hash", ap.content_hash(F.lit("action"), what.cast("string")))
    return ap.distinct_requests(a, "hash", "created_at", "event_id", 14_400).select("event_id", "duplicate")


@check("j4_turn_pairs", "SELECT conv_id, turn, length(response) AS response_chars, length(prompt) AS prompt_chars, prompt_role FROM (SELECT conv_id, turn, role, text AS response, lag(text) OVER w AS prompt, lag(role) OVER w AS prompt_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'assistant' AND prompt IS NOT NULL")
def j4(spark, d):
    df = pairing.pair_turns(table(spark, d, "conversations"), "conv_id", "turn", "role", "text")
    return df.select("conv_id", "turn", long(F.length("response")).alias("response_chars"), long(F.length("prompt")).alias("prompt_chars"), "prompt_role")


@check("j4_turn_pairs_with_gaps", "SELECT conv_id, turn, length(prompt) AS prompt_chars FROM (SELECT conv_id, turn, role, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prompt FROM conversations WHERE turn <> 1) WHERE role = 'assistant' AND prompt IS NOT NULL")
def j4_gaps(spark, d):
    df = pairing.pair_turns_with_gaps(table(spark, d, "conversations").filter("turn <> 1"), "conv_id", "turn", "role", "text")
    return df.select("conv_id", "turn", long(F.length("prompt")).alias("prompt_chars"))


_INTEL_SQL = "WITH " + duck_view("findings", FINDINGS) + ", " + ALIASES + """, f AS (SELECT coalesce(a.ttype, 'unknown') AS category, nullif(pattern, '') AS pattern, confidence, ts
  FROM findings LEFT JOIN aliases a ON alias = replace(lower(findings.threat_type), '-', '_'))"""


@check("a8_intel_coverage", _INTEL_SQL + f""" SELECT category, count(DISTINCT pattern) AS pattern_count, count(*) AS detections, round(avg(confidence), 6) AS avg_confidence,
  max({MS}) AS last_updated_ms FROM f GROUP BY category""")
def a8(spark, d):
    return intel.coverage(intel.categorised(spark_view(spark, d, FINDINGS), "threat_type"))


@check("a8_intel_patterns", _INTEL_SQL + " SELECT category, pattern, count(*) AS hit_count, round(avg(confidence), 6) AS avg_confidence, count(*) >= 20 AS active FROM f WHERE pattern IS NOT NULL GROUP BY ALL")
def a8_patterns(spark, d):
    return intel.pattern_hits(intel.categorised(spark_view(spark, d, FINDINGS), "threat_type"), 20)


@check("a8_intel_summary", _INTEL_SQL + """, p AS (SELECT category, pattern, count(*) AS n FROM f WHERE pattern IS NOT NULL GROUP BY ALL)
  SELECT (SELECT count(*) FROM p WHERE n >= 20) AS active_patterns, (SELECT count(*) FROM p WHERE n < 20) AS candidate_patterns, (SELECT count(*) FROM f) AS total_detections,
   (SELECT round(avg(confidence), 6) FROM f) AS avg_confidence, (SELECT count(DISTINCT category) FROM f) AS n_categories""")
def a8_summary(spark, d):
    return intel.statistics(intel.categorised(spark_view(spark, d, FINDINGS), "threat_type"), 20)
