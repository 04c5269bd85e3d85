"""Redaction and catalogue checks."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from checks.base import check, quote, table, values
from checks.views import PROBE, TURNS, duck_view, spark_view
from wardstone.operators import redact
from wardstone.sources import catalogue
from wardstone.sources import fixed_values as fixed

_SPACE_RE2 = (
    r"\t\n\x{0B}\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
)


def re2(pattern: str, nocase: bool) -> str:
    """A detector for RE2: only the white-space class needs spelling out."""
    out, in_class = [], False
    for tok in re.findall(r"\\.|\[\^?|\]|.", pattern):
        if tok.startswith("["):
            in_class = True
        elif tok == "]":
            in_class = False
        elif tok == r"\s":
            tok = _SPACE_RE2 if in_class else f"[{_SPACE_RE2}]"
        out.append(tok)
    return ("(?i)" if nocase else "") + "".join(out)


def span_ctes(source: str, key: str, text: str, detectors=None, tag: str = "") -> str:
    """CTEs spans -> kept -> numbered -> redacted for a source relation, written with row windows."""
    detectors = fixed.DETECTORS if detectors is None else detectors
    cat = values(
        f"cat{tag}",
        ["priority", "type", "prefix", "pattern"],
        [(i, n, p, re2(x, c)) for i, (n, p, c, x) in enumerate(detectors)],
    )
    raw = " UNION ALL ".join(
        f"SELECT {key} AS id, {text} AS t, {i} AS priority, regexp_extract_all({text}, {quote(re2(x, c))}) AS m, "
        f"regexp_split_to_array({text}, {quote(re2(x, c))}) AS g FROM {source}"
        for i, (n, p, c, x) in enumerate(detectors)
    )
    return f"""{cat},
raw{tag} AS ({raw}),
hit{tag} AS (SELECT id, priority, unnest(m) AS original, unnest(g[1:len(m)]) AS gap, unnest(range(len(m))) AS k
  FROM raw{tag} WHERE len(m) > 0),
placed{tag} AS (SELECT id, priority, original,
    CAST(sum(length(gap)) OVER w + coalesce(sum(length(original)) OVER (PARTITION BY id, priority ORDER BY k
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s
  FROM hit{tag} WINDOW w AS (PARTITION BY id, priority ORDER BY k)),
spans{tag} AS (SELECT id, priority, original, s, s + length(original) AS e, type, prefix,
    row_number() OVER (PARTITION BY id ORDER BY s, priority) AS rn
  FROM placed{tag} JOIN cat{tag} USING (priority)),
walk{tag} AS (
  SELECT id, rn, e AS last, true AS keep FROM spans{tag} WHERE rn = 1
  UNION ALL
  SELECT n.id, n.rn, CASE WHEN n.s >= w.last THEN n.e ELSE w.last END, n.s >= w.last
  FROM walk{tag} w JOIN spans{tag} n ON n.id = w.id AND n.rn = w.rn + 1),
kept{tag} AS (SELECT x.*, row_number() OVER (PARTITION BY x.id, prefix ORDER BY s) AS n,
    coalesce(lag(e) OVER (PARTITION BY x.id ORDER BY s), 0) AS prev
  FROM spans{tag} x JOIN walk{tag} USING (id, rn) WHERE keep),
pieces{tag} AS (SELECT k.*, '[' || prefix || '_' || n || ']' AS token FROM kept{tag} k),
redacted{tag} AS (SELECT {key} AS id, {text} AS t,
    CASE WHEN p.n IS NULL THEN {text} ELSE p.body || substr({text}, p.last + 1) END AS redacted_text,
    coalesce(p.n, 0) AS redaction_count, coalesce(p.entries, '') AS entries
  FROM {source} x LEFT JOIN (
    SELECT c.id, count(*) AS n, max(c.e) AS last,
      string_agg(substr(r.t, c.prev + 1, c.s - c.prev) || token, '' ORDER BY c.s) AS body,
      string_agg(token || '=' || type || '@' || c.s || ':' || original, ';' ORDER BY c.s) AS entries
    FROM pieces{tag} c JOIN (SELECT {key} AS id, {text} AS t FROM {source}) r USING (id) GROUP BY c.id
  ) p ON p.id = x.{key})"""


def entry_text(col: str = "redactions"):
    """Entries as one string, for comparing."""
    return F.array_join(
        F.transform(
            col,
            lambda r: F.concat(
                r["token"], F.lit("="), r["type"], F.lit("@"), r["position"].cast("string"), F.lit(":"), r["original"]
            ),
        ),
        ";",
    )


DOCS = "WITH RECURSIVE " + span_ctes("documents", "doc_id", "text")
PROBES = "WITH RECURSIVE " + duck_view("probe", PROBE) + ", " + span_ctes("probe", "row_id", "text")


def documents(spark, d):
    return table(spark, d, "documents", "doc_id", "text")


@check("r1_spans", DOCS + "SELECT id AS doc_id, s AS span_start, e AS span_end, type, original, priority FROM spans")
def r1(spark, d):
    df = redact.find_spans(documents(spark, d), "text")
    return df.select("doc_id", F.inline("spans")).select(
        "doc_id", F.col("start").cast("long").alias("span_start"), F.col("end").cast("long").alias("span_end"),
        "type", "original", F.col("priority").cast("long").alias("priority"),
    )


@check("r2_overlaps", PROBES + """SELECT id AS row_id, count(*) AS n_spans,
  count(*) FILTER (WHERE keep) AS n_kept, string_agg(CASE WHEN keep THEN type || '@' || s END, ',' ORDER BY s, priority) AS kept
  FROM spans JOIN walk USING (id, rn) GROUP BY id""")
def r2(spark, d):
    df = redact.find_spans(spark_view(spark, d, PROBE), "text").filter(F.size("spans") > 0)
    df = df.withColumn("kept", redact.resolve_overlaps(F.col("spans")))
    return df.select(
        "row_id", F.size("spans").cast("long").alias("n_spans"), F.size("kept").cast("long").alias("n_kept"),
        F.array_join(F.transform("kept", lambda s: F.concat(s["type"], F.lit("@"), s["start"].cast("string"))), ",").alias("kept"),
    )


@check("r3_token_numbers", PROBES + "SELECT id AS row_id, token, type, s AS position, original FROM pieces")
def r3(spark, d):
    df = redact.redact_pii(spark_view(spark, d, PROBE), "text")
    return df.select("row_id", F.inline("redactions")).select(
        "row_id", "token", "type", F.col("position").cast("long").alias("position"), "original"
    )


@check("r4_rebuilt_text", PROBES + "SELECT id AS row_id, redacted_text, redaction_count FROM redacted")
def r4(spark, d):
    df = redact.redact_pii(spark_view(spark, d, PROBE), "text")
    return df.select("row_id", "redacted_text", F.col("redaction_count").cast("long").alias("redaction_count"))


@check("r5_redact_documents", DOCS + """SELECT id AS doc_id, redacted_text, redaction_count, true AS pii_detected, entries
  FROM redacted WHERE redaction_count > 0""")
def r5(spark, d):
    df = redact.redact_pii(documents(spark, d), "text")
    return df.filter("pii_detected").select(
        "doc_id", "redacted_text", F.col("redaction_count").cast("long").alias("redaction_count"), "pii_detected",
        entry_text().alias("entries"),
    )


@check("r6_summary", DOCS + "SELECT id AS doc_id, type, count(*) AS n FROM pieces GROUP BY ALL")
def r6(spark, d):
    df = redact.redact_pii(documents(spark, d), "text")
    return df.select("doc_id", F.explode(redact.summary_map(F.col("redactions"))).alias("type", "n"))


@check("r6_summary_by_source", DOCS + """SELECT d.source, d.lang, type, count(*) AS n, count(DISTINCT d.doc_id) AS n_docs
  FROM pieces p JOIN documents d ON d.doc_id = p.id GROUP BY ALL""")
def r6_source(spark, d):
    df = table(spark, d, "documents", "doc_id", "text", "source", "lang")
    df = redact.redact_pii(df, "text")
    # Counts per document come first, so distinct documents are a plain count afterwards.
    per_doc = df.select("source", "lang", F.explode(redact.summary_map(F.col("redactions"))).alias("type", "k"))
    return per_doc.groupBy("source", "lang", "type").agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("n_docs"))


TURN_TOKENS = """, pairs AS (SELECT conv_id * 1000 + turn AS row_id, text AS response,
    lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prompt, role FROM turns),
  asked AS (SELECT row_id, response, prompt FROM pairs WHERE role = 'assistant' AND prompt IS NOT NULL)"""


def paired_turns(spark, d):
    from wardstone.operators.pairing import pair_turns

    df = pair_turns(spark_view(spark, d, TURNS), "conv_id", "turn", "role", "text")
    return df.select((F.col("conv_id") * 1000 + F.col("turn")).alias("row_id"), "response", "prompt")


ASKED = "WITH RECURSIVE " + duck_view("turns", TURNS) + TURN_TOKENS + ", " + span_ctes("asked", "row_id", "prompt")
_FOLD = """, folded AS (
  SELECT a.row_id, 0 AS i, a.response AS r, a.prompt AS p FROM asked a
  UNION ALL
  SELECT f.row_id, f.i + 1, {r}, {p} FROM folded f
  JOIN (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s) AS i FROM pieces) x ON x.id = f.row_id AND x.i = f.i + 1),
  done AS (SELECT row_id, arg_max(r, i) AS r, arg_max(p, i) AS p FROM folded GROUP BY row_id)"""


@check("r7_rehydrate", ASKED + _FOLD.format(r="replace(f.r, x.token, x.original)", p="f.p")
       + "SELECT row_id, r AS rehydrated_response FROM done")
def r7(spark, d):
    df = redact.redact_pii(paired_turns(spark, d), "prompt")
    return df.select("row_id", redact.rehydrate(F.col("response"), F.col("redactions")).alias("rehydrated_response"))


@check("r8_mask_tokens", ASKED + _FOLD.format(r="replace(f.r, x.token, '[REDACTED]')", p="f.p")
       + "SELECT row_id, r AS masked_response FROM done")
def r8(spark, d):
    df = redact.redact_pii(paired_turns(spark, d), "prompt")
    return df.select("row_id", redact.mask_tokens(F.col("response"), F.col("redactions")).alias("masked_response"))


@check("r9_mask_tokens_and_originals", ASKED + _FOLD.format(
    r="replace(replace(f.r, x.token, '[REDACTED]'), x.original, '[REDACTED]')",
    p="replace(replace(f.p, x.token, '[REDACTED]'), x.original, '[REDACTED]')",
) + "SELECT row_id, r AS masked_response, p AS masked_prompt FROM done")
def r9(spark, d):
    df = redact.redact_pii(paired_turns(spark, d), "prompt")
    mask = redact.mask_tokens_and_originals
    return df.select(
        "row_id", mask(F.col("response"), F.col("redactions")).alias("masked_response"),
        mask(F.col("prompt"), F.col("redactions")).alias("masked_prompt"),
    )


TWO_TEXTS = PROBE.replace("o_custkey, o_orderpriority\n", "CASE o_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'reply to c' || CAST(o_custkey AS STRING) || '@d.org' ELSE 'none' END AS context\n")


@check("r10_merge_content_context", "WITH RECURSIVE " + duck_view("two", TWO_TEXTS) + ", "
       + span_ctes("two", "row_id", "text", tag="_c") + ", " + span_ctes("two", "row_id", "context", tag="_x") + """
  SELECT c.id AS row_id, c.redacted_text AS redacted_content, coalesce(x.redacted_text, '') AS redacted_context,
    c.redaction_count + x.redaction_count AS redaction_count,
    c.entries || CASE WHEN c.entries <> '' AND x.entries <> '' THEN ';' ELSE '' END || x.entries AS entries,
    c.redaction_count + x.redaction_count > 0 AS pii_detected
  FROM redacted_c c JOIN redacted_x x USING (id)""")
def r10(spark, d):
    df = redact.redact_request(spark_view(spark, d, TWO_TEXTS), "text", "context")
    return df.select(
        "row_id", "redacted_content", "redacted_context", F.col("redaction_count").cast("long").alias("redaction_count"),
        entry_text().alias("entries"), "pii_detected",
    )


_SWAP = [("test_iban", "IBAN", False, r"\b[A-Z]{2}\d{2}[A-Z0-9]{4,30}\b"), ("priority_word", "WORD", True, r"\b[1-5]-[a-z]+\b")]
SWAPPED = """SELECT row_id, text || ' GB29' || lpad(CAST(o_custkey AS STRING), 10, 'N') || ' ' || o_orderpriority AS text FROM {base}"""


@check("r11_catalogue_swap", "WITH RECURSIVE " + duck_view("probe", PROBE) + ", swapped AS ("
       + SWAPPED.format(base="probe").replace("STRING", "VARCHAR") + "), " + span_ctes("swapped", "row_id", "text", _SWAP)
       + "SELECT id AS row_id, redacted_text, redaction_count, 2 AS catalogue_size FROM redacted")
def r11(spark, d):
    cat = catalogue.custom_catalogue([(n, p, x, c) for n, p, c, x in _SWAP])
    df = spark.sql(SWAPPED, base=spark_view(spark, d, PROBE))
    df = redact.redact_pii(df, "text", cat)
    return df.select("row_id", "redacted_text", F.col("redaction_count").cast("long").alias("redaction_count"),
                     F.lit(len(cat)).alias("catalogue_size"))


@check("r12_roundtrip", "SELECT count(*) AS n_texts, 0 AS n_failed FROM documents")
def r12(spark, d):
    df = redact.redact_pii(documents(spark, d), "text")
    back = redact.rehydrate(F.col("redacted_text"), F.col("redactions"))
    return df.select((back == F.col("text")).alias("same")).agg(
        F.count(F.lit(1)).alias("n_texts"), F.count_if(~F.col("same")).alias("n_failed"))


@check("s2_catalogue_usage", DOCS + """SELECT c.priority, c.type AS name, c.prefix, count(p.id) AS n_hits,
  count(DISTINCT p.id) AS n_docs FROM cat c LEFT JOIN pieces p ON p.type = c.type GROUP BY ALL""")
def s2(spark, d):
    per_doc = redact.redact_pii(documents(spark, d), "text").select(
        F.explode(redact.summary_map(F.col("redactions"))).alias("name", "k"))
    used = per_doc.groupBy("name").agg(F.sum("k").alias("n_hits"), F.count(F.lit(1)).alias("n_docs"))
    return catalogue.catalogue_table(spark).join(used, "name", "left").select(
        F.col("priority").cast("long").alias("priority"), "name", "prefix",
        F.coalesce("n_hits", F.lit(0)).alias("n_hits"), F.coalesce("n_docs", F.lit(0)).alias("n_docs"))


REMOTE = """
SELECT p_partkey AS ordinal,
  CASE WHEN p_partkey % 3 = 0 THEN '(?i)' ELSE '' END || p_name || CAST(p_size AS STRING) AS pattern,
  CASE p_partkey % 8 WHEN 0 THEN 'pii_ssn' WHEN 1 THEN 'pii_iban' WHEN 2 THEN 'pii_new_kind' WHEN 3 THEN 'pii_phone_intl'
    WHEN 4 THEN 'ssn' WHEN 5 THEN 'pii_tin' WHEN 6 THEN 'pii_email' ELSE 'pii_ein' END AS threat_type,
  CASE WHEN p_size % 9 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / 100 END AS confidence
FROM {part}
"""


@check("s3_sync_catalogue", "WITH " + duck_view("remote", REMOTE) + ", " + values("map", ["threat_type", "prefix"], fixed.REMOTE_PREFIXES) + """,
  named AS (SELECT *, regexp_replace(threat_type, '^pii_', '') AS name FROM remote),
  firsts AS (SELECT name, coalesce(confidence, 0) AS first_confidence FROM named
    QUALIFY row_number() OVER (PARTITION BY name ORDER BY ordinal) = 1)
  SELECT n.ordinal, n.name, m.prefix, CASE WHEN starts_with(pattern, '(?i)') THEN substr(pattern, 5) ELSE pattern END AS pattern,
    f.first_confidence FROM named n JOIN map m USING (threat_type) JOIN firsts f USING (name)""")
def s3(spark, d):
    df = catalogue.usable_remote(spark_view(spark, d, REMOTE))
    return df.orderBy(F.desc("first_confidence"), "ordinal")


@check("o2_catalogue_order", "WITH " + duck_view("remote", REMOTE) + ", " + values("map", ["threat_type", "prefix"], fixed.REMOTE_PREFIXES) + """,
  named AS (SELECT *, regexp_replace(threat_type, '^pii_', '') AS name FROM remote),
  firsts AS (SELECT name, coalesce(confidence, 0) AS first_confidence FROM named QUALIFY row_number() OVER (PARTITION BY name ORDER BY ordinal) = 1)
  SELECT n.ordinal, n.name, row_number() OVER (ORDER BY first_confidence DESC, n.ordinal) AS place FROM named n JOIN map m USING (threat_type) JOIN firsts f USING (name)""")
def o2(spark, d):
    return catalogue.ranked_remote(spark_view(spark, d, REMOTE)).select("ordinal", "name", "place")


@check("o1_span_order", PROBES + "SELECT id AS row_id, rn AS place, type, s AS span_start FROM spans")
def o1(spark, d):
    df = redact.find_spans(spark_view(spark, d, PROBE), "text")
    return df.select("row_id", F.posexplode("spans").alias("i", "x")).select(
        "row_id", (F.col("i") + 1).cast("long").alias("place"), "x.type", F.col("x.start").cast("long").alias("span_start"))
