"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstone.llm import chat, decontaminate, hard_negatives, lexical, line_dedup, mtree, near_dedup, packing, simhash, suffix_dedup, surrogates
from wardstone.llm import toxicity, vectors, warc
from wardstone.llm.storage import shared_folder
from wardstone.sources.tables import read_table, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, name, *columns))


_LINES_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
solid AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM lines
  WHERE regexp_matches(line, '[^[:space:]]')),
runs AS (
  SELECT doc_id, i, 2 AS len, line AS a, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM solid
  UNION ALL
  SELECT doc_id, i, 1, line, '' FROM solid WHERE length(line) >= {line_dedup.LONG_LINE}),
later AS (
  SELECT doc_id, i, len FROM (
    SELECT doc_id, i, len, row_number() OVER (PARTITION BY len, a, b ORDER BY doc_id, i) AS rn FROM runs WHERE b IS NOT NULL)
  WHERE rn > 1),
gone AS (SELECT DISTINCT doc_id, i FROM (SELECT doc_id, i FROM later UNION ALL SELECT doc_id, i + 1 FROM later WHERE len = 2)),
marked AS (
  SELECT l.doc_id, l.pos, l.line, s.i IS NOT NULL AS is_solid, g.i IS NOT NULL AS is_gone
  FROM lines l LEFT JOIN solid s ON l.doc_id = s.doc_id AND l.pos = s.pos LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.i = g.i),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT is_gone) AS text,
    CAST(count(*) FILTER (WHERE is_solid) AS INTEGER) AS n_lines, CAST(count(*) FILTER (WHERE is_gone) AS INTEGER) AS n_removed
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS kept_text,
  coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id"""


_NEAR_SQL = """
WITH RECURSIVE lists AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM lists WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
  d.doc_id = coalesce(component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN least l ON l.doc_id = d.doc_id"""


@query("op3_near_dedup", _NEAR_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of near copies, by two-word shingles."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"), width=2)


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity; the folds learned from are those that are not held out."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    out = toxicity.scored(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic")))
    score = F.col("__toxicity.score")
    return out.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
        F.when(score >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"), F.col("__toxicity.passages").alias("passages"),
    )


@query("op6_line_dedup", _LINES_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that stood before."""
    return line_dedup.remove_repeats(_table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", F.inline(F.array("__out")))


@query("op7_benchmark_decontamination")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and the best window."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents", "doc_id", "text"), read_table(spark, sf_dir, "benchmark"))


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.packed(docs, public_tokenizers.path(packing.VOCABULARY))


@query("op9_document_fingerprints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint beside those of its edited text and of the next document."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return simhash.fingerprint_report(docs, F.col("doc_id") % 50 == 0)


_PAGES_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM h WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, h.payload_digest, CASE WHEN f.first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first <> page_id THEN f.first END AS refers_to
FROM h LEFT JOIN f ON h.payload_digest = f.payload_digest"""


@query("op1_warc_salvage", _PAGES_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archives it was written to."""
    folder = f"{shared_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    warc.write_archives(_table(spark, sf_dir, "pages", "page_id", "url", "html"), folder)
    return warc.pages_of(warc.read_archives(spark, folder, with_payload=False))


_CHAT_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(role) + length(text) + {len(chat.OPEN) + 1 + len(chat.CLOSE)}
    + length(role || text) - length(replace(role || text, chr(92), ''))
    + len(regexp_extract_all(role, '{chat.CONTROL_PATTERN}')) + len(regexp_extract_all(text, '{chat.CONTROL_PATTERN}'))
    + length(role) - length(replace(role, chr(10), '')) AS formatted
  FROM turns),
each AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS told,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS learned, sum(formatted) AS formatted_chars
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM each"""


@query("op5_chat_formatting", _CHAT_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as read back from its formatted text."""
    text = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    turns = chat.turn_rows(_table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.formatted(turns.unionByName(chat.turn_rows(more))))


#: The key of this query; users of the operator pass their own.
SURROGATE_KEY = b"registered query"


@query("op2_pii_surrogates")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for its personal data and secrets."""
    out = surrogates.replaced(_table(spark, sf_dir, "documents", "doc_id", "text"), SURROGATE_KEY)
    return out.select("doc_id", "__out.text", "__out.n_entities", "__out.kinds")


@query("op8_suffix_array_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every span of every document that repeats passages which stood before."""
    return suffix_dedup.repeats(_table(spark, sf_dir, "documents", "doc_id", "text"))


def _scaled_sql(by: int) -> str:
    return f"""
v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({by} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""


_TOP_SQL = f"""
WITH {_scaled_sql(1024)},
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 10"""


@query("op11_exact_topk", _TOP_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten vectors with the highest product of every hundredth one."""
    rows = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    rows = rows.where(vectors.whole(F.col("embedding"))).select("vec_id", vectors.scaled(F.col("embedding"), 1024).alias("v"))
    return mtree.top_k(rows, F.col("vec_id") % 100 == 0, 10)


_NEGATIVES_SQL = f"""
WITH {_scaled_sql(256)},
l AS (SELECT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM v WHERE label IS NOT NULL),
scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM l a JOIN l c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM scores WHERE same) WHERE r <= 5),
negatives AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5"""


@query("op12_hard_negatives", _NEGATIVES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    rows = _table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label").where(vectors.whole(F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), vectors.scaled(F.col("embedding"), 256).alias("v"))
    return hard_negatives.mined(rows, F.col("vec_id") % 100 == 0)


_RANKED_SQL = """
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
sizes AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
m AS (SELECT doc_id, 100 - 75 + (75 * n * docs) // terms AS m FROM sizes, s),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term, docs),
it AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY ALL),
scores AS (
  SELECT item_id, tf.doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM it JOIN tf USING (term) JOIN w USING (term) JOIN m ON m.doc_id = tf.doc_id GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 10"""


@query("op13_lexical_search", _RANKED_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return lexical.ranked(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))
