"""The layers of the cascade for the DuckDB twins, computed over every text that the rules alone leave open."""

from __future__ import annotations

from checks.base import values
from checks.pii import re2
from checks.sqltext import q
from wardstone.operators import cascade, screen
from wardstone.sources import rules as packs

_LEXICON = values("lexicon", ["meant"], [(w,) for w in packs.SHUFFLED])
_NAMES = [name for name, _, _ in cascade.LAYERS]


def ciphers(source: str) -> str:
    """Every text of source under each alphabet shift and mirrored: its columns, with the text replaced."""
    up, low = screen._UPPER, screen._LOWER
    alphabets = [up[k:] + up[:k] + low[k:] + low[:k] for k in range(1, 26)] + [up[::-1] + low[::-1]]
    rows = ", ".join(f"({q(x)})" for x in alphabets)
    return f"SELECT s.* REPLACE (translate(s.text, {q(up + low)}, a.alphabet) AS text) FROM {source} s, (VALUES {rows}) a(alphabet)"


def decoded(source: str) -> str:
    """The readable texts in base64 and hexadecimal runs of source."""
    bare = "rtrim(run, '=')"
    whole = f"left({bare}, length({bare}) - CASE WHEN length({bare}) % 4 = 1 THEN 1 ELSE 0 END)"
    padded = f"rpad({whole}, CAST(ceil(length({whole}) / 4.0) * 4 AS INTEGER), '=')"
    return f"""SELECT * FROM (SELECT * EXCLUDE (run, kind) REPLACE (TRY(decode(CASE kind WHEN 'b' THEN from_base64({padded}) ELSE unhex(run) END)) AS text) FROM (
      SELECT *, unnest(regexp_extract_all(text, {q(screen.BASE64_RUN)})) AS run, 'b' AS kind FROM {source}
      UNION ALL SELECT *, unnest(regexp_extract_all(text, {q(screen.HEX_RUN)})), 'h' FROM {source})) WHERE regexp_matches(text, '[A-Za-z]{{3}}')"""


def joined(source: str, text: str = "text", keys: str = "row_id") -> str:
    """Keys and text with spaced-out letters joined: a space goes that stands between two single characters."""
    return f"""SELECT {keys}, string_agg(piece || CASE WHEN following IS NULL THEN '' WHEN regexp_matches(piece, '(^|[^A-Za-z0-9])[A-Za-z0-9@$]$') AND regexp_matches(following, '^[A-Za-z0-9@$]([^A-Za-z0-9]|$)')
      THEN '' ELSE ' ' END, '' ORDER BY i) AS text
    FROM (SELECT *, lead(piece) OVER (PARTITION BY {keys} ORDER BY i) AS following FROM (
      SELECT {keys}, unnest(string_split({text}, ' ')) AS piece, generate_subscripts(string_split({text}, ' '), 1) AS i FROM {source})) GROUP BY {keys}"""


def skeleton(text: str) -> str:
    out = f"translate(regexp_replace({text}, {q(screen.INVISIBLE)}, '', 'g'), {q(cascade.CONFUSABLE)}, {q(cascade.TAKEN_FOR)})"
    for character, several in cascade.LIGATURES:
        out = f"replace({out}, {q(character)}, {q(several)})"
    return out


def crossed(text: str) -> str:
    """Whether direction marks override or are not well nested: matched pairs are struck out until none is left."""
    out = f"translate(array_to_string(regexp_extract_all({text}, {q(screen.BIDI)}), ''), '‪‫‭‮‬⁦⁧⁨⁩', '(((()[[[]')"
    for _ in range(6):
        out = f"regexp_replace({out}, '\\(\\)|\\[\\]', '', 'g')"
    return f"(regexp_matches({text}, '[‭‮]') OR {out} <> '')"


def layered(source: str, parts: list[str], rules, tag: str = "", depth: str = "9", before: str | None = None, enough: float = cascade.ENOUGH) -> str:
    """CTEs found{tag} (row_id, ord, rule_id, type, severity, confidence, action) and decided{tag} (row_id, decided_by)."""
    control = screen.CONTROL.replace("\\x00", "\\x01")
    key = "row_id, loc, depth"

    def hit(i: int, rule, texts: str) -> str:
        unless = f" AND NOT regexp_matches(text, {q(re2(rule.unless, True))})" if rule.unless else ""
        return f"SELECT DISTINCT row_id, loc, layer, {i} AS nth FROM {texts} WHERE regexp_matches(text, {q(re2(rule.pattern, True))}){unless}"

    def rows(first: int, some) -> str:
        return values(f"{'meant0' if first == 0 else 'more'}{tag}", ["nth", "rule_id", "type", "severity", "confidence", "action"], [(first + i, r.rule_id, r.threat_type, r.severity, r.confidence, r.act) for i, r in enumerate(some)])

    more = [cascade.MIXED_SCRIPT, cascade.MALFORMED, cascade.DIRECTION]
    all_parts = " UNION ALL ".join(f"SELECT row_id, {i} AS loc, {depth} AS depth, {c} AS text FROM {source} WHERE {c} IS NOT NULL" for i, c in enumerate(parts))
    plain_hits = " UNION ALL ".join(hit(i, r, f"plain{tag}") for i, r in enumerate(rules))
    deep_hits = " UNION ALL ".join(hit(i, r, f"views{tag}") for i, r in enumerate(rules))
    keyed = f"left(w, 1) || array_to_string(list_sort(string_split(substr(w, 2, length(w) - 2), '')), '') || right(w, 1)"
    at = {name: i for i, name in enumerate(_NAMES)}
    return f"""{rows(0, rules)}, {rows(-3, more)}, {_LEXICON.replace('lexicon(', f'lexicon{tag}(')},
  meant{tag} AS (SELECT * FROM meant0{tag} UNION ALL SELECT * FROM more{tag}),
  plain{tag} AS (SELECT *, 0 AS layer FROM ({all_parts})),
  first{tag} AS MATERIALIZED ({plain_hits}),
  sure{tag} AS (SELECT row_id FROM first{tag} JOIN meant{tag} USING (nth) WHERE confidence >= {enough}{'' if before is None else f' UNION ALL SELECT row_id FROM ({before}) WHERE confidence >= {enough}'}),
  open{tag} AS MATERIALIZED (SELECT {key}, text FROM plain{tag} WHERE row_id NOT IN (SELECT row_id FROM sure{tag})),
  look{tag} AS MATERIALIZED (SELECT {key}, {skeleton('text')} AS text FROM open{tag} WHERE regexp_matches(text, {q(cascade.UNUSUAL)})),
  flat{tag} AS MATERIALIZED (SELECT o.row_id, o.loc, o.depth, coalesce(l.text, o.text) AS text FROM open{tag} o LEFT JOIN look{tag} l USING (row_id, loc)),
  r1{tag} AS MATERIALIZED ({decoded(f'open{tag}')}), r2{tag} AS MATERIALIZED ({decoded(f'r1{tag}')}), r3{tag} AS ({decoded(f'r2{tag}')}),
  spaced{tag} AS (SELECT * FROM flat{tag} WHERE regexp_matches(text, '(^|[^A-Za-z0-9])[A-Za-z0-9@$] [A-Za-z0-9@$]([^A-Za-z0-9]|$)')),
  close{tag} AS ({joined(f'spaced{tag}', keys=key)}),
  leet{tag} AS (SELECT f.row_id, f.loc, f.depth, translate(lower(coalesce(c.text, f.text)), {q(screen.LEET)}, {q(screen.PLAIN)}) AS text FROM flat{tag} f LEFT JOIN close{tag} c USING (row_id, loc)
    WHERE c.row_id IS NOT NULL OR regexp_matches(f.text, {q(screen.LEET_WORD)})),
  words{tag} AS (SELECT {key}, unnest(regexp_extract_all(lower(text), '\\p{{L}}+|\\P{{L}}+')) AS w, generate_subscripts(regexp_extract_all(lower(text), '\\p{{L}}+|\\P{{L}}+'), 1) AS i
    FROM flat{tag} WHERE regexp_matches(text, {q(cascade.shuffled_pattern(packs.SHUFFLED))})),
  keys{tag} AS (SELECT meant AS w, {keyed} AS k FROM (SELECT meant, meant AS w FROM lexicon{tag})),
  right{tag} AS (SELECT {key}, string_agg(coalesce(l.w, t.w), '' ORDER BY i) AS text FROM (SELECT *, CASE WHEN length(w) >= 4 THEN {keyed} END AS k FROM words{tag}) t LEFT JOIN keys{tag} l USING (k) GROUP BY {key}),
  views{tag} AS MATERIALIZED (SELECT row_id, loc, {at['unicode']} AS layer, text FROM look{tag}
    UNION ALL SELECT row_id, loc, {at['malformed']}, regexp_replace(text, {q(control)}, '', 'g') FROM open{tag} WHERE regexp_matches(text, {q(control)})
    UNION ALL SELECT row_id, loc, {at['encoding']}, text FROM (SELECT * FROM r1{tag} UNION ALL SELECT * FROM r2{tag} UNION ALL SELECT * FROM r3{tag})
    UNION ALL SELECT row_id, loc, {at['spelling']}, text FROM (SELECT * FROM leet{tag} UNION ALL SELECT * FROM right{tag})
    UNION ALL SELECT row_id, loc, {at['cipher']}, text FROM ({ciphers(f'open{tag}')})),
  deep{tag} AS ({deep_hits}
    UNION ALL SELECT row_id, loc, {at['unicode']}, -3 FROM open{tag} WHERE regexp_matches(text, {q(cascade.MIXED)})
    UNION ALL SELECT row_id, loc, {at['malformed']}, -2 FROM open{tag} WHERE regexp_matches(text, {q(control)})
    UNION ALL SELECT row_id, loc, {at['visual']}, -1 FROM open{tag} WHERE depth >= 6 AND {crossed('text')}),
  once{tag} AS (SELECT row_id, loc, nth, min(layer) AS layer FROM (SELECT * FROM first{tag} UNION ALL SELECT * FROM deep{tag}) GROUP BY ALL),
  every{tag} AS (SELECT row_id, layer * 100000 + loc * 10000 + 10 + nth AS ord, rule_id, type, severity, confidence, action, layer FROM once{tag} JOIN meant{tag} USING (nth)
    {'' if before is None else f'UNION ALL SELECT *, 0 FROM ({before})'}),
  least{tag} AS (SELECT row_id, min(layer) AS layer FROM every{tag} WHERE confidence >= {enough} GROUP BY row_id),
  found{tag} AS (SELECT e.* EXCLUDE (layer) FROM every{tag} e LEFT JOIN least{tag} l USING (row_id) WHERE e.layer <= coalesce(l.layer, 99)),
  decided{tag} AS (SELECT row_id, [{', '.join(q(n) for n in _NAMES)}][layer + 1] AS decided_by FROM least{tag})"""
