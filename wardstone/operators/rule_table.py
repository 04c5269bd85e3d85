"""Rules of a table, however many, in one pass over each text.

From every pattern come sets of literals of which a match holds one each (``functions.literals``), phrases of several
words among them: texts are searched with whatever stands between words as one space. The literals of all rules are searched at once, as flat tables of their first bytes, so a text is read once whether there are ten rules or a
hundred thousand. A rule is a candidate where each of its sets has a literal in the text; only then its full expression
runs, and only from where its first literal lets a match begin, so a long text is not read once for each candidate.
Patterns without a literal part are tried on every whole text, so their number counts.

That holds for a table of one block of bounded size, which a task holds; nothing is shuffled then. A larger table meets
the texts in a join on literals (``rule_index``); only its patterns without a literal part are still taken in blocks. No
rule is left out. Patterns ignore case, with ASCII word characters and ECMAScript white space.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstone.functions.literals import LOWER, Literals, needed
from wardstone.operators.findings import FINDINGS, no_findings
from wardstone.operators.redact import computed
from wardstone.operators.rule_index import RULE, apply_index, matches, parsed, spaced_bytes
from wardstone.sources.rules import Rule

#: Bytes of patterns in a block of rules, and bytes of text that are looked at together.
BLOCK_BYTES, SPAN = 4 << 20, 1 << 20
#: Sets of literals that are asked for besides the one that makes a rule a candidate.
MORE_SETS = 2
_FIELDS = [f.split(":") for f in FINDINGS.removeprefix("array<struct<").removesuffix(">>").split(",")]
_NAMES = [name for name, _ in _FIELDS]
_RULE = [f.split()[0] for f in RULE.split(", ")]
_KIND = pa.struct([(name, pa.float64() if kind == "double" else pa.string()) for name, kind in _FIELDS])


def _ranges(first: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of `own` all entries first[x] to first[x + 1], and which of `own` an entry belongs to."""
    fan = first[own + 1] - first[own]
    of = np.repeat(np.arange(len(own)), fan)
    return np.repeat(first[own] - np.append(0, np.cumsum(fan)[:-1]), fan) + np.arange(len(of)) if len(of) else np.zeros(0, np.int64), of


def _listed(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.append(0, np.cumsum([len(x) for x in lists])).astype(np.int64), np.array([y for x in lists for y in x], dtype=np.int64)


class Matcher:
    """Which of many patterns match a text."""

    def __init__(self, patterns: list[str]):
        self.patterns, sets = patterns, [needed(p, spaces=True)[: 2 + MORE_SETS] for p in patterns]
        shared = Counter(x for own in sets for s in own for x in s.literals)
        # First the set whose place in a match is bounded and whose literals the fewest rules share: it makes candidates.
        ranked = [sorted(own, key=lambda s: (s.before is None, sum(shared[x] for x in s.literals), sorted(s.literals)))[: 1 + MORE_SETS] for own in sets]
        names = sorted({x for own in ranked for s in own for x in s.literals})
        number = {x: i for i, x in enumerate(names)}
        self.always = [i for i, own in enumerate(ranked) if not own]
        self.before = [own[0].before if own else None for own in ranked]
        rules_of: list[list[int]] = [[] for _ in names]
        for i, own in enumerate(ranked):
            for x in own[0].literals if own else ():
                rules_of[number[x]].append(i)
        self.rules_first, self.rules_own = _listed(rules_of)
        self.groups_first, _ = _listed([[0] * len(own[1:]) for own in ranked])
        self.literal_first, self.literal_own = _listed([[number[x] for x in sorted(s.literals)] for own in ranked for s in own[1:]])
        self.literals, self.search = max(1, len(names)), Literals([x.encode() for x in names])

    def candidates(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts, rules whose every set has a literal in them, and the bytes where the first set's literal begins; data
        are lower-case bytes."""
        spaced, byte, bounds = spaced_bytes(data, bounds)
        at, literal = self.search.find(spaced)
        row = np.searchsorted(bounds, at, side="right") - 1
        inside = at + self.search.size[literal] <= bounds[row + 1]
        at, literal, row = byte[at[inside]], literal[inside], row[inside]
        seen = np.unique(row * self.literals + literal)
        entry, of = _ranges(self.rules_first, literal)
        row, rule, at = row[of], self.rules_own[entry], at[of]
        # the other sets of each pair of a text and a rule
        n = max(1, len(self.patterns))
        pairs, pair = np.unique(row * n + rule, return_inverse=True)
        group, of = _ranges(self.groups_first, pairs % n)
        entry, of_group = _ranges(self.literal_first, group)
        key = (pairs // n)[of][of_group] * self.literals + self.literal_own[entry]
        place = np.minimum(np.searchsorted(seen, key), max(0, len(seen) - 1))
        held = np.zeros(len(group), dtype=bool)
        held[of_group[seen[place] == key]] = True
        whole = np.ones(len(pairs), dtype=bool)
        whole[of[~held]] = False
        keep = whole[pair]
        return row[keep], rule[keep], at[keep]

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Texts and the patterns that match, by text and then pattern."""
        texts = texts.cast(pa.large_string())
        missing = texts.is_null().to_numpy(zero_copy_only=False)
        texts, n, rows, rules, begin = texts.fill_null(""), len(texts), [], [], 0
        bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
        while begin < n:
            end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + SPAN, side="right")) - 1)
            data, own = raw[bounds[begin] : bounds[end]], bounds[begin : end + 1] - bounds[begin]
            row, rule, at = self.candidates(LOWER[data], own)
            characters = np.append(0, np.cumsum((data & 0xC0) != 0x80))  # characters that begin before a byte
            places = characters[at] - characters[own[row]]
            always = np.flatnonzero(~missing[begin:end]).repeat(len(self.always))
            row, rule = np.append(row, always), np.append(rule, np.tile(np.array(self.always, dtype=np.int64), len(always) // max(1, len(self.always))))
            places = np.append(places, np.zeros(len(always), dtype=np.int64))
            order = np.lexsort((places, rule, row))
            row, rule, places = row[order], rule[order], places[order]
            first = np.flatnonzero(np.append(True, (np.diff(row) != 0) | (np.diff(rule) != 0))) if len(row) else np.zeros(0, np.int64)
            text, last = "", -1
            for i, j in zip(first.tolist(), [*first[1:].tolist(), len(row)]):
                if row[i] != last:
                    text, last = texts[begin + int(row[i])].as_py(), row[i]
                if matches(self.patterns[int(rule[i])], self.before[int(rule[i])], text, places[i:j].tolist()):
                    rows.append(begin + int(row[i]))
                    rules.append(int(rule[i]))
            begin = end
        return np.array(rows, dtype=np.int64), np.array(rules, dtype=np.int64)


def _blocks(rules: DataFrame, block_bytes: int):
    """The rules of each block, in order of their ids."""
    size = rules.agg(F.sum(F.octet_length("pattern") + 64)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for block in range(blocks):
        own = rules.where(F.pmod(F.xxhash64("rule_id", "pattern"), F.lit(blocks)) == block).select(*_RULE)
        yield sorted(own.toArrow().to_pylist(), key=lambda r: (str(r["rule_id"]), str(r["pattern"])))


def _found(rows: list[dict], location: str | None):
    """A function of a text column: the findings of a block of rules."""
    matcher, whole = Matcher([r["pattern"] for r in rows]), []
    for r in rows:
        rule = Rule(str(r["rule_id"]), r["threat_type"], r["severity"], float(r["confidence"]), r["pattern"], action=r.get("action") or "", layer=r.get("layer") or "L1")
        fields = (rule.threat_type, rule.severity, rule.confidence, rule.act, rule.layer, f"Matched {rule.rule_id}", rule.rule_id, f"Rule {rule.rule_id}", rule.rule_id, location)
        whole.append(dict(zip(_NAMES, fields)))

    def findings(texts: pa.Array) -> pa.Array:
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        row, rule = matcher.of(texts)
        used, place = np.unique(rule, return_inverse=True)
        ends = np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array([whole[k] for k in used.tolist()], _KIND).take(pa.array(place)))

    return F.arrow_udf(findings, FINDINGS)


def _finding(location: str | None):
    """A rule's finding, from its columns."""
    act = F.when(F.coalesce("action", F.lit("")) != "", F.col("action")).when(F.col("severity").isin("critical", "high"), "block").otherwise("flag")
    layer = F.when(F.coalesce("layer", F.lit("")) != "", F.col("layer")).otherwise("L1")
    rule = F.coalesce("rule_id", F.lit("None"))
    fields = ("threat_type", "severity", "confidence", act, layer, F.concat(F.lit("Matched "), rule), rule, F.concat(F.lit("Rule "), rule), rule, F.lit(location))
    return F.struct(*((F.col(x) if isinstance(x, str) else x).alias(name) for name, x in zip(_NAMES, fields))).cast(FINDINGS.removeprefix("array<").removesuffix(">"))


def apply_rule_table(
    df: DataFrame, text_col: str, rules: DataFrame, out_col: str = "findings", location: str | None = None, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Adds the findings of a text, in order of rule ids, for rules (rule_id, threat_type, severity, confidence, pattern
    and, where there, action and layer). Null texts have none. Patterns that are null or no expressions are refused."""
    keep, found, rules = df.columns, [], parsed(rules)
    bad = rules.where("bad").select("rule_id").limit(10).collect()
    if bad:
        raise ValueError(f"rules whose patterns cannot be read: {', '.join(str(r.rule_id) for r in bad)}")
    size = rules.agg(F.sum(F.octet_length("pattern") + 64)).first()[0] or 0
    if size > block_bytes:
        indexed, rules = rules.where(F.size("sets") > 0), rules.where(F.size("sets") == 0)
        if indexed.limit(1).count():
            found.append(f"__{out_col}0")
            df = apply_index(df, text_col, indexed, _finding(location), found[0])
    for rows in _blocks(rules, block_bytes):
        if rows:
            found.append(f"__{out_col}{len(found)}")
            df = df.withColumn(found[-1], _found(rows, location)(F.col(text_col)))
    every = F.concat(*(F.coalesce(x, no_findings()) for x in found)) if found else no_findings()
    if len(found) > 1:
        every = F.array_sort(every, lambda a, b: F.when(a["policy_id"] < b["policy_id"], -1).when(a["policy_id"] > b["policy_id"], 1).otherwise(0))
    return computed(df, keep, every.cast(FINDINGS).alias(out_col)).select(*keep, out_col)
