"""Screening of texts with rules, and checks that need more than a rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstone.functions.mapping import severity_rank
from wardstone.functions.text import java_pattern, leads_with_word, quick_classes
from wardstone.operators.findings import FINDING, FINDINGS, finding, no_findings
from wardstone.operators.redact import computed
from wardstone.sources import rules as packs
from wardstone.sources.rules import Rule
from wardstone.sources.tables import fixed_table, sql_literal


def _rule_sql(rule: Rule, location: str | None = None) -> str:
    values = [
        rule.threat_type, rule.severity, float(rule.confidence), rule.act, rule.layer, f"Matched {rule.rule_id}",
        rule.rule_id, f"Rule {rule.rule_id}", rule.rule_id, location,
    ]
    return f"CAST(struct({', '.join(sql_literal(v) for v in values)}) AS {FINDING})"


def rule_finding(rule: Rule, location: str | None = None) -> Column:
    return F.expr(_rule_sql(rule, location))


def _test_sql(rule: Rule, text: str, low: str) -> str:
    """Whether a rule matches; its words are tried first, on the lower-cased text."""
    pattern = quick_classes(java_pattern(rule.pattern, True, leads_with_word(rule.pattern)))
    tests = [f"{text} RLIKE {sql_literal(pattern)}"]
    if rule.words:
        tests.insert(0, "(" + " OR ".join(f"contains({low}, {sql_literal(w)})" for w in rule.words) + ")")
    if rule.unless:
        tests.append(f"NOT {text} RLIKE {sql_literal(quick_classes(java_pattern(rule.unless, True)))}")
    return " AND ".join(tests)


def apply_rules(
    df: DataFrame, text_col: str, rules: list[Rule], out_col: str = "findings",
    location: str | None = None, off: dict[str, str] | None = None,
) -> DataFrame:
    """Adds the findings of a text in rule order; ``off`` maps rule ids to a flag column that mutes them."""
    keep = df.columns
    text, low = f"`{text_col}`", f"`__{out_col}_low`"
    df = df.withColumn(low.strip("`"), F.lower(F.col(text_col)))
    hits = []
    for rule in rules:
        test = _test_sql(rule, text, low)
        if off and rule.rule_id in off:
            test = f"NOT coalesce(`{off[rule.rule_id]}`, false) AND {test}"
        hits.append(F.expr(f"if({test}, {_rule_sql(rule, location)}, NULL)"))
    return computed(df, keep, F.coalesce(F.array_compact(F.array(*hits)), no_findings()).alias(out_col))


def pii_findings(spans: Column, severity: str = "high", action: str = "block", location: str | None = None) -> Column:
    """One finding per kind of personal data in a text, in order of appearance."""
    types = F.array_distinct(F.transform(spans, lambda s: s["type"]))

    def one(t: Column) -> Column:
        return finding(
            F.lit("pii_exposure"), severity, 0.9, action, "L1", F.concat(F.lit("Contains "), t),
            F.concat(F.lit("pii-"), t), "Personal data", t, location,
        )

    return F.coalesce(F.transform(types, one), no_findings())


def top_finding(findings: Column) -> Column:
    """The worst finding, the earliest of equals: what a specialised check answers with."""
    ranked = F.transform(
        findings, lambda f, i: F.struct((-severity_rank(f["severity"])).alias("r"), i.alias("i"), f.alias("f"))
    )
    return F.array_min(F.transform(ranked, lambda x: F.struct(x["r"], x["i"])))


def answer_of(df: DataFrame, findings_col: str, prefix: str = "") -> DataFrame:
    """Adds safe, threat_type, severity, reason and confidence of the worst finding."""
    place = top_finding(F.col(findings_col))["i"]
    df = df.withColumn("__top", F.get(F.col(findings_col), place))
    top = F.col("__top")
    return df.withColumns(
        {
            prefix + "safe": F.size(findings_col) == 0,
            prefix + "threat_type": top["type"],
            prefix + "severity": top["severity"],
            prefix + "reason": top["message"],
            prefix + "confidence": F.coalesce(top["confidence"], F.lit(1.0)),
        }
    ).drop("__top")


# --- obfuscation ----------------------------------------------------------------------

# Look-alike letters and the letters they stand for (fixed values).
LOOKALIKES = "аеорсухіѕјԁɡһոտԛԝαερτυνοκмтвнАВЕКМНОРСТХΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"
LOOKS_LIKE = "aeopcyxisjdghntqwaeptuvokmtbhABEKMHOPCTXABEZHIKMNOPTYX"
INVISIBLE = r"[\x{00AD}\x{200B}-\x{200F}\x{2060}-\x{2064}\x{FEFF}]"
BIDI = r"[\x{202A}-\x{202E}\x{2066}-\x{2069}]"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
LEET, PLAIN = "013457@$", "oieastas"


# Blocks that hold all of the above, as ranges: one quick test that nearly all texts fail.
SUSPECT = r"[\x{00AD}\x{0250}-\x{02AF}\x{0370}-\x{058F}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2069}\x{FEFF}]"


def unicode_signals(df: DataFrame, text_col: str) -> DataFrame:
    """Adds folded text and counts of invisible, bidirectional, control and look-alike characters."""
    text = F.col(text_col)
    keep = df.columns
    df = computed(df, keep, text.rlike(SUSPECT).alias("__suspect"), F.regexp_count(text, F.lit(CONTROL)).cast("long").alias("n_control"))
    suspect = F.col("__suspect")

    def count(pattern: str) -> Column:
        return F.when(suspect, F.regexp_count(text, F.lit(pattern))).otherwise(0).cast("long")

    folded = F.translate(F.regexp_replace(text, INVISIBLE, ""), LOOKALIKES, LOOKS_LIKE)
    return computed(
        df, [*keep, "n_control"],
        F.when(suspect, folded).otherwise(text).alias("folded"),
        count(INVISIBLE).alias("n_invisible"), count(BIDI).alias("n_bidi"),
        count(f"[{LOOKALIKES}]").alias("n_lookalike"),
    )


def mixed_script(text: Column) -> Column:
    """A word with both Latin letters and Cyrillic or Greek look-alikes."""
    return text.rlike(SUSPECT) & text.rlike(f"[A-Za-z][{LOOKALIKES}]|[{LOOKALIKES}][A-Za-z]")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE64_RUN = r"[A-Za-z0-9+/]{16,}={0,2}"
HEX_RUN = r"(?:[0-9a-fA-F]{2}){8,}"
# Whether a text has a base64 run: tried only at the ends of other characters.
HAS_RUN = quick_classes(r"(?:^|[^A-Za-z0-9+/])[A-Za-z0-9+/]{16}")


def atbash(text: Column) -> Column:
    return F.translate(text, _UPPER + _LOWER, _UPPER[::-1] + _LOWER[::-1])


def caesar(text: Column, shift: int) -> Column:
    k = shift % 26
    return F.translate(text, _UPPER + _LOWER, _UPPER[k:] + _UPPER[:k] + _LOWER[k:] + _LOWER[:k])


def decoded_texts(text: Column) -> Column:
    """Readable texts hidden in base64 and hexadecimal runs, in order of appearance."""

    def readable(run: Column, encoding: str) -> Column:
        padded = run
        if encoding == "base64":
            bare = F.rtrim(run, F.lit("="))
            whole = F.substring(bare, F.lit(1), F.length(bare) - F.when(F.length(bare) % 4 == 1, 1).otherwise(0))
            padded = F.rpad(whole, (F.ceil(F.length(whole) / 4) * 4).cast("int"), F.lit("="))
        return F.try_validate_utf8(F.try_to_binary(padded, F.lit(encoding)).cast("string"))

    def all_of(pattern: str, encoding: str) -> Column:
        runs = F.regexp_extract_all(text, F.lit(quick_classes(pattern)), F.lit(0))
        return F.transform(runs, lambda r: readable(r, encoding))

    both = F.concat(all_of(BASE64_RUN, "base64"), all_of(HEX_RUN, "hex"))
    return F.filter(both, lambda t: t.isNotNull() & t.rlike("[A-Za-z]{3}"))


def deobfuscated(text: Column) -> Column:
    """Text with spaced-out letters joined and digits that stand for letters replaced."""
    joined = F.regexp_replace(text, SPACE_BETWEEN, "")
    return F.translate(F.lower(joined), LEET, PLAIN)


SPACED = r"(?<![A-Za-z0-9])[A-Za-z0-9@$] [A-Za-z0-9@$](?![A-Za-z0-9])"
LEET_WORD = r"[A-Za-z][013457@$]|[013457@$][A-Za-z]"
# The same, from the rarer character: nearly all places fail at the first one. The space of SPACED alone, and LEET_WORD.
SPACE_BETWEEN = quick_classes(r" (?<=(?<![A-Za-z0-9])[A-Za-z0-9@$] )(?=[A-Za-z0-9@$](?![A-Za-z0-9]))")
LEET_NEAR = quick_classes(r"[013457@$](?:[A-Za-z]|(?<=[A-Za-z].))")


def scramble_key(word: Column) -> Column:
    """First letter, sorted middle letters, last letter: equal for a word and its scrambled forms."""
    middle = F.split(F.substring(word, F.lit(2), F.length(word) - 2), "")
    return F.when(
        F.length(word) >= 4,
        F.concat(F.left(word, F.lit(1)), F.array_join(F.array_sort(middle), ""), F.right(word, F.lit(1))),
    )


def scrambled_words(df: DataFrame, key: str, text_col: str, lexicon: list[str] = packs.SHUFFLED) -> DataFrame:
    """Words of a text that are a lexicon word with its middle letters shuffled: key, word, meant, n.

    The lexicon is joined on its keys (broadcast: it is a list), so a text's words never meet
    each other.
    """
    words = df.select(key, F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(r"\p{L}{4,}"), F.lit(0))).alias("word"))
    lex = fixed_table(df.sparkSession, ["meant"], [(w,) for w in lexicon]).withColumn("__k", scramble_key(F.col("meant")))
    keyed = words.withColumn("__k", scramble_key(F.col("word")))
    hits = keyed.join(F.broadcast(lex), "__k").filter("word <> meant")
    return hits.groupBy(key, "word", "meant").agg(F.count(F.lit(1)).alias("n"))


# --- responses ------------------------------------------------------------------------


def leaked_originals(prompt_spans: Column, response_spans: Column) -> Column:
    """Personal data in the response that the prompt did not have."""
    have = F.transform(prompt_spans, lambda s: s["original"])
    return F.array_except(F.transform(response_spans, lambda s: s["original"]), F.coalesce(have, F.array().cast("array<string>")))


def word_set(text: Column, least: int = 4) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(rf"\p{{L}}{{{least},}}"), F.lit(0)))


def topic_overlap(a: Column, b: Column) -> Column:
    """Jaccard of two word sets, rounded; 1 when both are empty."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, 1.0).otherwise(F.round(both / either, 6))


def tone_ratio(text: Column, words: list[str]) -> Column:
    """Share of the words of a text that are in a list."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))
    hits = F.size(F.filter(found, lambda w: w.isin(words)))
    return F.when(F.size(found) == 0, 0.0).otherwise(F.round(hits / F.size(found), 6))


def shingles(text: Column, n: int = 5) -> Column:
    """Distinct runs of n words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))
    places = F.sequence(F.lit(1), F.size(words) - n + 1)
    runs = F.transform(places, lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.when(F.size(words) >= n, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def containment(inner: Column, outer: Column) -> Column:
    """Share of the inner shingles that the outer text has."""
    return F.when(F.size(inner) == 0, 0.0).otherwise(
        F.round(F.size(F.array_intersect(inner, outer)) / F.size(inner), 6)
    )
