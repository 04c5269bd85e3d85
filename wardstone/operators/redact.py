"""Reversible redaction: find personal data, replace it by numbered tokens, restore it later.

All of it is one chain of column expressions per row: no shuffle, no Python. Order of work:

1. gates: substring tests and one digit test that a text must pass before a detector runs;
2. one ``regexp_extract_all`` per detector, only behind its gate;
3. positions, overlap resolution, numbering and rebuilding, only for texts with a hit.

Each step is its own projection, so no regular expression is evaluated twice. Lists of hits are folded in blocks: a fold
that appends to a list copies it each time, so only short lists are appended to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstone.functions.text import SPACE
from wardstone.sources.catalogue import Detector, builtin_catalogue
from wardstone.sources.tables import sql_literal

SPAN = (
    "struct<start:int,priority:int,end:int,original:string,type:string,prefix:string>"
)
GROUP = "struct<gaps:array<string>,hits:array<string>,priority:int,type:string,prefix:string>"
ENTRY = "struct<token:string,original:string,type:string,position:int>"
MASK = "[REDACTED]"
# Stands for a match while gaps are measured: splitting at one literal character compiles no
# pattern per row. It is no character of any text; a text that has it anyway is split by pattern.
MARK = "\uffff"
#: Hits of a block.
BLOCK = 128
#: Hits of a list that is numbered by counting.
SHORT = 32
#: Detectors of a step: larger methods than these give are not compiled by the JVM.
COMPILED = 4


def computed(df: DataFrame, keep: list[str], *columns: Column) -> DataFrame:
    """``keep`` plus ``columns``, behind a one-row generator.

    A filter on the new columns stays above the generator. Pushed below it, the filter would
    bring its own copy of each expression, regular expressions and all.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))


def _empty(element: str) -> Column:
    return F.array().cast(f"array<{element}>")


# What a text must contain before a built-in detector can match it: (any of these words,
# any of these words in lower case, a cheap pattern). Each is implied by the detector.
_GATES: dict[str, tuple[list[str], list[str], str | None]] = {
    "aws_key": (["AKIA", "ASIA"], [], None),
    "private_key": (["PRIVATE KEY-----"], [], None),
    "credit_card": ([], [], f"[0-9]{{4}}[-{SPACE}]?[0-9]{{4}}"),
    "ssn": ([], [], "[0-9]{2}-?[0-9]{4}"),
    "email": (["@"], [], None),
    "phone": ([], [], f"[0-9]{{3}}[-.{SPACE}]?[0-9]{{4}}"),
    "api_key": ([], ["api", "access"], None),
    "medical_record": ([], ["mrn", "medical record"], None),
    "dob": ([], ["dob", "d.o.b.", "birth"], None),
    "bank_account": ([], ["account", "acct"], "[0-9]{8}"),
    "routing_number": ([], ["routing", "aba"], "[0-9]{9}"),
    "ip_address": ([], [], r"[0-9]\.[0-9]"),
    "address": ([], [], f"[0-9][{SPACE}]+[A-Za-z0-9]"),
}
_NEEDS_DIGIT = {
    "credit_card", "ssn", "phone", "dob", "bank_account", "routing_number", "ip_address", "address",
}


def _gate(d: Detector, text: str, low: str, digit: str) -> str | None:
    """Condition, as SQL, under which a built-in detector is worth running."""
    if not d.builtin or d.name not in _GATES:
        return None
    words, low_words, cheap = _GATES[d.name]
    tests = [digit] if d.name in _NEEDS_DIGIT else []
    for column, some in ((text, words), (low, low_words)):
        if some:
            tests.append("(" + " OR ".join(f"contains({column}, {sql_literal(w)})" for w in some) + ")")
    if cheap:
        tests.append(f"{text} RLIKE {sql_literal(cheap)}")
    return " AND ".join(tests)


def _with_hits(df: DataFrame, text_col: str, out_col: str, catalogue: list[Detector]) -> DataFrame:
    """Adds what each detector matches, null behind a closed gate."""
    keep = df.columns
    text, low, digit = f"`{text_col}`", f"`__{out_col}_low`", f"`__{out_col}_digit`"
    df = computed(df, keep, F.lower(text_col).alias(low.strip("`")), F.col(text_col).rlike("[0-9]").alias(digit.strip("`")))
    found: list[str] = []
    for first in range(0, len(catalogue), COMPILED):
        new = []
        for d in catalogue[first : first + COMPILED]:
            hits = f"regexp_extract_all({text}, {sql_literal(d.pattern)}, 0)"
            gate = _gate(d, text, low, digit)
            if gate is not None:
                hits = f"if({gate}, {hits}, NULL)"
            new.append(F.expr(hits).alias(f"__{out_col}_m{d.priority}"))
        df = computed(df, [*keep, low.strip("`"), digit.strip("`"), *found], *new)
        found += [f"__{out_col}_m{d.priority}" for d in catalogue[first : first + COMPILED]]
    return df.select(*keep, *found)


def _spans(text_col: str, out_col: str, catalogue: list[Detector]) -> Column:
    """Positions of the hits, which follow from the gaps between the matches of a detector."""
    text, none = f"`{text_col}`", f"CAST(array() AS array<{GROUP}>)"
    columns = [f"`__{out_col}_m{d.priority}`" for d in catalogue]

    def group(d: Detector, hits: str) -> str:
        pattern = sql_literal(d.pattern)
        marked = f"regexp_replace({text}, {pattern}, '{MARK}')"
        gaps = f"if(contains({text}, '{MARK}'), split({text}, {pattern}, -1), split({marked}, '{MARK}', -1))"
        one = f"struct({gaps} AS gaps, {hits} AS hits, {d.priority} AS priority, {sql_literal(d.name)} AS type, {sql_literal(d.prefix)} AS prefix)"
        return f"if(size({hits}) > 0, array({one}), {none})"

    groups = f"concat({', '.join(group(*each) for each in zip(catalogue, columns))})" if catalogue else none
    parts = "zip_with(slice(g.gaps, 1, size(g.hits)), g.hits, (gap, hit) -> struct(length(gap) AS gap, hit AS hit))"
    step = """struct(
                acc.pos + p.gap + length(p.hit) AS pos,
                concat(acc.out, array(struct(
                  acc.pos + p.gap AS start, g.priority AS priority, acc.pos + p.gap + length(p.hit) AS end,
                  p.hit AS original, g.type AS type, g.prefix AS prefix))) AS out)"""
    spans = f"sort_array(flatten(transform({groups}, g -> {_fold_in_blocks(parts, 'size(g.hits)', '0', 'pos', SPAN, step)})))"
    hit = " OR ".join(f"size({hits}) > 0" for hits in columns) or "false"
    return F.expr(f"if({hit}, {spans}, CAST(array() AS array<{SPAN}>))").cast(f"array<{SPAN}>")


def _all_spans(df: DataFrame, texts: dict[str, str], catalogue: list[Detector] | None) -> DataFrame:
    """``find_spans`` of several texts: the column of each by that of its spans."""
    catalogue = builtin_catalogue() if catalogue is None else catalogue
    keep = df.columns
    for out_col, text_col in texts.items():
        df = _with_hits(df, text_col, out_col, catalogue)
    return computed(df, keep, *(_spans(text_col, out_col, catalogue).alias(out_col) for out_col, text_col in texts.items()))


def find_spans(
    df: DataFrame, text_col: str, out_col: str = "spans", catalogue: list[Detector] | None = None
) -> DataFrame:
    """Every hit of every detector on the original text, ordered by start, then priority."""
    return _all_spans(df, {out_col: text_col}, catalogue)


def _fold_in_blocks(items: str, n: str, zero: str, carried: str, element: str, step: str) -> str:
    """SQL of a fold over ``n`` ``items`` that gives a list of ``element``.

    ``step`` makes from ``acc`` (``carried`` and ``out``) and an item ``p`` the next ``acc``. Each block appends to a list
    of its own, and the lists of the blocks are joined.
    """
    empty, lists = f"CAST(array() AS array<{element}>)", f"CAST(array() AS array<array<{element}>>)"
    one_block = f"aggregate({items}, struct({zero} AS {carried}, {empty} AS out), (acc, p) -> {step}, acc -> acc.out)"
    blocks = f"""aggregate(array({items}), {empty}, (none, items) -> aggregate(
            transform(sequence(0, cast((size(items) - 1) div {BLOCK} AS int)), b -> slice(items, b * {BLOCK} + 1, {BLOCK})),
            struct({zero} AS {carried}, {lists} AS out),
            (all, block) -> aggregate(
              array(aggregate(block, struct(all.{carried} AS {carried}, {empty} AS out), (acc, p) -> {step})), all,
              (all, own) -> struct(own.{carried} AS {carried}, concat(all.out, array(own.out)) AS out)),
            all -> flatten(all.out)))"""
    return f"if({n} <= {BLOCK}, {one_block}, {blocks})"


def resolve_overlaps(spans: Column) -> Column:
    """Spans kept when each may not overlap an earlier kept one (input sorted).

    Kept spans are disjoint and sorted, so comparing with the last end is enough. The fold only
    runs where two neighbours do overlap.
    """
    neighbours = F.zip_with(
        F.slice(spans, 1, F.greatest(F.size(spans) - 1, F.lit(0))),
        F.slice(spans, 2, F.greatest(F.size(spans) - 1, F.lit(0))),
        lambda a, b: b["start"] < a["end"],
    )
    empty, lists = _empty(SPAN), F.array().cast(f"array<array<{SPAN}>>")

    def kept(acc: Column, s: Column) -> Column:
        fits = s["start"] >= acc["last"]
        return F.struct(F.when(fits, s["end"]).otherwise(acc["last"]).alias("last"), F.when(fits, F.concat(acc["out"], F.array(s))).otherwise(acc["out"]).alias("out"))

    def block(all_blocks: Column, own: Column) -> Column:
        one = F.aggregate(own, F.struct(all_blocks["last"].alias("last"), empty.alias("out")), kept)
        return F.aggregate(F.array(one), all_blocks, lambda a, o: F.struct(o["last"].alias("last"), F.concat(a["out"], F.array(o["out"])).alias("out")))

    places = F.sequence(F.lit(0), F.floor((F.greatest(F.size(spans), F.lit(1)) - 1) / BLOCK).cast("int"))
    blocks = F.transform(places, lambda b: F.slice(spans, b * BLOCK + 1, F.lit(BLOCK)))
    folded = F.aggregate(blocks, F.struct(F.lit(0).alias("last"), lists.alias("out")), block, lambda acc: F.flatten(acc["out"]))
    return F.when((F.size(spans) > 1) & F.exists(neighbours, lambda x: x), folded).otherwise(spans)


def _ranked(kept: Column) -> Column:
    """Spans by prefix, then in order, each with its place in the text's list."""
    return F.array_sort(F.transform(kept, lambda s, i: F.struct(s["prefix"].alias("prefix"), i.alias("i"), s.alias("s"))))


def _firsts(ranked: Column) -> Column:
    """Where each prefix begins in the list by prefix, from 1."""
    prefixes = F.transform(ranked, lambda x: x["prefix"])
    return F.transform(F.array_distinct(prefixes), lambda p: F.struct(p.alias("prefix"), F.array_position(prefixes, p).alias("at")))


def _entries(ranked: Column, firsts: Column) -> Column:
    """The list in order of the text; a number is a span's rank among those of its prefix."""

    def entry(x: Column, i: Column) -> Column:
        first = F.element_at(F.filter(firsts, lambda f: f["prefix"] == x["prefix"]), 1)["at"]
        token = F.concat(F.lit("["), x["prefix"], F.lit("_"), (i + 2 - first).cast("string"), F.lit("]"))
        s = x["s"]
        return F.struct(x["i"].alias("i"), F.struct(token.alias("token"), s["original"].alias("original"), s["type"].alias("type"), s["start"].alias("position")).alias("e"))

    return F.transform(F.array_sort(F.transform(ranked, entry)), lambda x: x["e"])


def _counted(kept: Column) -> Column:
    """The same of a short list, each number by counting the prefix before; sorting costs such lists more."""
    prefixes = kept["prefix"]

    def entry(s: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(prefixes, F.lit(1), i), lambda p: p == s["prefix"]))
        token = F.concat(F.lit("["), s["prefix"], F.lit("_"), (before + 1).cast("string"), F.lit("]"))
        return F.struct(token.alias("token"), s["original"].alias("original"), s["type"].alias("type"), s["start"].alias("position"))

    return F.transform(kept, entry)


def _rebuilt(text: Column, entries: Column) -> Column:
    """The text with every entry replaced by its token.

    Finding a place in a text takes as long as what lies before it, so each block of entries cuts its part out first;
    one block is the text itself.
    """

    def end(i: Column) -> Column:
        before = F.when(i > 0, F.element_at(entries, F.greatest(i, F.lit(1))))
        return F.coalesce(before["position"] + F.length(before["original"]), F.lit(0))

    def block(b: Column) -> Column:
        begin, to = end(b * BLOCK), end(F.least((b + 1) * BLOCK, F.size(entries)))
        part = F.struct(F.substring(text, begin + 1, to - begin).alias("text"), begin.alias("begin"))

        def rebuilt(own: Column) -> Column:
            def piece(e: Column, i: Column) -> Column:
                at = end(b * BLOCK + i)
                return F.concat(F.substring(own["text"], at - own["begin"] + 1, e["position"] - at), e["token"])

            return F.array_join(F.transform(F.slice(entries, b * BLOCK + 1, F.lit(BLOCK)), piece), "")

        return F.element_at(F.transform(F.array(part), rebuilt), 1)

    def alone(e: Column, i: Column) -> Column:
        return F.concat(F.substring(text, end(i) + 1, e["position"] - end(i)), e["token"])

    blocks = F.sequence(F.lit(0), F.floor((F.greatest(F.size(entries), F.lit(1)) - 1) / BLOCK).cast("int"))
    pieces = F.when(F.size(entries) <= BLOCK, F.transform(entries, alone)).otherwise(F.transform(blocks, block))
    tail = F.substring(text, end(F.size(entries)) + 1, F.length(text))
    return F.when(F.size(entries) > 0, F.concat(F.array_join(pieces, ""), tail)).otherwise(text)


def _held(value: Column, make) -> Column:
    """``make`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), make), 1)


def _redactions(spans: Column) -> Column:
    def numbered(kept: Column) -> Column:
        long = _held(_ranked(kept), lambda ranked: _held(_firsts(ranked), lambda firsts: _entries(ranked, firsts)))
        return F.when(F.size(kept) <= SHORT, _counted(kept)).otherwise(long)

    return F.when(F.size(spans) > 0, _held(resolve_overlaps(spans), numbered)).otherwise(_empty(ENTRY))


def _redacted(df: DataFrame, texts: dict[str, str], catalogue: list[Detector] | None) -> DataFrame:
    """``redact_pii`` of several texts: the column of each by the prefix of its new ones."""
    keep = df.columns
    df = _all_spans(df, {f"__{prefix}spans": text_col for prefix, text_col in texts.items()}, catalogue)
    df = computed(df, keep, *(_redactions(F.col(f"__{prefix}spans")).alias(prefix + "redactions") for prefix in texts))
    new = []
    for prefix, text_col in texts.items():
        red = prefix + "redactions"
        new += [
            _rebuilt(F.col(text_col), F.col(red)).alias(prefix + "redacted_text"),
            F.col(red),
            (F.size(red) > 0).alias(prefix + "pii_detected"),
            F.size(red).alias(prefix + "redaction_count"),
        ]
    return df.select(*keep, *new)


def redact_pii(
    df: DataFrame, text_col: str, catalogue: list[Detector] | None = None, prefix: str = ""
) -> DataFrame:
    """Adds redacted_text, redactions, pii_detected and redaction_count (each after ``prefix``)."""
    return _redacted(df, {prefix: text_col}, catalogue)


def rehydrate(text: Column, redactions: Column) -> Column:
    """Each token back to its original: all occurrences, entry by entry in list order."""
    return F.aggregate(redactions, text, lambda t, r: F.replace(t, r["token"], r["original"]))


def mask_tokens(text: Column, redactions: Column) -> Column:
    """Every token replaced by the mask."""
    return F.aggregate(redactions, text, lambda t, r: F.replace(t, r["token"], F.lit(MASK)))


def mask_tokens_and_originals(text: Column, redactions: Column) -> Column:
    """Entry by entry, the token and then the original (unless empty) replaced by the mask."""

    def step(t: Column, r: Column) -> Column:
        t = F.replace(t, r["token"], F.lit(MASK))
        no_original = F.coalesce(r["original"], F.lit("")) == ""
        return F.when(no_original, t).otherwise(F.replace(t, r["original"], F.lit(MASK)))

    return F.aggregate(redactions, text, step)


def summary_map(redactions: Column) -> Column:
    """Count per type as a map."""
    types = F.transform(redactions, lambda r: r["type"])

    def pair(t: Column) -> Column:
        return F.struct(t, F.size(F.filter(types, lambda x: x == t)).cast("long"))

    return F.map_from_entries(F.transform(F.array_distinct(types), pair))


def redact_request(
    df: DataFrame, content_col: str = "content", context_col: str = "context",
    catalogue: list[Detector] | None = None, when: Column | None = None,
) -> DataFrame:
    """Redact content and context on their own and merge the two lists, content first.

    Both lists number their tokens from 1. Adds redacted_content, redacted_context, redactions,
    pii_detected, redaction_count, masked_content and masked_context. Rows for which ``when`` is
    false keep their texts and get an empty list.
    """
    keep = df.columns
    wanted = F.lit(True) if when is None else F.coalesce(when, F.lit(False))
    df = df.withColumn("__c", F.when(wanted, F.col(content_col)))
    df = df.withColumn("__x", F.when(wanted, F.col(context_col)))
    df = _redacted(df, {"__c_": "__c", "__x_": "__x"}, catalogue)
    df = df.select(
        *keep,
        F.coalesce("__c_redacted_text", content_col).alias("redacted_content"),
        F.coalesce("__x_redacted_text", context_col, F.lit("")).alias("redacted_context"),
        F.concat("__c_redactions", "__x_redactions").alias("redactions"),
    )
    return df.select(
        "*",
        (F.size("redactions") > 0).alias("pii_detected"),
        F.size("redactions").alias("redaction_count"),
        mask_tokens(F.col("redacted_content"), F.col("redactions")).alias("masked_content"),
        mask_tokens(F.col("redacted_context"), F.col("redactions")).alias("masked_context"),
    )
