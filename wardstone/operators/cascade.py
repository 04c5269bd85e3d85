"""Layers of screening in order of cost; each gets only the texts that no layer before it decided.

A request is decided by the first layer after which some finding has enough confidence. A rule counts once for each part
of a request, at the first layer that shows it. ``depth`` cuts the layers off that a tier does not have.

| Layer | Depth | What it reads |
|---|---|---|
| rules | 1 | the text |
| unicode | 1 | the text with confusable characters folded and invisible ones removed; words of mixed scripts |
| malformed | 1 | the text without control characters; that it has some |
| encoding | 1 | what base64 and hexadecimal runs hold, up to three deep |
| spelling | 1 | spaced-out letters joined and digits read as letters; words with shuffled letters put right |
| visual | 6 | text direction that is overridden, or opened and closed in the wrong order |
| cipher | 1 | the text under the alphabet shifts, or the mirrored alphabet, that can bring up a rule |

Each layer tests cheaply whether there is something to undo, so plain texts cost it little. The cipher layer codes a text
by the distances of its letters, which no shift changes, and searches the literal parts of all rules in one pass; only
shifts under which a rule can match are undone. No layer shuffles.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstone.functions.literals import LOWER, Shifts, required
from wardstone.functions.text import quick_classes
from wardstone.operators import screen
from wardstone.operators.findings import FINDINGS, max_confidence, only
from wardstone.operators.redact import computed
from wardstone.operators.screen import BIDI, CONTROL, INVISIBLE, LOOKALIKES, LOOKS_LIKE, apply_rules, rule_finding
from wardstone.sources import fixed_values as fixed
from wardstone.sources import rules as packs
from wardstone.sources.rules import Rule
from wardstone.sources.tables import sql_literal

#: A finding of this confidence decides.
ENOUGH = 0.9
#: Name, code, and depth of the layers, in order.
LAYERS = [
    ("rules", "L1", 1), ("unicode", "L1.4", 1), ("malformed", "L1.42", 1), ("encoding", "L1.45a", 1),
    ("spelling", "L1.45", 1), ("visual", "L6", 6), ("cipher", "L1.45a", 1),
]
DEEPEST = max(depth for _, depth, *_ in fixed.TIERS)
MIXED_SCRIPT = Rule("uni-mixed-script", "token_manipulation", "medium", 0.7, "", layer="L1.4")
MALFORMED = Rule("txt-control", "token_manipulation", "medium", 0.6, "", layer="L1.42")
DIRECTION = Rule("txt-direction", "token_manipulation", "medium", 0.75, "", layer="L6")
#: Depth of the checks that compare a response with its prompt.
RESPONSE_DEPTH = 8
#: Rounds of decoding, for encodings within encodings.
ROUNDS = 3


def _letters(first: int) -> str:
    return "".join(chr(first + i) for i in range(26))


# Full-width letters and digits, and the thirteen alphabets of mathematical letters, by rule.
_WIDE = _letters(0xFF21) + _letters(0xFF41) + "".join(chr(0xFF10 + i) for i in range(10))
_MATH = "".join(_letters(0x1D400 + 52 * i) + _letters(0x1D41A + 52 * i) for i in range(13))
_PLAIN = screen._UPPER + screen._LOWER
#: Characters and the ones they are taken for; several places of the same length.
CONFUSABLE = LOOKALIKES + _WIDE + _MATH
TAKEN_FOR = LOOKS_LIKE + _PLAIN + "0123456789" + _PLAIN * 13
#: Characters that are taken for several (fixed values).
LIGATURES = [
    ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st"),
    ("ǆ", "dz"), ("ĳ", "ij"), ("ǉ", "lj"), ("ǌ", "nj"),
]
#: Blocks that hold all of these and the invisible characters: a quick test that nearly all texts fail.
UNUSUAL = (
    r"[\x{00AD}\x{0133}\x{01C6}-\x{01CC}\x{0250}-\x{02AF}\x{0370}-\x{058F}\x{200B}-\x{200F}\x{2060}-\x{2064}\x{FB00}-\x{FB06}\x{FEFF}"
    r"\x{FF10}-\x{FF5A}\x{1D400}-\x{1D6A3}]"
)
MIXED = f"[A-Za-z][{LOOKALIKES}]|[{LOOKALIKES}][A-Za-z]"
# The same for Java, whose classes try one range after the other: characters outside of all of them fail at once, and a
# pair is looked for from its Latin letter.
_UNUSUAL = r"[\x{00AD}\x{0133}-\x{10FFFF}&&" + UNUSUAL + "]"
_LOOKALIKE = r"[\x{0250}-\x{058F}&&[" + LOOKALIKES + "]]"
_MIXED = quick_classes(f"[A-Za-z](?:{_LOOKALIKE}|(?<={_LOOKALIKE}[A-Za-z]))")
_CONTROL = "[" + "".join(rf"\x{{{i:02X}}}" for i in [*range(32), 127] if re.match(CONTROL, chr(i))) + "]"


def beyond_ascii(text: Column) -> Column:
    return F.octet_length(text) != F.length(text)


def skeleton(text: Column) -> Column:
    """The text as it looks: without invisible characters, with confusable ones replaced, also by several."""
    out = F.translate(F.regexp_replace(text, INVISIBLE, ""), CONFUSABLE, TAKEN_FOR)
    for character, several in LIGATURES:
        out = F.replace(out, F.lit(character), F.lit(several))
    return out


# Directions: embeddings and overrides are closed by one mark, isolates by another.
_OPENERS, _CLOSERS = {"‪": "‬", "‫": "‬", "‭": "‬", "‮": "‬", "⁦": "⁩", "⁧": "⁩", "⁨": "⁩"}, "‬⁩"


def crossed_directions(text: Column) -> Column:
    """Whether direction marks override the order of letters, or are not closed in the order they were opened.

    A stack of what is still to be closed is kept over the marks alone.
    """
    marks = F.regexp_extract_all(text, F.lit(f"({BIDI})"), F.lit(1))
    stack = F.aggregate(
        marks, F.lit(""),
        lambda held, mark: F.when(held == "x", "x")
        .when(mark.isin(*_CLOSERS), F.when(F.right(held, F.lit(1)) == mark, F.left(held, F.length(held) - 1)).otherwise("x"))
        .otherwise(F.concat(held, F.translate(mark, "".join(_OPENERS), "".join(_OPENERS.values())))),
    )
    return text.rlike(r"[\x{202D}\x{202E}]") | (stack != "")


def decoded(text: Column) -> Column:
    """All readable texts in base64 and hexadecimal runs, and in what those hold, ROUNDS deep."""
    nothing = F.array().cast("array<string>")
    zero = F.struct(nothing.alias("all"), F.array(text).alias("last"))

    def deeper(state: Column, _: Column) -> Column:
        found = F.flatten(F.transform(state["last"], screen.decoded_texts))
        return F.aggregate(F.array(found), state, lambda s, one: F.struct(F.concat(s["all"], one).alias("all"), one.alias("last")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), zero, deeper, lambda s: s["all"])


def shuffled_pattern(lexicon: list[str]) -> str:
    """A pattern that every shuffled form of a lexicon word matches."""
    return "(?i)" + "|".join(f"{w[0]}[{''.join(sorted(set(w[1:-1])))}]{{{len(w) - 2}}}{w[-1]}" for w in lexicon)


def unshuffled(text: Column, lexicon: list[str] = packs.SHUFFLED) -> Column:
    """The lower-cased text with words whose middle letters are shuffled put right."""
    keys = F.create_map(*(x for w in lexicon for x in (F.lit(w[0] + "".join(sorted(w[1:-1])) + w[-1]), F.lit(w))))
    tokens = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    lengths, shuffled = [len(w) for w in lexicon], rf"^(?:{shuffled_pattern(lexicon)})\z"

    def righted(w: Column) -> Column:
        may = F.length(w).between(min(lengths), max(lengths)) & w.rlike(shuffled)
        return F.when(may, F.coalesce(F.try_element_at(keys, screen.scramble_key(w)), w)).otherwise(w)

    return F.array_join(F.transform(tokens, righted), "")


def cipher_shifts(rules: list[Rule]):
    """A function of a text column: a bit mask of the alphabet shifts under which a rule can match (``Shifts.ALL``)."""
    shifts = Shifts([required(rule.pattern, letters=True) for rule in rules])

    def mask(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts), dtype=np.int64)
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.cast(pa.large_string()).fill_null("")
        bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
        at = 0
        while at < len(texts):  # about a megabyte at a time, or one longer text
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + (1 << 20), side="right")) - 1)
            out[at:to] = shifts.of(LOWER[raw[bounds[at] : bounds[to]]], bounds[at : to + 1] - bounds[at])
            at = to
        return pa.array(out)

    return F.arrow_udf(mask, "long")


def deciphered(text: Column, mask: Column) -> Column:
    """The text under each alphabet shift of a mask, and mirrored where the mask has that bit."""
    alphabets = F.array(*(F.lit(screen._UPPER[k:] + screen._UPPER[:k] + screen._LOWER[k:] + screen._LOWER[:k]) for k in range(1, 26)), F.lit(screen._UPPER[::-1] + screen._LOWER[::-1]))
    chosen = F.filter(F.sequence(F.lit(1), F.lit(26)), lambda k: F.call_function("shiftright", mask, k).bitwiseAND(F.lit(1)) == 1)
    return F.transform(chosen, lambda k: F.call_function("translate", text, F.lit(_PLAIN), F.element_at(alphabets, k)))


_TEXT = "struct<text:string,low:string>"
_VIEW = f"struct<layer:string,code:string,location:string,texts:array<{_TEXT}>,more:{FINDINGS}>"


def _view(layer: str, location: str, texts: Column | None, *more: Column) -> Column:
    code = next(c for name, c, _ in LAYERS if name == layer)
    none = F.array().cast(f"array<{_TEXT}>")
    both = none if texts is None else F.transform(texts, lambda t: F.struct(t.alias("text"), F.lower(t).alias("low")))
    own = F.struct(F.lit(layer).alias("layer"), F.lit(code).alias("code"), F.lit(location).alias("location"), both.alias("texts"), only(*more).cast(FINDINGS).alias("more"))
    return own.cast(_VIEW)


def _hits_sql(rules: list[Rule]) -> str:
    """Findings of the rules over the texts of a view `v`, as SQL."""
    each = []
    for rule in rules:
        one = screen._rule_sql(rule).replace(f", {sql_literal(rule.layer)}, ", ", v.code, ", 1)
        one = one[: one.rindex("NULL")] + "v.location" + one[one.rindex("NULL") + 4 :]
        each.append(f"if(exists(v.texts, t -> {screen._test_sql(rule, 't.text', 't.low')}), {one}, NULL)")
    return f"array_compact(array({', '.join(each)}))"


def _folded(df: DataFrame, keep: list[str], rules: list[Rule], views: str, found: str, decided: str, enough: float) -> DataFrame:
    """Adds to the findings those of the views, layer by layer, until a layer decides.

    The rules run in a step before the fold: analysis takes long over rules within several lambdas.
    """
    hits = F.expr(f"transform(`{views}`, v -> struct(v.layer AS layer, concat(v.more, {_hits_sql(rules)}) AS new))")
    df = computed(df, keep, F.when(F.size(views) > 0, hits).alias("__hits"))
    new = "filter(v.new, n -> NOT exists(a.found, f -> f.policy_id = n.policy_id AND f.location <=> n.location))"
    state = f"struct(concat(a.found, n) AS found, coalesce(a.decided, if(exists(n, x -> x.confidence >= {enough}D), v.layer, NULL)) AS decided)"
    sql = (
        f"aggregate(`__hits`, struct(`{found}` AS found, `{decided}` AS decided), "
        f"(a, v) -> if(a.decided IS NOT NULL AND a.decided <> v.layer, a, aggregate(array({new}), a, (a, n) -> {state})))"
    )
    df = df.withColumn("__state", F.expr(sql))
    rest = [c for c in keep if c not in (found, decided)]
    return computed(
        df, rest, F.coalesce("__state.found", found).alias(found), F.coalesce("__state.decided", decided).alias(decided),
    )


def screened(
    df: DataFrame, parts: list[tuple[str, str]], rules: list[Rule], out_col: str = "findings", decided_col: str = "decided_by",
    enough: float = ENOUGH, depth: Column | None = None, before: Column | None = None,
) -> DataFrame:
    """Adds the findings of the parts (column, location) of each request, and the layer that decided, if one did.

    ``before`` are findings that stand already, ``depth`` the deepest layer of each row. Null texts have no findings.
    """
    keep = df.columns
    hits = []
    for i, (column, location) in enumerate(parts):
        df = apply_rules(df, column, rules, f"__hits{i}", location)
        hits.append(f"__hits{i}")
    found = F.concat(*([] if before is None else [before]), *hits)
    df = computed(df, [*keep], found.cast(FINDINGS).alias(out_col), (F.lit(DEEPEST) if depth is None else F.coalesce(depth, F.lit(DEEPEST))).alias("__depth"))
    state = [out_col, decided_col]
    df = df.withColumn(decided_col, F.when(max_confidence(F.col(out_col)) >= enough, F.lit("rules")))
    open_texts = [F.when(F.col(decided_col).isNull(), F.col(column)) for column, _ in parts]
    folded = [F.when(beyond_ascii(t) & t.rlike(_UNUSUAL), skeleton(t)) for t in open_texts]
    names = [(f"__open{i}", f"__folded{i}", location) for i, (_, location) in enumerate(parts)]
    df = computed(df, [*keep, *state, "__depth"], *(c.alias(n[k]) for k, each in ((0, open_texts), (1, folded)) for c, n in zip(each, names)))
    # A step of its own, since the view takes the list and its size.
    firsts = "".join(sorted({w[0] for w in packs.SHUFFLED}))
    shuffled = f"(?i)(?=[{firsts}])(?:{shuffled_pattern(packs.SHUFFLED)})"
    spelled = []
    for i, (open_name, folded_name, _) in enumerate(names):
        plain = F.coalesce(folded_name, open_name)
        odd = plain.rlike(screen.LEET_NEAR) | plain.rlike(screen.SPACE_BETWEEN)
        spelled.append(only(F.when(odd, screen.deobfuscated(plain)), F.when(plain.rlike(shuffled), unshuffled(plain))).alias(f"__spelled{i}"))
    df = computed(df, [*keep, *state, "__depth", *(n for each in names for n in each[:2])], *spelled)
    by_layer: dict[str, list[Column]] = {name: [] for name, _, _ in LAYERS}
    for i, (open_name, folded_name, location) in enumerate(names):
        text, fold, spelled_i = F.col(open_name), F.col(folded_name), F.col(f"__spelled{i}")
        mixed = F.when(text.rlike(_MIXED), rule_finding(MIXED_SCRIPT, location))
        by_layer["unicode"].append(F.when(fold.isNotNull(), _view("unicode", location, F.array(fold), mixed)))
        by_layer["malformed"].append(F.when(text.rlike(_CONTROL), _view("malformed", location, F.array(F.regexp_replace(text, CONTROL, "")), rule_finding(MALFORMED, location))))
        by_layer["encoding"].append(F.when(text.rlike(screen.HAS_RUN), _view("encoding", location, decoded(text))))
        by_layer["spelling"].append(F.when(F.size(spelled_i) > 0, _view("spelling", location, spelled_i)))
        visual = F.when(crossed_directions(text), _view("visual", location, None, rule_finding(DIRECTION, location)))
        by_layer["visual"].append(F.when((F.col("__depth") >= 6) & beyond_ascii(text) & text.rlike(BIDI), visual))
    views = only(*(view for name, _, _ in LAYERS[:-1] for view in by_layer[name]))
    df = computed(df, [*keep, *state, *(n for n, _, _ in names)], views.alias("__views"))
    df = _folded(df, [*keep, *state, *(n for n, _, _ in names)], rules, "__views", *state, enough)
    mask = cipher_shifts(rules)
    df = df.withColumns({f"__shifts{i}": mask(F.when(F.col(decided_col).isNull(), F.col(n))) for i, (n, _, _) in enumerate(names)})
    ciphers = [
        F.when(F.col(f"__shifts{i}") > 0, _view("cipher", location, deciphered(F.col(n), F.col(f"__shifts{i}")))) for i, (n, _, location) in enumerate(names)
    ]
    df = computed(df, [*keep, *state], only(*ciphers).alias("__views"))
    return _folded(df, [*keep, *state], rules, "__views", *state, enough).select(*keep, *state)


def encoding_bypass(df: DataFrame, text_col: str, rules: list[Rule], out_col: str = "findings") -> DataFrame:
    """Findings of a text once decoded (location `encoding`) and once deciphered (`cipher`)."""
    keep, mask = df.columns, cipher_shifts(rules)
    text = F.col(text_col)
    df = df.withColumn("__shifts", mask(text))
    encoded = F.when(text.rlike(screen.HAS_RUN), F.array_join(decoded(text), "\n"))
    ciphers = F.when(F.col("__shifts") > 0, F.array_join(deciphered(text, F.col("__shifts")), "\n"))
    df = computed(df, keep, encoded.alias("__encoded"), ciphers.alias("__ciphers"))
    df = apply_rules(df, "__encoded", rules, "__f1", "encoding")
    df = apply_rules(df, "__ciphers", rules, "__f2", "cipher")
    return df.withColumn(out_col, F.concat("__f1", "__f2").cast(FINDINGS)).select(*keep, out_col)


def tier_depth(tier: Column) -> Column:
    """The deepest layer of a tier; unknown and missing tiers have the least."""
    least = min(depth for _, depth, *_ in fixed.TIERS)
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for name, depth, *_ in fixed.TIERS for x in (name, depth))), tier), F.lit(least))
