"""Rule tables too large for one task, matched by a join on literals.

Rules are parsed where they lie. Each comes with a few sets of literals of which a match holds one each, and a literal with
a hash of its first ``LONGEST`` bytes, its key. A bitmap of bounded size says in every task where in a text a key may
begin; those keys, with their places, are what the texts send. A rule asks by the set whose keys stand in the fewest texts,
so only rules that a text may match meet it, and the full expression then decides from those places on. Phrases, words with
separators between them, are read without a parser and share one expression for all of one form, whose words are compared;
so a hundred thousand of them need not be compiled again for each text. A phrase between word boundaries has a key of its
own, which only places between word boundaries have. Texts with equal
content are looked up once. Work and shuffles grow with the texts, the rules and the pairs that meet: no text is read once
for each block of rules, and neither the rules nor what is made of them pass through the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstone.functions.literals import LOWER, Needed, needed, python_text, separates
from wardstone.sources.tables import cut

#: Sets of a rule that are kept, bytes of a literal that its key is made of, bytes of the seed that is looked up first.
SETS, LONGEST, SEED = 3, 32, 4
#: Bits of the bitmap for each key, and in all; bytes of text that are hashed, and that are searched, together.
BITS_EACH, MOST_BITS, PART, SPAN = 32, 1 << 28, 1 << 18, 1 << 20
#: How many texts with a bounded place are as costly as one that must be searched as a whole.
SEARCHED = 16

#: Tells the key of a literal between word boundaries from the key of the same literal anywhere.
WHOLE = 0x5BD1E9955BD1E995

_WORD = np.array([chr(b).isalnum() and b < 128 or b == 95 for b in range(256)])
_VALUE = np.random.default_rng(20_240_301).integers(1, 1 << 63, 256, dtype=np.uint64)
_FACTOR = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.append(np.uint64(1), np.full(PART + LONGEST, _FACTOR, dtype=np.uint64)))
_INVERSE = np.cumprod(np.append(np.uint64(1), np.full(PART + LONGEST, pow(_FACTOR, -1, 1 << 64), dtype=np.uint64)))

RULE = "rule_id string, threat_type string, severity string, confidence double, pattern string, action string, layer string"
PARSED = f"{RULE}, bad boolean, sets array<struct<keys:array<bigint>,low:int,high:int>>, marks array<bigint>, sizes array<int>"


@lru_cache(maxsize=1 << 15)
def compiled(pattern: str) -> re.Pattern:
    return re.compile(python_text(pattern), re.ASCII | re.IGNORECASE)


_SEPARATOR = r"(?:\[\^?[^\^\[\]\\][^\[\]\\]*\]|\\[sW])\+?"
_PHRASE = re.compile(rf"(\\b)?([A-Za-z0-9_]+)((?:{_SEPARATOR}[A-Za-z0-9_]+)*)(\\b)?")
_NEXT = re.compile(rf"({_SEPARATOR})([A-Za-z0-9_]+)")


@lru_cache(maxsize=1 << 12)
def _form(lead: str | None, separators: tuple[str, ...]) -> re.Pattern | None:
    """The expression of all phrases of a form, with a group for each word; none where a separator could be part of a word."""
    if not all(separates(x) for x in separators):
        return None
    return re.compile((lead or "") + "([a-z0-9_]+)" + "".join(python_text(x) + "([a-z0-9_]+)" for x in separators), re.ASCII | re.IGNORECASE)


def phrase(pattern: str | None) -> tuple[re.Pattern, tuple[str, ...], bool, bool] | None:
    """The form of a pattern that is a phrase, its words in lower case, whether the last one must end there, and whether the
    first one must also begin there."""
    found = _PHRASE.fullmatch(pattern) if pattern else None
    if found is None:
        return None
    lead, first, rest, end = found.groups()
    more = _NEXT.findall(rest)
    form = _form(lead, tuple([x for x, _ in more]))
    return None if form is None else (form, (first.lower(), *[word.lower() for _, word in more]), end is not None, end is not None and lead is not None)


def _says(found: re.Match | None, words: tuple[str, ...], ends: bool) -> bool:
    """Whether a match of a form has a phrase's words. Between separators a word is all there is, so no other match could."""
    if found is None:
        return False
    said = tuple([x.lower() for x in found.groups()])
    return said == words if ends else said[:-1] == words[:-1] and said[-1].startswith(words[-1])


def matches(pattern: str, before: tuple[int, int] | None, text: str, places: list[int]) -> bool:
    """Whether a pattern matches, where its literal begins at one of the places, after so many characters of a match."""
    if before == (0, 0) and (one := phrase(pattern)) is not None:
        return any(_says(one[0].match(text, at), one[1], one[2]) for at in places)
    expression = compiled(pattern)
    if before is None:
        return expression.search(text) is not None
    return any(expression.match(text, at - k) for at in places for k in range(before[0], before[1] + 1) if at >= k)


def spaced_bytes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes with whatever stands between words as one space: those bytes, where they stood, and the bounds."""
    kept = _WORD[data]
    kept[1:] |= kept[:-1]  # a word, and the first byte after one
    kept[bounds[:-1][bounds[:-1] < len(data)]] = True
    byte = np.flatnonzero(kept)
    return np.where(_WORD[data[byte]], data[byte], np.uint8(32)), byte, np.searchsorted(byte, bounds)


class _Hashes:
    """Hashes of the substrings of up to PART + LONGEST bytes."""

    def __init__(self, data: np.ndarray):
        self.sums = np.append(np.uint64(0), np.cumsum(_VALUE[data] * _POWERS[: len(data)], dtype=np.uint64))

    def of(self, at: np.ndarray, size, salt: int = 0) -> np.ndarray:
        size = np.asarray(size, dtype=np.int64)
        h = (self.sums[at + size] - self.sums[at]) * _INVERSE[at] + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(salt)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(32))


def _hashed(literals: list[bytes], salt: int = 0) -> np.ndarray:
    """Hashes of whole literals of up to LONGEST bytes."""
    out, step = [], PART // LONGEST
    for begin in range(0, len(literals), step):
        own = literals[begin : begin + step]
        ends = np.append(0, np.cumsum([len(x) for x in own])).astype(np.int64)
        out.append(_Hashes(np.frombuffer(b"".join(own), dtype=np.uint8)).of(ends[:-1], np.diff(ends), salt))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def _keys(literals: list[tuple[bytes, bool]]) -> dict[tuple[bytes, bool], int]:
    """The key of each literal, given whether it stands between word boundaries."""
    hashed = _hashed([x for x, _ in literals]) ^ np.where([whole for _, whole in literals], np.int64(WHOLE), np.int64(0))
    return dict(zip(literals, hashed.tolist()))


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bad, sets = [], []  # of each pattern its sets: the literals, whether they stand between word boundaries, what comes before
        for pattern in batch.column("pattern").to_pylist():
            try:
                if (one := phrase(pattern)) is not None:
                    said = " ".join(one[1]).encode()
                    sets.append([([(said[:LONGEST], one[3] and len(said) <= LONGEST)], (0, 0))])
                else:
                    sets.append([([(x.encode()[:LONGEST], False) for x in s.literals], s.before) for s in needed(pattern, spaces=True)[:SETS]])
                bad.append(False)
            except (TypeError, re.error, OverflowError, RecursionError):
                sets.append([])
                bad.append(True)
        literals = sorted({x for own in sets for found, _ in own for x in found})
        key = _keys(literals)
        long = sorted({x[:SEED] for x, _ in literals if len(x) > SEED})
        seed = dict(zip(long, _hashed(long, 1).tolist()))
        rows, marks, sizes = [], [], []
        for own in sets:
            found = {x for each, _ in own for x in each}
            rows.append([{"keys": sorted({key[x] for x in each}), "low": before[0] if before else None, "high": before[1] if before else None} for each, before in own])
            marks.append([*(key[x] for x in found), *{seed[x[:SEED]] for x, _ in found if len(x) > SEED}])
            sizes.append(sorted({-len(x) if whole else len(x) for x, whole in found}))
        kinds = [pa.bool_(), pa.list_(pa.struct([("keys", pa.list_(pa.int64())), ("low", pa.int32()), ("high", pa.int32())])), pa.list_(pa.int64()), pa.list_(pa.int32())]
        more = [pa.array(c, k) for c, k in zip((bad, rows, marks, sizes), kinds)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "bad", "sets", "marks", "sizes"])


def parsed(rules: DataFrame) -> DataFrame:
    """The rules with their sets of literals, computed once."""
    kinds = [f.split() for f in RULE.split(", ")]
    rows = rules.select(*((F.col(c) if c in rules.columns else F.lit(None)).cast(kind).alias(c) for c, kind in kinds))
    return cut(rows.mapInArrow(_parsed, PARSED).withColumn("rule", F.monotonically_increasing_id()))


def _bitmap(rules: DataFrame) -> np.ndarray:
    marks = rules.select(F.explode("marks").alias("h"))
    bits = 1 << min(MOST_BITS.bit_length() - 1, max(10, (BITS_EACH * marks.count()).bit_length()))
    places = [F.col("h").bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned("h", 34).bitwiseAND(F.lit(bits - 1))]
    words = marks.select(F.explode(F.array(*places)).alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
    found = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("bits")).toArrow()  # at most MOST_BITS / 64 rows
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _keys_found(marks: np.ndarray, sizes: list[int]):
    """A function of batches (text_key, text): text_key, key, places of the keys that a text may hold. sizes are those of
    literals, those between word boundaries below 0."""
    mask = np.uint64(64 * len(marks) - 1)
    whole, open_ = sorted(-n for n in sizes if n < 0), sorted(n for n in sizes if n > 0)

    def marked(h: np.ndarray) -> np.ndarray:
        first, second = h & mask, (h >> np.uint64(34)) & mask
        hit = (marks[first >> np.uint64(6)] >> (first & np.uint64(63))) & (marks[second >> np.uint64(6)] >> (second & np.uint64(63)))
        return (hit & np.uint64(1)).astype(bool)

    def places(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, key, size = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        word = _WORD[data]
        begins, ends = np.append(True, ~word), np.append(~word, True)  # a word may begin, or have ended, before a byte
        begins[bounds] = ends[bounds] = True
        for begin in range(0, len(data), PART):
            part = data[begin : begin + PART + LONGEST]
            hashes, every = _Hashes(part), np.arange(min(PART, len(part)))

            def seeds(own: np.ndarray, most: int) -> np.ndarray:
                own = own[own + SEED <= len(part)]
                return own[marked(hashes.of(own, SEED, 1))] if most > SEED else own

            def found(own: np.ndarray, n: int, salt: int) -> None:
                h = hashes.of(own, n) ^ np.uint64(salt)
                hit = marked(h)
                at.append(begin + own[hit])
                key.append(h[hit])
                size.append(np.full(len(at[-1]), n))

            seeded = seeds(every, open_[-1]) if open_ else every
            for n in open_:
                own = every if n <= SEED else seeded
                found(own[own + n <= len(part)], n, 0)
            first = every[begins[begin : begin + len(every)]] if whole else every
            seeded = seeds(first, whole[-1]) if whole else first
            for n in whole:
                own = first if n <= SEED else seeded
                own = own[own + n <= len(part)]
                found(own[ends[begin + own + n]], n, WHOLE)
        return np.concatenate(at), np.concatenate(key), np.concatenate(size)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string())
            bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
            raw, begin = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8), 0
            while begin < len(texts):
                end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + SPAN, side="right")) - 1)
                data, own = raw[bounds[begin] : bounds[end]], bounds[begin : end + 1] - bounds[begin]
                spaced, byte, inner = spaced_bytes(LOWER[data], own)
                at, key, size = places(spaced, inner)
                row = np.searchsorted(inner, at, side="right") - 1
                inside = at + size <= inner[row + 1]
                at, key, row = byte[at[inside]], key[inside].view(np.int64), row[inside]
                characters = np.append(0, np.cumsum((data & 0xC0) != 0x80))  # characters that begin before a byte
                place = characters[at] - characters[own[row]]
                order = np.lexsort((place, key, row))
                row, key, place = row[order], key[order], place[order]
                first = np.flatnonzero(np.append(True, (np.diff(row) != 0) | (np.diff(key) != 0))) if len(row) else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)).astype(np.int32)), pa.array(place.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("text_key").take(pa.array(begin + row[first])), pa.array(key[first]), lists], names=["text_key", "key", "places"])
                begin = end

    return of


def _matched(texts: pa.Array, rules: pa.Array) -> pa.Array:
    """Places, in the list of a text's candidates, of those that match: each rule once, by rule id and pattern."""
    ends, every = rules.offsets.to_numpy().tolist(), rules.values
    own = every.slice(ends[0], ends[-1] - ends[0])
    rule, low, high = (own.field(name).fill_null(-1).to_numpy(zero_copy_only=False).tolist() for name in ("rule", "low", "high"))
    rule_id, pattern = (own.field(name).to_numpy(zero_copy_only=False).tolist() for name in ("rule_id", "pattern"))
    held = own.field("places")
    first, places = held.offsets.to_numpy().tolist(), held.values.to_numpy(zero_copy_only=False).tolist()
    out = []
    for k, text in enumerate(texts):
        found: dict[int, tuple] = {}
        begin, end = ends[k] - ends[0], ends[k + 1] - ends[0]
        if begin < end and text.is_valid and rules[k].is_valid:
            whole = text.as_py()
            for i in range(begin, end):
                if rule[i] not in found and matches(pattern[i], None if low[i] < 0 else (low[i], high[i]), whole, places[first[i] : first[i + 1]]):
                    found[rule[i]] = (rule_id[i] or "None", pattern[i], rule[i], i - begin)
        out.append([x[-1] for x in sorted(found.values())])
    return pa.array(out, pa.list_(pa.int32()))


def apply_index(df: DataFrame, text_col: str, rules: DataFrame, finding, out_col: str) -> DataFrame:
    """Adds the findings, made of a rule's columns by ``finding``, of parsed rules that all have sets of literals."""
    sizes = sorted(r[0] for r in rules.select(F.explode("sizes")).distinct().collect())  # at most twice LONGEST
    text_key = F.unhex(F.sha2(F.col(text_col), 256))
    texts = df.where(F.col(text_col).isNotNull()).select(text_key.alias("text_key"), F.col(text_col).cast("string").alias("text"))
    found = texts.mapInArrow(_keys_found(_bitmap(rules), sizes), "text_key binary, key long, places array<int>")

    asked = rules.select("rule", F.posexplode("sets").alias("set", "s")).select("rule", "set", F.col("s.low").isNotNull().alias("bounded"), F.explode("s.keys").alias("key"))
    found = found.join(asked.select("key").distinct(), "key", "left_semi")
    found = cut(found.groupBy("text_key", "key").agg(F.first("places").alias("places")))

    # By which set a rule asks: the one whose keys stand in the fewest texts. A set without any rules the rule out.
    texts_of = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    costs = asked.join(texts_of, "key", "left").groupBy("rule", "set", "bounded").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    cost = F.col("n") * F.when(F.col("bounded"), 1).otherwise(SEARCHED)
    chosen = costs.groupBy("rule").agg(F.min(F.struct(cost.alias("cost"), "set")).alias("best")).where("best.cost > 0").select("rule", "best.set")

    one = rules.join(chosen, "rule").withColumn("s", F.col("sets")[F.col("set")])
    keyed = one.select(F.explode("s.keys").alias("key"), F.struct("rule", "rule_id", "pattern", "s.low", "s.high").alias("r"), finding.alias("f"))
    met = found.join(keyed, "key").groupBy("text_key").agg(F.collect_list(F.struct("r", "places", "f")).alias("__met"))
    rows = df.withColumn("__text_key", text_key).join(met.withColumnRenamed("text_key", "__text_key"), "__text_key", "left")
    given = F.transform("__met", lambda x: F.struct(*(x["r"][c].alias(c) for c in ("rule", "rule_id", "pattern", "low", "high")), x["places"].alias("places")))
    rows = rows.withColumn("__at", F.arrow_udf(_matched, "array<int>")(F.col(text_col), given))
    return rows.withColumn(out_col, F.transform("__at", lambda i: F.get(F.col("__met"), i)["f"])).drop("__text_key", "__met", "__at")
