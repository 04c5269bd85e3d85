"""Surrogates for personal data and secrets.

Every entity found is replaced by another of its kind, drawn by a keyed hash of kind and canonical form, so one entity
gets one surrogate wherever and however it is written, and nobody without the key can draw it. Numbers keep their layout,
cards their Luhn and IBANs their mod-97 validity, telephone numbers their country code, letters their script and case. Names are found by
their titles, replaced word by word, and again wherever the document repeats them; given names follow the gender of the
title and the script. Entities are checked over all documents: no two may get one surrogate, and none that of an entity
that occurs. Where that happens, the one with the fewer draws, then the smaller one, keeps it, and the others draw again.

Only entities that drew more than once are sent to the documents; all others are drawn on the spot.

Defined results: null texts stay null. Overlapping finds go to the earlier, then to the kind named first in `KINDS`.
Repeated rows get equal texts. Extra columns pass through `replaced`.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from wardstone.llm.storage import cut
from wardstone.llm.text import pieces

#: Titles, with the gender they tell.
TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Dr": "n", "Prof": "n", "Herr": "m", "Herrn": "m", "Frau": "f",
    "Monsieur": "m", "Madame": "f", "Mme": "f", "Mlle": "f", "Señor": "m", "Señora": "f", "Señorita": "f", "Sr": "m", "Sra": "f", "Srta": "f", "Don": "m", "Doña": "f",
    "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f",
}
_TITLE = "|".join(sorted(TITLES, key=len, reverse=True))
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_UPPER, _LOWER = "A-ZÀ-ÖØ-ÞĀĂĄĆČĎĐĒĘĚĞİŁŃŇŐŘŚŠŤŮŰŹŻŽΑ-ΩА-ЯЁ", "a-zà-öø-ÿāăąćčďđēęěğıłńňőřśšťůűźżžά-ώа-яё"
_NAME_WORD = f"[{_UPPER}][{_LOWER}]+(?:[-'’][{_UPPER}][{_LOWER}]+)*"

#: In order of precedence: pattern, and the characters one of which a text must hold to be searched.
KINDS: dict[str, tuple[re.Pattern, str]] = {
    "email": (re.compile(r"(?<![\w.+%-])[\w.+%-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}"), "@"),
    "iban": (re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"), "0123456789"),
    "card": (re.compile(r"(?<![0-9.-])(?:[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[47][0-9]{2}([ -]?)[0-9]{6}\2[0-9]{5})(?![0-9]|[.-][0-9])"), "0123456789"),
    "phone": (re.compile(r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}|\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4})(?![0-9])"), "0123456789"),
    "ssn": (re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), "-"),
    "ip": (re.compile(rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"), "."),
    "access_key": (re.compile(r"\b(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk[-_][A-Za-z0-9_-]{16,}|xox[abprs]-[A-Za-z0-9-]{10,})\b"), "AgsxAKIA"),
    "secret": (re.compile(r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b[\"']?[ \t]*[=:][ \t]*[\"']?(?P<own>[^\s\"']{6,})"), "=:"),
    "name": (re.compile(rf"\b(?P<title>{_TITLE})\.?[  ](?P<own>{_NAME_WORD}(?: {_NAME_WORD}){{0,2}})"), ""),
}
_DIGITS = re.compile("[^0-9]")
_ANY_TITLE = re.compile(rf"\b(?:{_TITLE})\.?[  ]")
_ANY_DIGIT = re.compile("[0-9]")

#: Syllables of drawn names by script, and endings of given names by script and gender.
SYLLABLES = {
    "latin": ["ba", "be", "da", "do", "fa", "ga", "ha", "jo", "ka", "ke", "la", "le", "lo", "ma", "me", "mi", "na", "ne", "no", "pa", "ra", "re", "ro", "sa", "so", "ta", "te", "vi", "va", "wi"],
    "cyrillic": ["ба", "ве", "га", "да", "до", "за", "ка", "ко", "ла", "ле", "ма", "ми", "на", "не", "по", "ра", "ро", "са", "та", "фе"],
    "greek": ["βα", "γε", "δα", "δη", "ζα", "θε", "κα", "κο", "λα", "λε", "μα", "μι", "να", "νε", "πα", "ρα", "ρο", "σα", "τα", "φε"],
}
ENDINGS = {
    "latin": {"m": ["rd", "n", "s", "rt"], "f": ["lia", "na", "tta", "ra"], "n": ["l", "m", "x", "y"]},
    "cyrillic": {"m": ["н", "р", "й", "в"], "f": ["на", "ра", "лия", "я"], "n": ["ль", "м", "т", "к"]},
    "greek": {"m": ["ς", "νος", "ρος", "λης"], "f": ["νη", "ρα", "λια", "νια"], "n": ["ν", "ξ", "ρ", "ι"]},
}


def script_of(text: str) -> str:
    for x in text:
        if x.isalpha():
            name = unicodedata.name(x, "").split(" ")[0].lower()
            return name if name in SYLLABLES else "latin"
    return "latin"


class Draw:
    """A stream of numbers from a keyed hash."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int):
        self.seed, self.turn, self.state = f"{kind}\0{entity}\0{attempt}".encode("utf-8", "surrogatepass"), 0, b""
        self.key = key

    def below(self, n: int) -> int:
        if len(self.state) < 4:
            self.state += blake2b(self.seed + self.turn.to_bytes(4, "big"), key=self.key, digest_size=64).digest()
            self.turn += 1
        value, self.state = int.from_bytes(self.state[:4], "big"), self.state[4:]
        return value % n

    def alike(self, text: str) -> str:
        """Letters for letters of their script and case, digits for digits, the rest as it is."""
        return "".join(self._alike(x) for x in text)

    def _alike(self, x: str) -> str:
        if "0" <= x <= "9":
            return chr(48 + self.below(10))
        for low, high in (("a", "z"), ("A", "Z"), ("а", "я"), ("А", "Я"), ("α", "ω"), ("Α", "Ω")):
            if low <= x <= high:
                y = chr(ord(low) + self.below(ord(high) - ord(low) + 1))
                return y if y.isalpha() and y != "ς" else low
        return chr(97 + self.below(26)) if x.isalpha() else x


def luhn_digit(digits: str) -> str:
    """The check digit that completes a number."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def iban_check(country: str, account: str) -> str:
    number = "".join(str(int(x, 36)) for x in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def iban_holds(iban: str) -> bool:
    return iban[2:4] == iban_check(iban[:2], iban[4:])


def drawn(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """The surrogate of an entity in canonical form. Later attempts may be longer where short ones run out."""
    draw = Draw(key, kind, entity, attempt)
    longer = attempt // 8
    if kind == "email":
        local, _, domain = entity.partition("@")
        host, _, top = domain.rpartition(".")
        return f"{draw.alike(local + 'a' * longer)}@{draw.alike(host)}.{top}"
    if kind == "card":
        body = entity[0] + draw.alike(entity[1:-1])
        return body + (luhn_digit(body) if luhn_digit(entity[:-1]) == entity[-1] else draw.alike(entity[-1]))
    if kind == "phone":
        country = max(1, len(entity) - 10)
        return entity[:country] + draw.alike(entity[country:])
    if kind == "ip":
        return ".".join(str(draw.below(256) if 0 < i < 3 else 1 + draw.below(223 if i == 0 else 254)) for i in range(4))
    if kind == "iban":
        account = draw.alike(entity[4:])
        return entity[:2] + iban_check(entity[:2], account) + account
    if kind == "access_key":
        head = re.match(r"AKIA|ASIA|gh._|sk[-_]|xox.-", entity)[0]
        return head + draw.alike(entity[len(head) :])
    if kind == "secret" and re.fullmatch("[0-9a-f]+", entity):
        return "".join("0123456789abcdef"[draw.below(16)] for _ in entity)
    if kind.startswith("given") or kind == "family":
        script = script_of(entity)
        parts = [SYLLABLES[script][draw.below(len(SYLLABLES[script]))] for _ in range(2 + draw.below(2) + longer)]
        if kind != "family":
            ends = ENDINGS[script][kind[-1]]
            parts.append(ends[draw.below(len(ends))])
        return "".join(parts)
    return draw.alike(entity) + draw.alike("a" * longer)


# Finding and rendering


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """Begin, end, kind and canonical form of every entity, in order, without overlaps."""
    found = []
    has_digit = None
    for rank, (kind, (pattern, gate)) in enumerate(KINDS.items()):
        if kind == "name":
            if not _ANY_TITLE.search(text):
                continue
        elif gate == "0123456789":
            has_digit = _ANY_DIGIT.search(text) is not None if has_digit is None else has_digit
            if not has_digit:
                continue
        elif not any(x in text for x in gate):
            continue
        for match in pattern.finditer(text):
            begin, end = match.span("own") if "own" in pattern.groupindex else match.span()
            own = text[begin:end]
            if kind == "iban" and not iban_holds(own.replace(" ", "")):
                continue
            if kind == "name":
                gender, at = TITLES[match["title"]], begin
                words = own.split(" ")
                for i, word in enumerate(words):
                    given = i < len(words) - 1
                    found.append((at, rank, at + len(word), f"given_{gender}" if given else "family", word.lower()))
                    at += len(word) + 1
                continue
            found.append((begin, rank, end, kind, canonical(kind, own)))
    names = {word: kind for _, _, _, kind, word in found if kind == "family" or kind.startswith("given")}
    if names:
        again = re.compile(r"\b(?:" + "|".join(re.escape(x.capitalize()) for x in sorted(names, key=len, reverse=True)) + r")\b")
        found += [(m.start(), len(KINDS), m.end(), names[m[0].lower()], m[0].lower()) for m in again.finditer(text) if m[0].lower() in names]
    out, reached = [], 0
    for begin, _, end, kind, own in sorted(found):
        if begin >= reached:
            out.append((begin, end, kind, own))
            reached = end
    return out


def canonical(kind: str, own: str) -> str:
    if kind in ("card", "ssn"):
        return _DIGITS.sub("", own)
    if kind == "phone":
        digits = _DIGITS.sub("", own)
        return digits if own.startswith("+") else "1" + digits
    if kind == "iban":
        return own.replace(" ", "")
    return own.lower() if kind == "email" else own


def rendered(kind: str, own: str, surrogate: str) -> str:
    """The surrogate laid out as the mention was."""
    if kind in ("card", "ssn", "phone"):
        digits = iter(surrogate[-len(_DIGITS.sub("", own)) :])
        return "".join(next(digits) if "0" <= x <= "9" else x for x in own)
    if kind == "iban":
        letters = iter(surrogate)
        return "".join(x if x == " " else next(letters) for x in own)
    if kind == "family" or kind.startswith("given"):
        return surrogate.capitalize()
    if kind == "email" and own.isupper():
        return surrogate.upper()
    return surrogate


# Over all documents


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc", pa.int64()), ("uid", pa.int64()), ("kind", pa.string()), ("entity", pa.string())])
    for batch in pieces(batches):
        rows = []
        for doc, uid, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            rows += [(doc, uid, *x) for x in sorted({(kind, own) for _, _, kind, own in entities(text or "")})]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _with_surrogate(key: bytes):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, own, attempt = (batch.column(c).to_pylist() for c in ("kind", "entity", "attempt"))
            new = [drawn(key, *x) for x in zip(kind, own, attempt)]
            # Given names of either gender and family names share one space: all are words of a name.
            spaces = ["name" if k == "family" or k.startswith("given") else k for k in kind]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("kind", "entity", "attempt")), pa.array(new, pa.string()), pa.array(spaces, pa.string())], names=["kind", "entity", "attempt", "surrogate", "space"])

    return of


def assignments(found: DataFrame, key: bytes) -> DataFrame:
    """kind, entity, attempt, surrogate of every distinct entity of found(kind, entity), no surrogate twice."""
    schema = "kind string, entity string, attempt int, surrogate string, space string"
    now = found.select("kind", "entity").distinct().withColumn("attempt", F.lit(0)).repartition("kind", "entity").mapInArrow(_with_surrogate(key), schema)
    while True:
        now = cut(now)
        real = now.select("space", F.col("entity").alias("surrogate")).distinct()
        taken = now.join(real, ["space", "surrogate"], "left_semi").select("kind", "entity")
        rank = F.struct("attempt", "entity", "kind")
        shared = now.groupBy("space", "surrogate").agg(F.min(rank).alias("first"), F.max(rank).alias("last")).where("first <> last").select("space", "surrogate", "first")
        losers = now.join(shared, ["space", "surrogate"]).where(rank != F.col("first")).select("kind", "entity")
        again = cut(taken.unionAll(losers).distinct())
        if again.isEmpty():
            return now.drop("space")
        redrawn = now.join(again, ["kind", "entity"]).select("kind", "entity", (F.col("attempt") + 1).alias("attempt")).mapInArrow(_with_surrogate(key), schema)
        now = now.join(again, ["kind", "entity"], "left_anti").select("kind", "entity", "attempt", "surrogate", "space").unionAll(redrawn)


def _replaced(key: bytes, names: list[str]):
    kind_of = pa.struct([("text", pa.string()), ("n_entities", pa.int32()), ("kinds", pa.list_(pa.string()))])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = []
            for text, special in zip(batch.column("text").to_pylist(), batch.column("__special").to_pylist()):
                other = {(x["kind"], x["entity"]): x["surrogate"] for x in special or ()}
                parts, at, kinds = [], 0, []
                for begin, end, kind, own in entities(text or ""):
                    new = other.get((kind, own)) or drawn(key, kind, own, 0)
                    parts += [text[at:begin], rendered(kind, text[begin:end], new)]
                    at = end
                    kinds.append(kind)
                out.append({"text": "".join([*parts, text[at:]]) if kinds else text, "n_entities": len(kinds), "kinds": sorted(set(kinds))})
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(out, kind_of)], names=[*names, "__out"])

    return of


def replaced(docs: DataFrame, key: bytes) -> DataFrame:
    """docs with one more column, __out: the text with surrogates, the number of entities replaced, and their kinds."""
    keyed = docs.withColumn("__uid", F.xxhash64("doc_id", "text"))
    found = cut(keyed.select("doc_id", "__uid", "text").mapInArrow(_found, "doc long, uid long, kind string, entity string"))
    more = assignments(found, key).where("attempt > 0")
    special = found.join(more, ["kind", "entity"]).groupBy(F.col("doc").alias("__doc"), F.col("uid").alias("__own"))
    special = special.agg(F.collect_list(F.struct("kind", "entity", "surrogate")).alias("__special"))
    joined = keyed.join(special, keyed["doc_id"].eqNullSafe(special["__doc"]) & (keyed["__uid"] == special["__own"]), "left")
    out = StructType([StructField("text", StringType()), StructField("n_entities", IntegerType()), StructField("kinds", ArrayType(StringType()))])
    return joined.mapInArrow(_replaced(key, docs.columns), StructType([*docs.schema.fields, StructField("__out", out)]))
