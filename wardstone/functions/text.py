"""Regular-expression dialect and text helpers.

Detector patterns are written with ECMAScript boundaries and classes. ``java_pattern`` rewrites
them so that Java's engine gives the same answers: word boundaries and word characters are
ASCII only, and white space is the ECMAScript set (which has NBSP, BOM and vertical tab).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = "A-Za-z0-9_"
SPACE = r"\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"
NOT_AFTER_WORD = f"(?<![{WORD}])"
NOT_BEFORE_WORD = f"(?![{WORD}])"
BOUNDARY = f"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"

_TOKEN = re.compile(r"\\.|\[\^?|\]|.", re.S)


def java_pattern(
    pattern: str, ignore_case: bool = False, word_start: bool = False, word_end: bool = False
) -> str:
    """Java form of an ECMAScript pattern.

    ``word_start`` / ``word_end`` say that whatever follows a leading ``\\b`` / precedes a
    trailing ``\\b`` is always a word character; the boundary then needs a single look-around.
    """
    tokens = _TOKEN.findall(pattern)
    out, in_class = [], False
    for i, tok in enumerate(tokens):
        if tok.startswith("["):
            in_class = True
        elif tok == "]":
            in_class = False
        elif tok == r"\s":
            tok = SPACE if in_class else f"[{SPACE}]"
        elif tok == r"\S" and not in_class:
            tok = f"[^{SPACE}]"
        elif tok == r"\b" and not in_class:
            if word_start and i == 0:
                tok = NOT_AFTER_WORD
            elif word_end and i == len(tokens) - 1:
                tok = NOT_BEFORE_WORD
            else:
                tok = BOUNDARY
        out.append(tok)
    body = "".join(out)
    if body.startswith(NOT_AFTER_WORD + r"\d"):
        # The digit test comes first: nearly every position fails it, and it is the cheaper one.
        head = r"\d" + f"(?<![{WORD}]" + r"\d)"
        rest = body[len(NOT_AFTER_WORD) + 2 :]
        if rest.startswith("{3}"):
            body = head + r"\d{2}" + rest[3:]
        elif rest.startswith("+"):
            body = head + r"\d*" + rest[1:]
    return ("(?i)" if ignore_case else "") + body


_PARTS = re.compile(r"\\x\{[^}]*\}|\\x..|\\u....|\\[pP]\{[^}]*\}|\\.|(?:A-Z|a-z|0-9)(?!-[^\]])|.", re.S)
_SINGLES = {f"{a}-{z}": "".join(map(chr, range(ord(a), ord(z) + 1))) for a, z in ("AZ", "az", "09")}
_WIDE_SPACE = SPACE[SPACE.index(r"\u1680") :]


def quick_classes(pattern: str) -> str:
    """The same Java pattern with classes that are tested at once.

    Java asks the ranges of a class one after the other, and looks single characters below 256 up in a table; so the
    ranges of ASCII letters and digits are spelled out, and the spaces beyond are behind one range that holds them.
    """
    out, depth, last, literal = [], 0, "", False
    for part in _PARTS.findall(pattern.replace(_WIDE_SPACE, rf"[\u1680-\uFEFF&&[{_WIDE_SPACE}]]")):
        if part == r"\Q":
            literal = True
        elif part == r"\E":
            literal = False
        elif not literal:
            if part == "[":
                depth += 1
            elif part == "]" and depth:
                depth -= 1
            elif part in _SINGLES and depth and last != "-":
                part = _SINGLES[part]
        out.append(part)
        last = part
    return "".join(out)


def leads_with_word(pattern: str) -> bool:
    """Whether a pattern is ``\\b`` and then always a letter, digit or underscore."""
    if not pattern.startswith(r"\b"):
        return False
    rest = pattern[2:]
    if not rest.startswith("(?:"):
        return re.match(r"[A-Za-z0-9_](?![?*{])", rest) is not None
    depth, starts, i = 0, [], 0
    while i < len(rest):
        if rest[i] == "\\":
            i += 2
            continue
        if rest[i] == "(":
            depth += 1
            if depth == 1:
                starts.append(i + 3)
        elif rest[i] == ")":
            depth -= 1
            if depth == 0:
                break
        elif rest[i] == "|" and depth == 1:
            starts.append(i + 1)
        i += 1
    required = rest[i + 1 : i + 2] not in ("?", "*", "{")
    return required and all(re.match(r"[A-Za-z0-9_](?![?*{])", rest[j:]) for j in starts)


def missing(col: Column) -> Column:
    """True for null and for the empty string."""
    return F.coalesce(col, F.lit("")) == ""


def truthy(col: Column) -> Column:
    """The value, or null where it is missing or empty."""
    return F.nullif(col, F.lit(""))


def contains_any(col: Column, words: list[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | col.contains(word)
    return found


def kilobytes(chars: Column) -> Column:
    """Size in KB, halves rounded up."""
    return F.floor(chars / 1024 + F.lit(0.5)).cast("long")
