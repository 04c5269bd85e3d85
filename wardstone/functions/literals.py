"""Literal parts of patterns, and a search for any number of literals in one pass over a text.

``required`` reads from a pattern a set of literals of which every match holds one. ``Literals`` finds where some of many
literals may stand: the first bytes of every position are looked up in flat tables, so the pass takes as long for ten
literals as for a million. What it finds is complete for literals of up to ``DEPTH`` bytes and a superset for longer ones;
a full expression decides.

``differences`` codes a text by the distance of each letter to the letter before it. A Caesar shift leaves this code as it
is and a mirrored alphabet (Atbash) negates it, so one search finds a literal under every shift.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from wardstone.functions.text import SPACE

try:  # the parser behind ``re``, under its names before and after Python 3.11
    from re import _constants as _c
    from re import _parser
except ImportError:  # pragma: no cover
    import sre_constants as _c
    import sre_parse as _parser

#: First bytes of a literal that are looked up, and bytes of it that are compared.
SEED, DEPTH = 4, 16
#: Bytes searched at a time.
SPAN = 1 << 18
#: A set of more literals than this is no help; a literal after more characters than this has no bounded place.
MOST_LITERALS, MOST_BEFORE = 64, 16

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def python_text(pattern: str) -> str:
    """An ECMAScript pattern as Python reads it, given ASCII word characters."""
    out, in_class = [], False
    for token in re.findall(r"\\.|\[\^?|\]|.", pattern, re.S):
        if token.startswith("[") and not in_class:
            in_class = True
        elif token == "[":
            token = r"\["
        elif token == "]":
            in_class = False
        elif token == r"\s":
            token = SPACE if in_class else f"[{SPACE}]"
        elif token == r"\S" and not in_class:
            token = f"[^{SPACE}]"
        out.append(token)
    return "".join(out)


def _weight(found: frozenset[str] | None, letters: bool) -> float:
    """How selective a set of literals is: its shortest literal counts, or its shortest run of letters."""
    if not found or len(found) > MOST_LITERALS:
        return 0.0
    sizes = [max((len(run) for run in re.findall("[a-z]+", x)), default=0) if letters else len(x) for x in found]
    return min(sizes) - len(found) / (4 * MOST_LITERALS)


def _lower(codes: Iterable[int]) -> str:
    return "".join(chr(c).lower() if c < 128 else chr(c) for c in codes)


_WORD_CHARACTERS = "abcdefghijklmnopqrstuvwxyz0123456789_"


def _apart(op, value) -> bool:
    """Whether a parsed element is one character, and never an ASCII letter, digit or underscore of either case."""
    return op is _c.IN and _no_word_character(tuple(value))


@lru_cache(maxsize=1 << 12)
def _no_word_character(value: tuple) -> bool:
    def has(c: str) -> bool:
        for kind, v in value:
            if kind is _c.LITERAL and chr(v) == c or kind is _c.RANGE and v[0] <= ord(c) <= v[1]:
                return True
            if kind is _c.CATEGORY:
                if v is _c.CATEGORY_WORD or v is _c.CATEGORY_NOT_SPACE or (v is _c.CATEGORY_DIGIT) == c.isdigit() and v in (_c.CATEGORY_DIGIT, _c.CATEGORY_NOT_DIGIT):
                    return True
        return False

    negated = value[0][0] is _c.NEGATE
    return all((has(c) or has(c.upper())) == negated for c in _WORD_CHARACTERS)


def _between(op, value) -> bool:
    """Whether a parsed element is one or more such characters."""
    return _apart(op, value) or op in (_c.MAX_REPEAT, _c.MIN_REPEAT) and value[0] >= 1 and len(value[2]) == 1 and _apart(*value[2][0])


@lru_cache(maxsize=1 << 12)
def separates(pattern: str) -> bool:
    """Whether a pattern is one or more characters none of which is an ASCII letter, digit or underscore."""
    try:
        parsed = _parser.parse(python_text(pattern), re.ASCII)
    except re.error:
        return False
    return len(parsed) == 1 and _between(*parsed[0])


def spaced(text: str) -> str:
    """A lower-case text with each run of other characters than ASCII letters, digits and underscores as one space."""
    return re.sub("[^a-z0-9_]+", " ", text)


def _options(parsed, letters: bool, spaces: bool = False) -> list[tuple[frozenset[str], int]]:
    """Sets of literals, every match of a parsed sequence holding one of each, and the place in the sequence where the
    set's literals begin. With ``spaces`` they are literals of spaced texts, and go on over what stands between words."""
    options: list[tuple[frozenset[str], int]] = []
    run, begin = [""], 0  # all forms of the literals that follow each other, and where they begin

    def close(then: int) -> None:
        nonlocal run, begin
        if run != [""]:
            forms = [spaced(x) for x in run] if spaces else run
            opened = any(x.startswith(" ") for x in forms) and spaces  # it may begin anywhere between two words
            options.append((frozenset(x.lstrip(" ") if spaces else x for x in forms), -1 if opened else begin))
        run, begin = [""], then

    for i, (op, value) in enumerate(parsed):
        if op is _c.AT:
            continue
        tails = None
        if op is _c.LITERAL:
            tails = [_lower([value])]
        elif op is _c.SUBPATTERN and all(o is _c.LITERAL for o, _ in value[-1]):
            tails = [_lower(v for _, v in value[-1])]
        elif op is _c.BRANCH and all(o is _c.LITERAL for branch in value[1] for o, _ in branch) and len(run) * len(value[1]) <= MOST_LITERALS:
            tails = [_lower(v for _, v in branch) for branch in value[1]]
        elif spaces and _between(op, value):
            tails = [" "]
        if tails is not None:
            if run == [""]:
                begin = i
            run = [x + tail for x in run for tail in tails]
            continue
        close(i + 1)
        found = None
        if op is _c.BRANCH:
            each = [_needed(branch, letters, spaces) for branch in value[1]]
            found = frozenset().union(*each) if all(each) else None
        elif op is _c.SUBPATTERN:
            found = _needed(value[-1], letters, spaces)
        elif op in (_c.MAX_REPEAT, _c.MIN_REPEAT) and value[0] >= 1:
            found = _needed(value[2], letters, spaces)
        if found:
            options.append((found, -1))  # somewhere within
    close(len(parsed))
    return [(x, at) for x, at in options if _weight(x, letters) > 0]


def _needed(parsed, letters: bool, spaces: bool) -> frozenset[str] | None:
    return max((x for x, _ in _options(parsed, letters, spaces)), key=lambda x: _weight(x, letters), default=None)


@dataclass(frozen=True)
class Needed:
    """Lower-case literals of which every match holds one; the characters before it in the match, where bounded."""

    literals: frozenset[str]
    before: tuple[int, int] | None


def needed(pattern: str, letters: bool = False, spaces: bool = False) -> list[Needed]:
    """The sets of literals of a pattern, the most selective first. Raises ``re.error`` for what is no expression.

    ``letters`` asks for literals that all have letters, and ranks them by those; ``spaces`` for literals of ``spaced``
    texts. The list is empty where a pattern has no literal part.
    """
    parsed = _parser.parse(python_text(pattern), re.ASCII)
    found = []
    for literals, at in _options(parsed, letters, spaces):
        low, high = parsed[:at].getwidth() if at >= 0 else (0, MOST_BEFORE + 1)
        found.append(Needed(literals, (low, high) if high <= MOST_BEFORE else None))
    return sorted(found, key=lambda x: (-_weight(x.literals, letters), sorted(x.literals)))


def required(pattern: str, letters: bool = False) -> list[frozenset[str]]:
    """The sets of literals alone; none where a pattern cannot be read."""
    try:
        return [x.literals for x in needed(pattern, letters)]
    except (re.error, OverflowError, RecursionError):
        return []


class Literals:
    """Many literals as flat tables: sorted seeds of one to ``SEED`` bytes, and the literals that begin with each."""

    def __init__(self, literals: Sequence[bytes]):
        sizes = np.array([len(x) for x in literals], dtype=np.int64)
        self.size = np.minimum(sizes, DEPTH)
        self.bytes = np.zeros((len(literals), DEPTH), dtype=np.uint8)
        for i, literal in enumerate(literals):
            self.bytes[i, : self.size[i]] = np.frombuffer(literal[:DEPTH], dtype=np.uint8)
        self.groups = []
        for n in range(1, SEED + 1):
            own = np.flatnonzero(self.size == n if n < SEED else self.size >= n)
            if len(own):
                keys = self._keys(self.bytes[own].astype(np.uint32), n)
                order = np.argsort(keys, kind="stable")
                seeds, first = np.unique(keys[order], return_index=True)
                marks = np.zeros(1 << 20, dtype=bool)
                marks[self._slot(seeds)] = True
                self.groups.append((n, seeds, np.append(first, len(own)), own[order], marks))

    @staticmethod
    def _keys(columns: np.ndarray, n: int) -> np.ndarray:
        key = columns[..., 0].copy()
        for k in range(1, n):
            key = (key << np.uint32(8)) | columns[..., k]
        return key

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint32(2654435761)) >> np.uint32(12)

    def find(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in the bytes, and the literals that may begin there."""
        positions, literals = [], []
        for begin in range(0, len(data), SPAN):
            part = data[begin : begin + SPAN + DEPTH]
            wide = np.append(part, np.zeros(DEPTH, dtype=np.uint8))
            reach = min(SPAN, len(data) - begin)
            for n, seeds, first, own, marks in self.groups:
                key = wide[:reach].astype(np.uint32)
                for k in range(1, n):
                    key = (key << np.uint32(8)) | wide[k : reach + k]
                at = np.flatnonzero(marks[self._slot(key)])
                seed = np.searchsorted(seeds, key[at])
                hit = seeds[np.minimum(seed, len(seeds) - 1)] == key[at]
                at, seed = at[hit], seed[hit]
                fan = first[seed + 1] - first[seed]
                at = np.repeat(at, fan)
                literal = own[np.repeat(first[seed] - np.append(0, np.cumsum(fan)[:-1]), fan) + np.arange(len(at))] if len(at) else np.zeros(0, np.int64)
                for k in range(n, DEPTH):
                    longer = self.size[literal] > k
                    if not longer.any():
                        break
                    same = ~longer | (self.bytes[literal, k] == wide[at + k])
                    at, literal = at[same], literal[same]
                fits = begin + at + self.size[literal] <= len(data)
                positions.append(begin + at[fits])
                literals.append(literal[fits])
        if not positions:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(positions), np.concatenate(literals)


#: Codes of a letter that follows no letter, and of a letter's distance to the one before it.
_ALONE, _FROM = 0x80, 0x81


def differences(data: np.ndarray, mirrored: bool = False) -> np.ndarray:
    """Lower-case bytes by their differences: letters as distances, other bytes as they are.

    ``mirrored`` gives the negated distances, those of the mirrored alphabet.
    """
    letter = (data >= 97) & (data <= 122)
    out = data.copy()
    out[out >= 0x80] = 0x7F  # no letter, and no code of one
    out[letter] = _ALONE
    follows = letter[1:] & letter[:-1]
    step = (data[1:].astype(np.int16) - data[:-1]) % 26
    if mirrored:
        step = (-step) % 26
    out[1:][follows] = (_FROM + step[follows]).astype(np.uint8)
    return out


def coded(literal: str) -> tuple[bytes, int, int]:
    """A literal as it is searched for: its code without an opening letter, which has no distance yet; the place of its
    first letter as counted from there, and that letter (0 to 25)."""
    data = np.frombuffer(literal.encode(), dtype=np.uint8)
    opens = int(97 <= data[0] <= 122)
    letter = next(i for i, b in enumerate(data) if 97 <= b <= 122)
    return differences(data)[opens:].tobytes(), letter - opens, int(data[letter]) - 97


class Shifts:
    """Alphabet shifts, and the mirror, under which a text may match one of some patterns.

    Each pattern comes as its sets of literals (``required`` with letters): under a shift that can match, the text holds
    one literal of every set. Patterns without a set may match under any.
    """

    #: Bits 1 to 25: that many letters forward undo it; bit 26: the mirror does.
    ALL = (1 << 27) - 2

    def __init__(self, patterns: Iterable[Sequence[frozenset[str]]]):
        patterns = [list(sets) for sets in patterns]
        self.names = sorted({x for sets in patterns for own in sets for x in own})
        number = {x: i for i, x in enumerate(self.names)}
        self.patterns = [[np.array(sorted(number[x] for x in own)) for own in sets] for sets in patterns]
        codes = [coded(x) for x in self.names]
        self.free = np.array([i for i, (code, _, _) in enumerate(codes) if not code], dtype=np.int64)  # of one letter: stands anywhere
        self.own = np.array([i for i, (code, _, _) in enumerate(codes) if code], dtype=np.int64)
        self.search = Literals([codes[i][0] for i in self.own])
        self.place = np.array([codes[i][1] for i in self.own], dtype=np.int64)
        self.letter = np.array([codes[i][2] for i in self.own], dtype=np.int64)

    def of(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """A bit mask for each text of lower-case bytes, which bounds divide."""
        n = len(bounds) - 1
        seen = np.zeros((n, len(self.names)), dtype=np.int64)
        seen[:, self.free] = self.ALL
        for mirrored in (False, True) if len(self.own) else ():
            at, literal = self.search.find(differences(data, mirrored))
            first = at + self.place[literal]
            inside = (first >= 0) & (first < len(data))
            literal, first = literal[inside], first[inside]
            letter = data[first].astype(np.int64) - 97
            apart = self.letter[literal] + letter if mirrored else (self.letter[literal] - letter) % 26
            bit = np.where(apart == 25, 26, 0) if mirrored else apart
            real = (letter >= 0) & (letter < 26) & (bit > 0)
            row = np.searchsorted(bounds, first[real], side="right") - 1
            np.bitwise_or.at(seen, (row, self.own[literal[real]]), np.int64(1) << bit[real])
        out = np.zeros(n, dtype=np.int64)
        for sets in self.patterns:
            mask = np.full(n, self.ALL)
            for own in sets:
                mask &= np.bitwise_or.reduce(seen[:, own], axis=1)
            out |= mask
        return out
