"""Words of whole texts as hashes, computed over Arrow buffers in bounded blocks.

A word is a maximal run of bytes that are no separators; ASCII letters are lower-cased. Every function here is plain
arithmetic on the bytes of a batch, so it behaves alike on one short text and on one very long one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
BATCH_BYTES = 1 << 20

_STEP = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_STEP, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True
#: Everything in ASCII but letters and digits.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


class _Powers:
    """Powers of one odd number modulo 2 to the 64, as far as needed yet."""

    def __init__(self, base: int):
        self.base, self.values = np.uint64(base), np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            steps = np.full(max(n, 2 * len(self.values)), self.base, dtype=np.uint64)
            steps[0] = 1
            self.values = np.multiply.accumulate(steps)
        return self.values[:n]


_UP, _DOWN = _Powers(_STEP), _Powers(_BACK)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] for each span; equal contents give equal hashes wherever they stand.

    Spans are short runs of word hashes: up to some hundred values no two runs collide by the form of the sum."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _UP.upto(len(values)), out=sums[1:])
    return (sums[ends] - sums[starts]) * _DOWN.upto(len(values) + 1)[starts]


#: A longer word is hashed by itself.
LONG_WORD = 256


def _word_hashes(padded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each word, eight at a time, each mixed with all before. Eight bytes follow the data.

    No sums of powers: modulo a power of two those are equal for words that a Thue-Morse sequence makes.
    """
    eights = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=np.ascontiguousarray(padded), strides=(1,))
    size = ends - starts
    out = mixed(size.astype(np.uint64) + np.uint64(_STEP))
    own = np.flatnonzero(size <= LONG_WORD)
    for begin in range(0, LONG_WORD, 8):
        own = own[size[own] > begin]
        if not len(own):
            break
        left = np.minimum(size[own] - begin, 8).astype(np.uint64)
        value = eights[starts[own] + begin] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left))
        out[own] = mixed(out[own] * np.uint64(_STEP) ^ value)
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        out[i] = int.from_bytes(blake2b(padded[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


@dataclass
class Words:
    """Words of a batch of texts: hash, row, and byte span in the batch's data."""

    hashes: np.ndarray
    rows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    #: Where each row's words begin; one more entry than rows.
    first: np.ndarray


def split_words(texts: pa.Array, separators: np.ndarray = SPACE, lower: bool = True) -> Words:
    """The words of each text; a null text has none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[bounds[0] : bounds[-1]] if raw is not None and bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    if lower:
        data = LOWER[data]
    inside = ~separators[data]
    before, after = np.ones(len(data) + 1, dtype=bool), np.ones(len(data) + 1, dtype=bool)
    before[1:], after[:-1] = ~inside, np.append(~inside[1:], True) if len(data) else []
    before[bounds[:-1]] = True
    after[bounds[1:][np.diff(bounds) > 0] - 1] = True
    starts, ends = np.flatnonzero(inside & before[:-1]), np.flatnonzero(inside & after[:-1]) + 1
    first = np.searchsorted(starts, bounds)
    rows = np.repeat(np.arange(n), np.diff(first))
    hashes = np.empty(len(starts), dtype=np.uint64)
    padded = np.append(data, np.zeros(8, dtype=np.uint8))
    for at in range(0, len(starts), BLOCK // 4):  # words in blocks, so that memory follows the block and not the text
        hashes[at : at + BLOCK // 4] = _word_hashes(padded, starts[at : at + BLOCK // 4], ends[at : at + BLOCK // 4])
    return Words(hashes, rows, starts, ends, data, first)


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of so many neighbouring values; run i begins at value i."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, reach = np.empty(n, dtype=np.uint64), max(BLOCK, 4 * length)
    for at in range(0, n, reach):
        to = min(n, at + reach)
        begins = np.arange(to - at)
        out[at:to] = _spans(hashes[at : to + length - 1], begins, begins + length)
    return mixed(out + np.uint64(length))


def whole_runs(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the runs that stay within one row."""
    found = runs(words.hashes, length)
    own = np.flatnonzero(words.rows[: len(found)] == words.rows[length - 1 :]) if len(found) else np.zeros(0, np.int64)
    return own, found[own]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that one holds about so many bytes of text; a longer text makes a batch of its own."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)
