"""Best-fit packing of documents into token sequences, with large items matched first.

Every document is its token ids and one end mark; only a document longer than the capacity is cut, into full pieces and a
rest. Pieces of one length are alike, so the plan is made on the number of pieces of each length: at most `CAPACITY`
counts, whatever the corpus. Pieces above a third of the capacity come first: at most two fit one sequence, and matching
the longest with the longest that still fits gives the most pairs. Shorter pieces follow by falling length, each into the
sequence whose gap fits best; only where none has room is a new one opened. All sequences of one make-up are planned as
one group, so plan and time are bounded by the capacity alone.

Pieces are then numbered within their length, by hash blocks so that one frequent length is no single task, and look
their sequence and offset up in the plan.

Defined results: null and empty texts are the end mark alone; repeated rows and ids are packed as often as they stand;
no documents give no sequences. Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardstone.llm.storage import cut
from wardstone.llm.text import pieces

CAPACITY = 4096
END = 1
VOCABULARY = "word_bpe_49k.json"
#: Words that are kept with their ids, the bytes they may take together, and the longest that is kept.
CACHED_WORDS, CACHED_BYTES, LONGEST_CACHED = 400_000, 16 << 20, 100
BLOCK_ROWS = 50_000
CHUNK = 1 << 20


def _ranges(kinds: str, upto: int = 0x180) -> str:
    return "".join(re.escape(chr(i)) for i in range(upto) if unicodedata.category(chr(i))[0] in kinds)


#: The vocabulary's own rule for cutting a text into words, spelled out for the characters below U+0180.
_LETTERS, _NUMBERS, _SPACES = _ranges("L"), _ranges("N"), " \t\n\x0b\x0c\r\xa0"
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")
#: Texts with other characters, or with the names of marks, take the tokenizer's own way as a whole.
_OTHER = re.compile("[^\x00-\x1b\x20-\x84\x86-įı-ſ]|<\\|startoftext\\|>|<\\|endoftext\\|>")
#: The vocabulary writes each byte as one visible character; those that have none of their own follow from U+0100.
_HIDDEN = [*range(33), *range(127, 161), 173]
_SHOWN = {b: 256 + i for i, b in enumerate(_HIDDEN)}
_GAP = re.compile("[ \t\n\r]")


class _Words(dict):
    """The ids of words, as little-endian bytes; a word that is not known is learnt when it is asked for.

    Two halves of bounded size: a full half becomes the older one, of which words that are asked for again come back.
    """

    def __init__(self, tokenizer):
        self.tokenize, self.bytes, self.older = tokenizer.model.tokenize, 0, {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            shown = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(_SHOWN)
            ids = [x.id for x in self.tokenize(shown)]
            found = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHED_WORDS // 2 or self.bytes + len(word) + len(found) > CACHED_BYTES // 2:
                self.older, self.bytes = dict(self), 0
                self.clear()
            self[word] = found
            self.bytes += len(word) + len(found)
        return found


class Encoder:
    """Token ids of whole texts as little-endian bytes. The ids of a word do not depend on its neighbours, so words are
    encoded once and kept, up to a bound."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = _Words(self.tokenizer)

    def simple(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, _WORD.findall(text)))

    def encode(self, text: str) -> bytes:
        if _OTHER.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        text, out, at = text.lower(), [], 0
        while at < len(text):  # long texts in chunks that end at white space, which no word spans
            gap = _GAP.search(text, at + CHUNK)
            to = gap.end() if gap else len(text)
            out.append(self.simple(text[at:to]))
            at = to
        return b"".join(out)


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """One for all tasks of a process, which go on with the words that it knows."""
    return Encoder(path)


def _pieces(path: str, capacity: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        end = np.array([END], dtype="<u4").tobytes()
        for batch in pieces(batches):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encoder.encode(text or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return of


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Slots (length, first rank, first sequence, pieces a sequence, offset), by length and rank; and the sequences."""
    left = {n: c for n, c in counts.items() if c > 0}
    open_groups: dict[int, list[list]] = {}  # by gap: [number of sequences, [(length, pieces), ...]]
    gaps: list[int] = []

    def keep(gap: int, group: list) -> None:
        if gap not in open_groups:
            open_groups[gap] = []
            bisect.insort(gaps, gap)
        open_groups[gap].append(group)

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        longest = large[-1]
        fit = bisect.bisect_right(large, capacity - longest) - 1
        if fit < 0 or (large[fit] == longest and left[longest] == 1 and fit == 0):
            keep(capacity - longest, [left.pop(longest), [(longest, 1)]])
            large.pop()
            continue
        partner = large[fit]
        if partner == longest and left[longest] == 1:
            partner = large[fit - 1]
        if partner == longest:
            n = left[longest] // 2
            keep(capacity - 2 * longest, [n, [(longest, 2)]])
            left[longest] -= 2 * n
        else:
            n = min(left[longest], left[partner])
            keep(capacity - longest - partner, [n, [(longest, 1), (partner, 1)]])
            left[longest] -= n
            left[partner] -= n
        for used in {longest, partner}:
            if not left[used]:
                del left[used]
                large.remove(used)

    for n in sorted(left, reverse=True):
        rest = left[n]
        while rest:
            at = bisect.bisect_left(gaps, n)
            gap = gaps[at] if at < len(gaps) else capacity
            each = gap // n
            if at < len(gaps):
                number, content = open_groups[gap].pop()
                if not open_groups[gap]:
                    del open_groups[gap]
                    gaps.pop(at)
            else:
                number, content = -(-rest // each), []
            full = min(number, rest // each)
            if full:
                keep(gap - each * n, [full, [*content, (n, each)]])
                rest -= full * each
            if full < number:
                if rest:  # fewer than fill one more
                    keep(gap - rest * n, [1, [*content, (n, rest)]])
                    full, rest = full + 1, 0
                if full < number:
                    keep(gap, [number - full, content])

    slots, base, ranks = [], 0, {}
    for gap in sorted(open_groups):
        for number, content in open_groups[gap]:
            offset = 0
            for n, each in content:
                slots.append((n, ranks.get(n, 0), base, each, offset))
                ranks[n] = ranks.get(n, 0) + number * each
                offset += n * each
            base += number
    return np.array(sorted(slots), dtype=np.int64).reshape(-1, 5), base


def _placed(slots: np.ndarray):
    keys = (slots[:, 0] << 48) | slots[:, 1]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            own = slots[np.searchsorted(keys, (length << 48) | rank, "right") - 1]
            step = rank - own[:, 1]
            sequence, offset = own[:, 2] + step // own[:, 3], own[:, 4] + step % own[:, 3] * length
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return of


def packed(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece. vocabulary: a tokenizer file."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    parts = cut(docs.select("doc_id", "text").mapInArrow(_pieces(vocabulary, capacity), schema))
    # At most `capacity` rows.
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    blocks = max(1, -(-sum(counts.values()) // BLOCK_ROWS))
    marked = parts.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)))
    sizes = marked.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("block")) - F.col("n")
    starts = sizes.select("length", "block", before.alias("before"))
    within = F.row_number().over(W.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = marked.withColumn("within", within).join(starts, ["length", "block"]).withColumn("rank", F.col("before") + F.col("within"))
    slots, _ = plan(counts, capacity)
    out = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long"))
    return out.mapInArrow(_placed(slots), f"{schema}, sequence_id long, offset long")
