"""Benchmark decontamination by SimHash over item-sized windows.

Words are runs of letters, digits and non-ASCII bytes of the lower-cased text. A window is as long as the benchmark item
it is held against; both have a 64-bit SimHash of their words, each word voting with its length. The items of one length
are indexed by RADIUS + 1 blocks of their fingerprints: two fingerprints within the radius agree in one block at least,
so looking every block up finds all of them. What is found is verified: the weighted similarity of the five-word
shingles, sum of smaller over sum of larger weights, must reach `least`. A shingle weighs its count times its bytes.

A window without any shingle of an item has similarity 0 with it, so fingerprints are made only where a window of the
item's length would hold one of its shingles. This test is exact and drops no pair that could be verified.

No radius under about half of the bits is safe for every pair that reaches `least` (a few changed end words can turn any
bit), so the fingerprints only propose. A window must also hold `least` of the item's weight, and so one of any shingles
that weigh more than the rest: the rarest such shingles are the item's anchors. Where an anchor stands, every window whose
shared weight could give more than the best similarity so far is verified as well. So no pair is lost at any radius.

Items are a stated query set and are held against all documents in blocks of `BLOCK_ITEMS`; documents are never shuffled.

Defined results: null and empty texts and items, and those without words, match nothing. Items of fewer than five words
are one shingle. A document shorter than the item is one window. Each equal item is reported by its own id, each repeated
row by itself. Extra columns are ignored by `contaminated` and kept by `clean`.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from wardstone.llm.text import PUNCTUATION, Words, pieces, runs, split_words

SHINGLE = 5
LEAST = 0.8
RADIUS = 10
BLOCK_ITEMS = 4096
LONGEST_VOTE = 12
#: For comparing quotients of whole numbers with each other.
SLACK = 1e-9

_BITS = np.arange(64, dtype=np.uint64)
_EDGES = np.linspace(0, 64, RADIUS + 2).astype(int)
_BLOCKS = [(np.uint64(a), np.uint64((1 << int(b - a)) - 1)) for a, b in zip(_EDGES, _EDGES[1:])]


def words_of(texts: pa.Array) -> Words:
    return split_words(pc.utf8_lower(texts), PUNCTUATION, lower=False)


def votes(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Running sums of the signed votes of words, one row more than words."""
    sums = np.zeros((len(hashes) + 1, 64), dtype=np.int32)
    weights = np.minimum(lengths, LONGEST_VOTE).astype(np.int32)[:, None]
    np.cumsum(np.where((hashes[:, None] >> _BITS) & np.uint64(1), weights, -weights), axis=0, out=sums[1:])
    return sums


def fingerprints(sums: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    ones = (sums[ends] - sums[begins]) > 0
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64)[:, 0]


def shingle_weights(hashes: np.ndarray, lengths: np.ndarray, width: int) -> dict[int, int]:
    """Weight of each distinct run of so many words."""
    sums = np.concatenate([[0], np.cumsum(lengths)])
    out: dict[int, int] = defaultdict(int)
    for shingle, weight in zip(runs(hashes, width).tolist(), (sums[width:] - sums[:-width]).tolist()):
        out[shingle] += weight
    return out


def similarity(a: dict[int, int], b: dict[int, int]) -> float:
    shared = sum(min(w, b[s]) for s, w in a.items() if s in b)
    return shared / (sum(a.values()) + sum(b.values()) - shared)


class Items:
    """A block of benchmark items, indexed by shingle and by blocks of their fingerprints."""

    def __init__(self, ids: list, texts: list, least: float = LEAST):
        self.least = least
        words = words_of(pa.array(texts, pa.string()))
        self.ids, self.sizes, self.weights, self.prints = ids, [], [], []
        self.of_size: dict[int, list[int]] = defaultdict(list)
        owners: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for at in range(len(ids)):
            own = slice(words.first[at], words.first[at + 1])
            hashes, lengths = words.hashes[own], (words.ends - words.starts)[own]
            size = len(hashes)
            self.sizes.append(size)
            if not size:
                self.weights.append({})
                self.prints.append(0)
                continue
            width = min(SHINGLE, size)
            self.weights.append(dict(shingle_weights(hashes, lengths, width)))
            self.prints.append(int(fingerprints(votes(hashes, lengths), np.array([0]), np.array([size]))[0]))
            self.of_size[size].append(at)
            for shingle in self.weights[-1]:
                owners[shingle].add((width, size))
        self.totals = [sum(own.values()) for own in self.weights]
        holders = Counter(s for own in self.weights for s in own)
        #: For each item the rarest shingles that weigh more than what a match may lack.
        self.anchors: dict[int, list[int]] = defaultdict(list)
        for at, own in enumerate(self.weights):
            lacking = 0
            for shingle in sorted(own, key=lambda s: (holders[s], s)):
                if lacking > (1 - least) * self.totals[at] + SLACK:
                    break
                self.anchors[shingle].append(at)
                lacking += own[shingle]
        self.sizes_of = {s: sorted(x[1] for x in pairs) for s, pairs in owners.items()}
        #: For each shingle width: the sorted shingles, and whether any has these low 22 bits.
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for width in {w for pairs in owners.values() for w, _ in pairs}:
            values = np.array(sorted(s for s, pairs in owners.items() if any(w == width for w, _ in pairs)), dtype=np.uint64)
            quick = np.zeros(1 << 22, dtype=bool)
            quick[(values & np.uint64(len(quick) - 1)).astype(np.int64)] = True
            self.known[width] = values, quick
        #: For each size and block: the block's values in order, and whose they are.
        self.index = {}
        for size, own in self.of_size.items():
            prints = np.array([self.prints[i] for i in own], dtype=np.uint64)
            for k, (shift, mask) in enumerate(_BLOCKS):
                values = (prints >> shift) & mask
                order = np.argsort(values, kind="stable")
                self.index[size, k] = values[order], np.array(own)[order]

    def near(self, size: int, prints: np.ndarray) -> set[tuple[int, int]]:
        """Windows and items of this size whose fingerprints differ in RADIUS bits at most."""
        found: set[tuple[int, int]] = set()
        for k, (shift, mask) in enumerate(_BLOCKS):
            values, own = self.index[size, k]
            key = (prints >> shift) & mask
            low, high = np.searchsorted(values, key, "left"), np.searchsorted(values, key, "right")
            count = high - low
            window = np.repeat(np.arange(len(prints)), count)
            item = own[np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())]
            close = np.bitwise_count(prints[window] ^ np.array(self.prints, dtype=np.uint64)[item]) <= RADIUS
            found.update(zip(window[close].tolist(), item[close].tolist()))
        return found

    def bounded(self, size: int, hits: np.ndarray, shingles: list[int], sums: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Item, windows and the most that their similarity can be, best first, for every item with an anchor among the hits.

        hits are the places of shingles of items of this size, in order; sums are running weights of all shingles.
        """
        width = min(SHINGLE, size)
        low, high = np.searchsorted(hits, begins), np.searchsorted(hits, ends - width + 1)
        whole = sums[np.maximum(begins, ends - width + 1)] - sums[begins]
        for item in sorted({i for s in set(shingles) for i in self.anchors.get(s, ()) if self.sizes[i] == size}):
            own, total = self.weights[item], self.totals[item]
            at = np.array([s in own for s in shingles])
            held = np.concatenate([[0], np.cumsum(np.where(at, sums[hits + 1] - sums[hits], 0))])
            shared = np.minimum(held[high] - held[low], total)
            most = shared / (total + whole - shared)
            windows = np.flatnonzero(most >= self.least - SLACK)
            windows = windows[np.argsort(-most[windows], kind="stable")]
            yield item, windows, most[windows]

    def matches(self, texts: pa.Array) -> list[tuple[int, int, float, int, int]]:
        """Row, item, similarity, first word and number of words of the best window of every verified pair."""
        words = words_of(texts)
        wanted: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        lengths = words.ends - words.starts
        bytes_before = np.concatenate([[0], np.cumsum(lengths)])
        sums = {w: np.concatenate([[0], np.cumsum(bytes_before[w:] - bytes_before[:-w])]) for w in self.known if len(lengths) >= w}
        for width, (values, quick) in self.known.items():
            hashes = runs(words.hashes, width)
            hits = np.flatnonzero(quick[(hashes & np.uint64(len(quick) - 1)).astype(np.int64)])
            place = np.minimum(np.searchsorted(values, hashes[hits]), len(values) - 1)
            hits = hits[(values[place] == hashes[hits]) & (words.rows[hits] == words.rows[hits + width - 1])]
            for at, shingle in zip(hits.tolist(), hashes[hits].tolist()):
                for size in self.sizes_of[shingle]:
                    if min(SHINGLE, size) == width:
                        wanted[int(words.rows[at]), size].append((at, shingle))
        best: dict[tuple[int, int], tuple[float, int, int]] = {}

        def verify(row: int, item: int, b: int, e: int) -> None:
            score = similarity(shingle_weights(words.hashes[b:e], lengths[b:e], min(SHINGLE, self.sizes[item])), self.weights[item])
            if score >= self.least:
                best[row, item] = min(best.get((row, item), (0.0, 0, 0)), (-score, b - int(words.first[row]), e - b))

        for (row, size), hits in wanted.items():
            first, last = int(words.first[row]), int(words.first[row + 1])
            width, at = min(SHINGLE, size), np.array([x[0] for x in hits])
            begins = np.unique((at[:, None] + np.arange(width - size, 1)).ravel())
            begins = np.unique(np.clip(begins, first, max(first, last - size)))
            ends = np.minimum(begins + size, last)
            # Neighbouring windows share one table of running votes; far ones start another.
            for part in np.split(np.arange(len(begins)), np.flatnonzero(np.diff(begins) > size) + 1):
                for block in np.split(part, range(4096, len(part), 4096)):
                    low, high = int(begins[block[0]]), int(ends[block[-1]])
                    prints = fingerprints(votes(words.hashes[low:high], lengths[low:high]), begins[block] - low, ends[block] - low)
                    for window, item in self.near(size, prints):
                        b, e = int(begins[block[window]]), int(ends[block[window]])
                        if e - b >= width:
                            verify(row, item, b, e)
            for item, windows, most in self.bounded(size, at, [x[1] for x in hits], sums[width], begins, ends):
                for window, reach in zip(windows.tolist(), most.tolist()):
                    if reach < -best.get((row, item), (0.0, 0, 0))[0] - SLACK:
                        break
                    verify(row, item, int(begins[window]), int(ends[window]))
        return [(row, item, -score, at, n) for (row, item), (score, at, n) in sorted(best.items())]


def blocks(benchmark: DataFrame, least: float, size: int = BLOCK_ITEMS) -> Iterator[Items]:
    """The benchmark in blocks of so many items."""
    ids, texts = [], []
    for row in benchmark.select("item_id", "text").toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        if len(ids) == size:
            yield Items(ids, texts, least)
            ids, texts = [], []
    if ids:
        yield Items(ids, texts, least)


_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int64())])


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words: the best window of every document that holds an item."""
    found = None
    for items in blocks(benchmark, least):

        def of(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                rows = items.matches(batch.column("text"))
                ids = batch.column("doc_id")
                if rows:
                    columns = [[ids[r[0]].as_py() for r in rows], [items.ids[r[1]] for r in rows], *([r[i] for r in rows] for i in (2, 3, 4))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)

        part = docs.select("doc_id", "text").mapInArrow(of, "doc_id long, item_id long, similarity double, first_word long, n_words long")
        found = part if found is None else found.unionAll(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, similarity double, first_word long, n_words long")
    return found


def clean(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """docs without the documents that hold an item."""
    for items in blocks(benchmark, least):

        def of(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[r[0] for r in items.matches(batch.column("text"))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(of, docs.schema)
    return docs
