"""Ranked lexical search, reversed: documents stream through an index of the items' terms.

The items' terms, with their counts, are an inverted index that every task gets; items come in blocks of about
BLOCK_BYTES of text, so the index is bounded however many there are. Each document's term counts pass through it once
for the statistics (documents and terms in all, documents that hold each term) and once for the scores. A task keeps the
best n documents of each item, and these bounded lists are merged.

A term is a maximal run of letters and digits of ASCII and of all that lies beyond ASCII, A-Z lower-cased; null and empty
texts have none. With N documents that have a term, L terms in all, n terms in a document, tf of them this one, and df
documents that hold it:

    w = floor(1000 ln((2 N + 2) / (2 df + 1)))        m = 100 - 75 + 75 n N div L
    score = sum over the item's terms, repeats included, of w * (1000000000 tf div (1000 tf + 8 m))

Only scores above 0 are given, equal scores by ascending doc_id, a null id last. Each row of docs is a document, also
where ids or texts repeat. Items are rows (item_id, text): equal rows count once, and texts that share an id are ranked
apart. An item without known terms gives no row, nor does an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstone.llm.storage import stored
from wardstone.llm.text import LOWER, PUNCTUATION, pieces

#: Item texts of a block, bytes of a document looked at together, and sums kept at a time.
BLOCK_BYTES, SPAN, SUMS = 16 << 20, 1 << 20, 1 << 21
K1_B = (100 - 75, 75)


def _spans(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts bytes at separators, SPAN bytes at a time or at the end of a longer term."""
    at = 0
    while at < len(data):
        to = min(len(data), at + SPAN)
        while to < len(data):
            ends = np.flatnonzero(PUNCTUATION[data[to : to + SPAN]])
            if len(ends):
                to += int(ends[0])
                break
            to = min(len(data), to + SPAN)
        yield at, to
        at = to


def terms(texts: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Rows and terms of a batch of texts, in parts of bounded size."""
    texts = texts.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(bounds) or bounds[-1] == bounds[0]:
        return
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    cuts = bounds[1:-1]
    for at, to in _spans(data):
        part = LOWER[data[at:to]]
        inside = ~PUNCTUATION[part]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        # a text may begin within the part right after another that ends in a term
        begin = cuts[np.searchsorted(cuts, at) : np.searchsorted(cuts, to)] - at
        opens[begin] = inside[begin]
        starts = np.flatnonzero(opens)
        if not len(starts):
            continue
        rows = np.searchsorted(bounds, starts + at, side="right") - 1
        packed = part[inside]
        offsets = np.append(np.cumsum(inside)[starts] - 1, len(packed)).astype(np.int64)
        yield rows, pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(packed))


class Index:
    """The terms of a block of items: which items hold a term, and how often."""

    def __init__(self, texts: pa.Array):
        self.items = len(texts)
        rows, found = [], []
        for row, term in terms(texts):
            rows.append(row)
            found.append(term)
        every = pa.concat_arrays(found) if found else pa.array([], pa.large_string())
        coded = every.dictionary_encode()
        self.terms = coded.dictionary
        pairs, self.times = np.unique(
            coded.indices.to_numpy().astype(np.int64) * max(1, self.items) + (np.concatenate(rows) if rows else np.zeros(0, np.int64)), return_counts=True
        )
        self.item = pairs % max(1, self.items)
        self.first = np.searchsorted(pairs // max(1, self.items), np.arange(len(self.terms) + 1))

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each text the number of its terms; then row, term and count of those in the index."""
        sizes, width = np.zeros(len(texts), dtype=np.int64), max(1, len(self.terms))
        keys, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for rows, found in terms(texts):
            sizes += np.bincount(rows, minlength=len(texts))
            at = pc.index_in(found, value_set=self.terms)
            known = at.is_valid().to_numpy(zero_copy_only=False)
            more, n = np.unique(rows[known] * width + at.drop_null().to_numpy(), return_counts=True)
            keys, inverse = np.unique(np.append(keys, more), return_inverse=True)
            times = np.bincount(inverse, weights=np.append(times, n), minlength=len(keys)).astype(np.int64)
        return sizes, keys // width, keys % width, times


def _statistics(docs: DataFrame, index: Index) -> tuple[int, int, np.ndarray]:
    """Documents that have terms, terms in all, and documents that hold each term of the index."""
    width = len(index.terms)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(width + 2, dtype=np.int64)
        for batch in pieces(batches):
            sizes, _, term, _ = index.counts(batch.column("text"))
            seen[:width] += np.bincount(term, minlength=width)
            seen[width:] += (np.count_nonzero(sizes), sizes.sum())
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["at", "n"])

    found = docs.select("text").mapInArrow(of, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # as many as terms
    seen = np.zeros(width + 2, dtype=np.int64)
    seen[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return int(seen[width]), int(seen[width + 1]), seen[:width]


class _Heaps:
    """The best n (score, id) of each item; ids that are null come after all others."""

    def __init__(self, items: int, n: int):
        self.n, self.least = n, np.ones(items, dtype=np.int64)
        self.item, self.score, self.null, self.id = (np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64))

    def add(self, item: np.ndarray, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        keep = score >= self.least[item]
        if not keep.any():
            return
        item, score, null, ids = (np.append(a, b[keep]) for a, b in ((self.item, item), (self.score, score), (self.null, null), (self.id, ids)))
        order = np.lexsort((ids, null, -score, item))
        rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        order, full = order[rank < self.n], order[rank == self.n - 1]
        self.item, self.score, self.null, self.id = item[order], score[order], null[order], ids[order]
        self.least[item[full]] = score[full]


def _scores(docs: DataFrame, index: Index, weights: np.ndarray, documents: int, total: int, n: int) -> DataFrame:
    """The best n documents of each item in each task: at (the item's number), doc_id, score."""
    spread = np.diff(index.first)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = _Heaps(index.items, n)
        for batch in pieces(batches):
            sizes, row, term, times = index.counts(batch.column("text"))
            ids = batch.column("doc_id")
            null, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            m = np.array([K1_B[0] + K1_B[1] * int(size) * documents // total for size in sizes], dtype=np.int64)
            parts = weights[term] * (1_000_000_000 * times // (1000 * times + 8 * m[row]))
            ends = np.searchsorted(row, np.arange(len(sizes) + 1))
            step, at = max(1, SUMS // index.items), 0
            work = np.append(0, np.cumsum(spread[term]))[ends]
            while at < len(sizes):  # rows whose sums, and whose postings, fit
                to = min(len(sizes), at + step, max(at + 1, int(np.searchsorted(work, work[at] + SUMS))))
                pair = slice(ends[at], ends[to])
                fan = spread[term[pair]]
                posting = np.repeat(index.first[term[pair]] - np.append(0, np.cumsum(fan)[:-1]), fan) + np.arange(fan.sum()) if len(fan) else np.zeros(0, np.int64)
                key = np.repeat(row[pair] - at, fan) * index.items + index.item[posting]
                sums = np.bincount(key, weights=np.repeat(parts[pair], fan) * index.times[posting], minlength=(to - at) * index.items).astype(np.int64)
                hit = np.flatnonzero(sums > 0)
                hit = hit[sums[hit] >= heaps.least[hit % index.items]]
                own = at + hit // index.items
                heaps.add(hit % index.items, sums[hit], null[own], ids[own])
                at = to
        doc_id = pa.array(heaps.id, mask=heaps.null)
        yield pa.RecordBatch.from_arrays([pa.array(heaps.item), doc_id, pa.array(heaps.score)], ["at", "doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(of, "at long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, n: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The n best documents (doc_id, text) of each item (item_id, text): item_id, rank, doc_id, score."""
    spark, docs = docs.sparkSession, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.select("item_id", "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, out = max(1, -(-size // block_bytes)), None
    if blocks > 1:
        items = stored(items)
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow().combine_chunks()  # about block_bytes
        texts = own.column("text").combine_chunks() if own.num_rows else pa.array([], pa.string())
        index = Index(texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks))
        documents, total, held = _statistics(docs, index) if len(index.terms) else (0, 0, np.zeros(0, np.int64))
        ids = own.select(["item_id"]).append_column("at", pa.array(np.arange(own.num_rows)))
        names = spark.createDataFrame(ids) if own.num_rows else items.select("item_id", F.lit(0).cast("long").alias("at")).where(F.lit(False))
        if total:
            weights = np.floor(1000 * np.log((2 * documents + 2) / (2 * held + 1))).astype(np.int64)
            parts = _scores(docs, index, weights, documents, total, n)
        else:
            parts = spark.createDataFrame([], "at long, doc_id long, score long")
        order = Window.partitionBy("at").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        best = parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
        best = best.join(F.broadcast(names), "at").select("item_id", "rank", "doc_id", "score")
        if blocks > 1:
            best = stored(best)
        out = best if out is None else out.unionAll(best)
    return out
