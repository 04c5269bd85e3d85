"""Repeated passages by sparse suffix arrays.

A text is its words (ASCII lower case, split at ASCII white space). Of every `REACH` neighbouring runs of `GRAM` words
the one with the smallest hash is retained, so every stretch of REACH + GRAM - 1 words has a suffix that begins in its
first REACH words, at the same place wherever the stretch stands. A passage of `LENGTH` words thus begins a retained
suffix that agrees in at least its first LENGTH - REACH + 1 words with those of all its repeats.

1. Retained suffixes are sorted over all documents by the hash of these words. Rows are dealt by range, so a passage that
   a third of all documents share lies in many tasks. Neighbours are compared; suffixes equal to none go. Those at either
   end of a range stay, for their neighbours may lie in the next.
2. The matches are extended left and right: each of the passages of LENGTH words whose first words retain this suffix, at
   every place left of it, is hashed whole, and equal ones over all documents are one passage. This is exact, so what
   the first step lets through too much is dropped here.
3. A passage that stands in an earlier document, or earlier in its own, is a repeat; overlapping ones make one span.

Defined results: null, empty and shorter texts have no passage. Rows that share a doc_id are one document, and repeats
among them are not told; rows with a null id are ignored. Extra columns are ignored by `repeats` and kept by `without`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstone.llm.sieve import listed
from wardstone.llm.storage import cut, stored
from wardstone.llm.text import Words, pieces, runs, signed, split_words

LENGTH = 50
GRAM = 8
REACH = 17


def picks(words: Words) -> np.ndarray:
    """For each word that begins a stretch within its text: the word at which the suffix begins that the stretch retains.

    -1 for the words with too few behind them.
    """
    stretch = REACH + GRAM - 1
    out = np.full(len(words.hashes), -1, dtype=np.int64)
    grams = runs(words.hashes, GRAM)
    n = len(words.hashes) - stretch + 1
    for at in range(0, max(0, n), 1 << 16):
        to = min(n, at + (1 << 16))
        part = np.lib.stride_tricks.sliding_window_view(grams[at : to + REACH - 1], REACH)
        own = words.rows[at:to] == words.rows[at + stretch - 1 : to + stretch - 1]
        out[at:to] = np.where(own, np.arange(at, to) + part.argmin(axis=1), -1)
    return out


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    head = LENGTH - REACH + 1
    for batch in pieces(batches):
        words = split_words(batch.column("text"))
        at = np.unique(picks(words))
        keys = runs(words.hashes, head)
        at = at[(at >= 0) & (at < len(keys))]
        at = at[words.rows[at] == words.rows[at + head - 1]]
        rows = words.rows[at]
        docs = batch.column("doc_id").take(pa.array(rows))
        yield pa.RecordBatch.from_arrays([pa.array(signed(keys[at])), docs, pa.array(at - words.first[rows])], names=["head", "doc", "at"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by head: those whose head equals that of a neighbour, and those of the first and the last head."""
    held, before = None, None
    for batch in batches:
        table = pa.concat_tables([held, pa.Table.from_batches([batch])]) if held is not None else pa.Table.from_batches([batch])
        heads = table.column("head").to_numpy()
        same = np.empty(len(heads), dtype=bool)
        same[0] = before is None or heads[0] == before
        same[1:] = heads[1:] == heads[:-1]
        keep = same.copy()
        keep[:-1] |= same[1:]
        out = table.slice(0, len(heads) - 1).filter(pa.array(keep[:-1])).select(["doc", "at"]).combine_chunks()
        yield from out.to_batches()
        held = table.slice(len(heads) - 1)
        before = heads[-2] if len(heads) > 1 else before
    if held is not None:
        yield from held.select(["doc", "at"]).combine_chunks().to_batches()


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash and first place of every passage that a kept suffix is the first of, and whether the text repeats it itself."""
    for batch in pieces(batches):
        words = split_words(batch.column("text"))
        whole = runs(words.hashes, LENGTH)
        picked = picks(words)
        for row, (doc, found) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("__kept").to_pylist())):
            first, last = int(words.first[row]), int(words.first[row + 1])
            if last - first < LENGTH:
                continue
            kept = np.zeros(last - first + 1, dtype=bool)
            kept[[x for x in found if x < last - first]] = True
            own = picked[first : last - LENGTH + 1]
            begins = first + np.flatnonzero((own >= 0) & kept[own - first])
            if not len(begins):
                continue
            _, place = np.unique(whole[begins], return_index=True)
            again = np.ones(len(begins), dtype=bool)
            again[place] = False
            columns = [pa.array(signed(whole[begins])), pa.array(np.full(len(begins), doc)), pa.array(begins - first), pa.array(again)]
            yield pa.RecordBatch.from_arrays(columns, names=["passage", "doc", "at", "again"])


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, first_word, n_words, first_doc_id: every span that repeats passages which stood before.

    first_doc_id is the first document with the passage that begins the span.
    """
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    suffixes = texts.mapInArrow(_suffixes, "head long, doc long, at long")
    order = ["head", "doc", "at"]
    alike = suffixes.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours, "doc long, at long")
    kept = cut(alike.groupBy("doc").agg(F.collect_list("at").alias("__kept")))
    found = listed(texts, "doc_id", kept.select(F.col("doc").alias("id"))).join(kept.withColumnRenamed("doc", "doc_id"), "doc_id")
    passages = stored(found.mapInArrow(_passages, "passage long, doc long, at long, again boolean"))
    places = passages.groupBy("passage").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.max("again").alias("within"))
    shared = places.where("first < last OR within").select("passage", "first")
    later = passages.join(shared, "passage").where("doc > first OR again")
    spans = later.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("at", "first"))).alias("found"))
    return spans.mapInArrow(_spans, "doc_id long, first_word long, n_words long, first_doc_id long")


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("first_doc_id", pa.int64())])
    for batch in batches:
        rows = []
        for doc, found in zip(batch.column("doc").to_pylist(), batch.column("found")):
            at, first = (found.values.field(c).to_numpy() for c in ("at", "first"))
            begins = np.flatnonzero(np.concatenate([[True], np.diff(at) > LENGTH]))
            ends = np.append(begins[1:], len(at)) - 1
            rows += [(doc, int(at[b]), int(at[e]) - int(at[b]) + LENGTH, int(first[b])) for b, e in zip(begins, ends)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _cut_out(names: list[str]):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, spans in enumerate(batch.column("__spans").to_pylist()):
                text = batch.column("text")[i].as_py()
                if spans and text is not None:
                    words = split_words(pa.array([text], pa.string()))
                    data, parts, at = text.encode("utf-8"), [], 0
                    for span in sorted(spans, key=lambda x: x["first_word"]):
                        if span["first_word"] + span["n_words"] <= len(words.starts):
                            parts.append(data[at : words.starts[span["first_word"]]])
                            at = int(words.ends[span["first_word"] + span["n_words"] - 1])
                    text = b"".join([*parts, data[at:]]).decode("utf-8")
                out.append(text)
            columns = [pa.array(out, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return of


def without(docs: DataFrame) -> DataFrame:
    """docs with the repeated spans cut out of the texts."""
    spans = repeats(docs).groupBy(F.col("doc_id").alias("__doc")).agg(F.collect_list(F.struct("first_word", "n_words")).alias("__spans"))
    joined = docs.join(spans, docs["doc_id"] == spans["__doc"], "left").drop("__doc")
    return joined.mapInArrow(_cut_out(docs.columns), docs.schema)
