"""Toxic passages by maximum-scoring segments.

A word's features are itself and its beginnings of 4 to 8 bytes, hashed to a fixed number of slots. Counts over all
documents are the Dirichlet prior; counts over labelled rows give each slot the log-odds of toxic against clean, with a
variance. A word scores the best lower bound of its features less a margin, at least a small negative amount, so that
the score of ordinary text falls. One linear scan then finds all maximal-scoring segments. The best segment of n
words has normalised score lambda * S - ln(n + 1), where lambda solves E[exp(lambda * s)] = 1 over the words of clean
rows: its chance to arise in clean text of that length is about exp(-score) (extreme-value law). Segments whose score is
at least `SIGNIFICANT` are passages. A document's evidence is the best normalised score plus the sum of further passages'
scores, damped; a logistic curve fitted on labelled rows carries it to 0..1.

Only counts per slot, of fixed number, and the rows of the labelled sample reach the driver. The sample is bounded by
`SAMPLE` rows, taken by hash; the prior and the scores cover all documents and whole texts.

Defined results: null and empty texts have no passage and the least score; without a toxic or a clean label every score
is 0. A document labelled more than once counts as toxic if any of its rows says so; null labels and ids are not used.
Repeated rows get equal scores. Extra columns pass through `scored`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from wardstone.llm.text import PUNCTUATION, Words, mixed, pieces, split_words

SLOTS = 1 << 18
WORDS = 1 << 18
BEGINNINGS = (4, 5, 6, 7, 8)
SAMPLE = 50_000
PRIOR = 500.0
FLOOR = 0.5
CAUTION = 1.5
MARGIN = 1.0
DRIFT = 0.02
MOST = 6.0
SIGNIFICANT = 3.0
LEAST_EVIDENCE = -10.0
MOST_EVIDENCE = 30.0
THRESHOLD = 0.7


def words_of(texts: pa.Array) -> Words:
    return split_words(pc.utf8_lower(texts), PUNCTUATION, lower=False)


def features(words: Words) -> Iterator[tuple[int, np.ndarray]]:
    """Slots of the words, WORDS at a time: the first word's number, and one row a feature; -1 where a word has no such
    beginning."""
    for at in range(0, len(words.hashes), WORDS):
        yield at, _features(words, slice(at, at + WORDS))


def _features(words: Words, own: slice) -> np.ndarray:
    hashes, starts = words.hashes[own], words.starts[own]
    out = np.full((1 + len(BEGINNINGS), len(hashes)), -1, dtype=np.int32)
    mask = np.uint64(SLOTS - 1)
    out[0] = (hashes & mask).astype(np.int32)
    size, last = words.ends[own] - starts, len(words.data) - 1
    value = np.zeros(len(size), dtype=np.uint64)
    for k in range(max(BEGINNINGS)):
        # what lies beyond a word's end is only read into values that are not used
        value = (value << np.uint64(8)) | words.data[np.minimum(starts + k, last)]
        if k + 1 in BEGINNINGS:
            longer = size > k + 1
            out[BEGINNINGS.index(k + 1) + 1, longer] = (mixed(value[longer] * np.uint64(31) + np.uint64(k)) & mask).astype(np.int32)
    return out


def segments(scores: list[float]) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, begin, end), by one scan that keeps a list of disjoint candidates.

    Each positive word opens a candidate. It joins back to the nearest candidate that began from a lower running sum,
    if it also ends on a higher one; else it waits on the list.
    """
    found: list[tuple[float, float, int, int]] = []
    total = 0.0
    for at, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        low, high, begin = before, total, at
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][0] >= low:
                k -= 1
            if k < 0 or found[k][1] >= high:
                found.append((low, high, begin, at + 1))
                break
            low, begin = found[k][0], found[k][2]
            del found[k:]
    return [(high - low, begin, end) for low, high, begin, end in found]


@dataclass
class Model:
    """What the counts and the labelled sample give."""

    bound: np.ndarray
    rate: float = 1.0
    slope: float = 0.0
    level: float = -50.0

    def word_scores(self, words: Words) -> np.ndarray:
        out = np.empty(len(words.hashes))
        for at, slots in features(words):
            best = np.full(slots.shape[1], -np.inf)
            for own in slots:
                has = own >= 0
                best[has] = np.maximum(best[has], self.bound[own[has]])
            out[at : at + WORDS] = np.maximum(np.minimum(best, MOST) - MARGIN, -DRIFT)
        return out

    def passages(self, scores: np.ndarray) -> list[tuple[float, int, int]]:
        """Normalised score, first word and end of every segment, best first."""
        if not len(scores) or not (scores > 0).any():
            return []
        # A stretch of equal negative scores acts on the scan as its sum does.
        marks = scores > 0
        cuts = np.flatnonzero(np.diff(np.concatenate([[True], marks])) | np.concatenate([[True], marks[1:]]))
        cuts = np.unique(np.concatenate([[0], cuts]))
        found = segments(np.add.reduceat(scores, cuts).tolist())
        ends = np.append(cuts, len(scores))
        base = np.log(len(scores) + 1.0)
        return sorted(((self.rate * s - base, int(ends[b]), int(ends[e])) for s, b, e in found), key=lambda x: (-x[0], x[1]))

    def evidence(self, found: list[tuple[float, int, int]]) -> float:
        if not found:
            return LEAST_EVIDENCE
        further = 0.5 * sum(max(0.0, x[0]) for x in found[1:])
        return min(MOST_EVIDENCE, max(LEAST_EVIDENCE, found[0][0] + further))

    def score(self, evidence: float) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * evidence + self.level, -50, 50))))


def log_odds(everything: np.ndarray, toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Lower bound of the log-odds of each slot, under a prior shaped like the whole corpus.

    everything: occurrences in all documents; toxic and clean: numbers of labelled documents that have the slot.
    """
    prior = FLOOR + PRIOR * everything / max(1, everything.sum())
    t, c = toxic + prior, clean + prior
    delta = np.log(t / (n_toxic + 2 * prior)) - np.log(c / (n_clean + 2 * prior))
    return (delta - CAUTION * np.sqrt(1 / t + 1 / c)).astype(np.float32)


def growth_rate(values: np.ndarray, counts: np.ndarray) -> float:
    """The positive solution of E[exp(rate * s)] = 1 for the scores of ordinary words, by halving."""
    if not counts.sum() or not (values > 0).any() or (values * counts).sum() >= 0:
        return 1.0
    share = counts / counts.sum()
    low, high = 0.0, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (share * np.exp(middle * values)).sum() < 1 else (low, middle)
    return low


def fitted_curve(evidence: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and level of a logistic curve, by Newton steps with a small ridge."""
    x = np.stack([evidence, np.ones_like(evidence)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        gradient = x.T @ (labels - p) - 0.01 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return max(0.0, float(w[0])), float(w[1])


def sampled_labels(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, toxic: at most so many labelled documents of the folds that may be learned from, chosen by hash."""
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    each = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros((3, SLOTS), dtype=np.int64)
    for batch in pieces(batches):
        words = words_of(batch.column("text"))
        labels = batch.column("toxic").fill_null(-1).to_numpy(zero_copy_only=False)
        pairs: list = [np.zeros(0, dtype=np.int64)] * (1 + len(BEGINNINGS))
        for at, each in features(words):
            rows = words.rows[at : at + WORDS]
            labelled = (labels >= 0)[rows]
            for k, slots in enumerate(each):
                totals[0] += np.bincount(slots[slots >= 0], minlength=SLOTS)
                own = labelled & (slots >= 0)
                if own.any():  # a labelled row counts once for a slot of a feature
                    pairs[k] = np.union1d(pairs[k], rows[own].astype(np.int64) * SLOTS + slots[own])
        for own in pairs:
            toxic = (labels == 1)[own // SLOTS]
            for k, kind in ((1, toxic), (2, ~toxic)):
                totals[k] += np.bincount(own[kind] % SLOTS, minlength=SLOTS)
    slots = np.flatnonzero(totals.any(axis=0))
    for part in np.split(slots, range(10_000, len(slots), 10_000)):
        if len(part):
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *(pa.array(totals[k][part]) for k in range(3))], names=["slot", "everything", "toxic", "clean"])


def _clean_scores(model: Model):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1001, dtype=np.int64)
        for batch in pieces(batches):
            scores = model.word_scores(words_of(batch.column("text")))
            counts += np.bincount(np.round((scores + DRIFT) * 100).astype(np.int64), minlength=len(counts))[: len(counts)]
        bins = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(bins.astype(np.int32)), pa.array(counts[bins])], names=["bin", "n"])

    return of


def _evidence(model: Model):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            words = words_of(batch.column("text"))
            scores = model.word_scores(words)
            found = [model.evidence(model.passages(scores[a:b])) for a, b in zip(words.first, words.first[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64()), batch.column("toxic").cast(pa.int32())], names=["evidence", "toxic"])

    return of


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Counts over all documents, and a curve on the sampled labelled ones."""
    chosen = F.broadcast(sampled_labels(labels, sample))
    texts = docs.select("doc_id", "text")
    marked = texts.join(chosen, "doc_id", "left").select("text", F.col("toxic").cast("int").alias("toxic"))
    counts = marked.mapInArrow(_word_counts, "slot int, everything long, toxic long, clean long")
    # One row a slot, SLOTS at most.
    slots = counts.groupBy("slot").agg(F.sum("everything"), F.sum("toxic"), F.sum("clean")).toArrow()
    table = np.zeros((3, SLOTS))
    if slots.num_rows:
        table[:, slots.column(0).to_numpy()] = [slots.column(k).to_numpy() for k in (1, 2, 3)]
    labelled = texts.join(chosen, "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in labelled.groupBy((F.col("toxic") == 1).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    model = Model(log_odds(*table, n_toxic, n_clean))
    if not n_toxic or not n_clean:
        return Model(np.full(SLOTS, -np.inf, dtype=np.float32))
    ordinary = labelled.where("toxic <> 1").mapInArrow(_clean_scores(model), "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    model.rate = growth_rate(ordinary.column(0).to_numpy() / 100 - DRIFT, ordinary.column(1).to_numpy())
    known = labelled.mapInArrow(_evidence(model), "evidence double, toxic int").toArrow()
    model.slope, model.level = fitted_curve(known.column(0).to_numpy(), (known.column(1).to_numpy() == 1).astype(float))
    return model


_OUT = pa.struct([("score", pa.float64()), ("passages", pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("score", pa.float64())])))])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs with one more column, __toxicity: the score, and the significant passages, best first."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            words = words_of(batch.column("text"))
            scores = model.word_scores(words)
            out = []
            for a, b in zip(words.first, words.first[1:]):
                found = model.passages(scores[a:b])
                strong = [{"first_word": i, "n_words": j - i, "score": s} for s, i, j in found if s >= SIGNIFICANT]
                out.append({"score": model.score(model.evidence(found)), "passages": strong})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, _OUT)], names=[*batch.schema.names, "__toxicity"])

    passage = StructType([StructField("first_word", LongType()), StructField("n_words", LongType()), StructField("score", DoubleType())])
    result = StructType([StructField("score", DoubleType()), StructField("passages", ArrayType(passage))])
    return docs.mapInArrow(of, StructType([*docs.schema.fields, StructField("__toxicity", result)]))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without those that score the threshold or more."""
    return scored(docs, fit(docs, labels)).where(F.col("__toxicity.score") < threshold).drop("__toxicity")
