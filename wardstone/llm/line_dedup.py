"""Line dedup by winnowing over line hashes.

A document is the sequence of its lines that hold more than ASCII white space. Every window of `window` neighbouring lines
picks its smallest line hash (the rightmost of equals) as fingerprint, so two documents that share a run of at least
`window` lines pick the same fingerprint from it. Fingerprints met once are done. Around every other one the match is
extended both ways: each of the windows that picked it, at every place left and right of it, is compared as a whole, and
neighbouring equal windows make up the longest equal run. A run that stood before, by (doc_id, place), is deleted; the
first stays. A line of at least `long_line` characters is a run by itself.

Defined results: a null text stays null and an empty one empty; blank lines are never part of a run and stay; rows with
the same doc_id and text are one document, and each gets the same result; null ids come first in the order. Extra
columns pass through. No rows are dropped here: see `deduplicated` for that.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstone.llm.text import pieces

WINDOW = 2
LONG_LINE = 200
BLANK = " \t\r\v\f"


def _hash(data: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)


def solid_lines(text: str) -> list[tuple[int, str]]:
    """Place among all lines, and line, of those that hold more than ASCII white space."""
    return [(at, line) for at, line in enumerate(text.split("\n")) if line.strip(BLANK)]


def picked(hashes: list[int], window: int) -> dict[int, list[int]]:
    """The winnowed places, with the windows that picked each."""
    chosen: dict[int, list[int]] = {}
    for begin in range(len(hashes) - window + 1):
        best = min(range(begin, begin + window), key=lambda at: (hashes[at], -at))
        chosen.setdefault(best, []).append(begin)
    return chosen


_FOUND = pa.schema([("fp", pa.int64()), ("doc", pa.int64()), ("uid", pa.int64()), ("runs", pa.list_(pa.struct([("at", pa.int32()), ("len", pa.int32()), ("run", pa.int64())])))])


def _fingerprints(window: int, long_line: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = []
            for doc, uid, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                lines = [line for _, line in solid_lines(text or "")]
                digests = [blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest() for line in lines]
                hashes = [int.from_bytes(x, "little", signed=True) for x in digests]
                for at, begins in picked(hashes, window).items():
                    rows.append((hashes[at], doc, uid, [{"at": b, "len": window, "run": _hash(b"".join(digests[b : b + window]))} for b in begins]))
                rows += [(h, doc, uid, [{"at": at, "len": 1, "run": h}]) for at, (h, line) in enumerate(zip(hashes, lines)) if len(line) >= long_line]
                if len(rows) >= 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FOUND)], schema=_FOUND)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FOUND)], schema=_FOUND)

    return of


def repeated_runs(docs: DataFrame, window: int = WINDOW, long_line: int = LONG_LINE) -> DataFrame:
    """doc, uid, at, len: every run of solid lines that stood before, at its place among the solid lines."""
    keyed = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("doc_id", "text").alias("uid"), "text")
    found = keyed.mapInArrow(_fingerprints(window, long_line), "fp long, doc long, uid long, runs array<struct<at:int,len:int,run:long>>")
    again = found.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp")
    run = found.join(again, "fp", "left_semi").select("doc", "uid", F.inline("runs"))
    place = F.struct("doc", "uid", "at")
    first = run.groupBy("run", "len").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").select("run", "len", "first")
    return run.join(first, ["run", "len"]).where(place > F.col("first")).select("doc", "uid", "at", "len").distinct()


_KEPT = "struct<kept_text:string,n_lines:int,n_removed:int>"


def _without(docs: DataFrame) -> DataFrame:
    names = [f.name for f in docs.schema if f.name not in ("__runs", "__uid")]
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema if f.name in names) + f", __out {_KEPT}"

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("__runs").to_pylist()):
                solid = solid_lines(text or "")
                gone = {solid[i][0] for r in found or () for i in range(r["at"], r["at"] + r["len"])}
                kept = text if not gone else "\n".join(line for at, line in enumerate(text.split("\n")) if at not in gone)
                out.append({"kept_text": kept, "n_lines": len(solid), "n_removed": len(gone)})
            kind = pa.struct([("kept_text", pa.string()), ("n_lines", pa.int32()), ("n_removed", pa.int32())])
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(out, kind)], names=[*names, "__out"])

    return docs.mapInArrow(of, schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW, long_line: int = LONG_LINE) -> DataFrame:
    """docs with one more column, __out: the text left, the number of solid lines, and how many of them went."""
    runs = repeated_runs(docs, window, long_line).groupBy(F.col("doc").alias("__doc"), F.col("uid").alias("__own")).agg(F.collect_list(F.struct("at", "len")).alias("__runs"))
    keyed = docs.withColumn("__uid", F.xxhash64("doc_id", "text"))
    joined = keyed.join(runs, keyed["doc_id"].eqNullSafe(runs["__doc"]) & (keyed["__uid"] == runs["__own"]), "left").drop("__doc", "__own")
    return _without(joined)


def deduplicated(docs: DataFrame, window: int = WINDOW, long_line: int = LONG_LINE) -> DataFrame:
    """docs with the repeated runs deleted from the text; documents of which nothing is left but blank lines go."""
    out = remove_repeats(docs, window, long_line).where("__out.n_removed = 0 OR __out.n_removed < __out.n_lines")
    return out.select(*(F.col("__out.kept_text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns))
