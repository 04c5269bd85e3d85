"""Exact keyed state machines over event logs, in parallel even for one hot key.

A state machine per key is sequential, so the naive plan gives a key with a third of all events
to one task. Here time is cut into chunks and the work takes three steps:

1. ``summarise`` each (key, chunk) into its transfer function: exit state for any entry state;
2. ``fold`` the summaries of a key in order into the entry state of each chunk; this sees one
   row per chunk, so their number is bounded by the time span, not by the number of events, and
   it holds one of them at a time;
3. ``replay`` each (key, chunk) from its entry state and emit its rows.

Steps 1 and 3 are partitioned by (key, chunk), so a busy key spreads over all tasks; in memory
is one chunk of one key at a time. The results are exactly those of the sequential machine.
Rows reach Python sorted and in Arrow batches; there is no call per group, since most keys of a
log have only a few events per chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EMIT_ROWS = 8_192


def _runs(batches: Iterator[pd.DataFrame], ids: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Consecutive rows with equal ids, across batch borders, as lists per column."""
    current, held = None, {}
    for pdf in batches:
        if not len(pdf):
            continue
        columns = {c: pdf[c].tolist() for c in pdf.columns}
        changed = (pdf[ids] != pdf[ids].shift()).any(axis=1).to_numpy().nonzero()[0].tolist()
        borders = ([] if changed and changed[0] == 0 else [0]) + changed + [len(pdf)]
        for lo, hi in zip(borders, borders[1:]):
            here = tuple(columns[c][lo] for c in ids)
            if here != current:
                if current is not None:
                    yield current, held
                current, held = here, {c: [] for c in columns}
            for c, v in columns.items():
                held[c].extend(v[lo:hi])
    if current is not None:
        yield current, held


def _emit(rows: Iterator[tuple], names: list[str]) -> Iterator[pd.DataFrame]:
    buffer = []
    for row in rows:
        buffer.append(row)
        if len(buffer) >= EMIT_ROWS:
            yield pd.DataFrame(buffer, columns=names)
            buffer = []
    if buffer:
        yield pd.DataFrame(buffer, columns=names)


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def scan_in_chunks(
    events: DataFrame,
    key: str,
    chunk_ms: int,
    summarise: Callable[[dict[str, list], int], tuple],
    summary_schema: str,
    fold: Callable[[tuple | None, int, tuple], tuple[tuple, tuple]],
    entry_schema: str,
    replay: Callable[[dict[str, list], int, tuple], list[tuple]],
    out_schema: str,
) -> tuple[DataFrame, DataFrame]:
    """(replayed rows, entry state per key and chunk) of ``events`` with columns ``key`` and ``ms``.

    Events of a chunk come ordered by ``ms``, then ``seq`` if there is one. ``fold`` takes the
    state after the last chunk (null at first), a chunk's start and its summary, and gives the
    chunk's entry state and the state after it.
    """
    order = ["ms", "seq"] if "seq" in events.columns else ["ms"]
    ids = [key, "chunk"]
    id_schema = f"{key} {dict(events.dtypes)[key]}, chunk long"
    events = events.withColumn("chunk", F.floor(F.col("ms") / chunk_ms).cast("long"))
    entry_names, out_names = _names(entry_schema), _names(out_schema)

    def run_summary(batches):
        rows = ((*i, *summarise(cols, int(i[1]) * chunk_ms)) for i, cols in _runs(batches, ids))
        return _emit(rows, ids + _names(summary_schema))

    def run_fold(batches):
        def rows():
            current, state = None, None
            for pdf in batches:
                columns = [pdf[c].tolist() for c in ids + _names(summary_schema)]
                for k, chunk, *summary in zip(*columns):
                    if k != current:
                        current, state = k, None
                    entry, state = fold(state, chunk * chunk_ms, tuple(summary))
                    yield (k, chunk, *entry)

        return _emit(rows(), ids + entry_names)

    def run_replay(batches):
        def rows():
            for i, cols in _runs(batches, ids):
                entry = tuple(int(cols[n][0]) for n in entry_names)  # the entry row sorts first
                body = {c: v[1:] for c, v in cols.items()}
                for row in replay(body, int(i[1]) * chunk_ms, entry):
                    yield (i[0], *row)

        return _emit(rows(), [key] + out_names)

    summaries = (
        events.repartition(*ids).sortWithinPartitions(*ids, *order)
        .mapInPandas(run_summary, f"{id_schema}, {summary_schema}")
    )
    entries = (
        summaries.repartition(key).sortWithinPartitions(*ids)
        .mapInPandas(run_fold, f"{id_schema}, {entry_schema}")
    )
    # Entry states join their chunk's events as one more row, which needs a single shuffle.
    fill = {n: -1 for n in entry_names}
    tagged = events.withColumns({"__event": F.lit(1), **{n: F.lit(v).cast("long") for n, v in fill.items()}})
    heads = entries.select(
        *ids, F.lit(0).alias("__event"), *entry_names,
        *[F.lit(0).cast(t).alias(c) for c, t in events.dtypes if c not in ids],
    )
    replayed = (
        tagged.unionByName(heads).repartition(*ids).sortWithinPartitions(*ids, "__event", *order)
        .mapInPandas(run_replay, f"{key} {dict(events.dtypes)[key]}, {out_schema}")
    )
    return replayed, entries
