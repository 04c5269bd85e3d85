"""Health timeline of a source: closed, open and half-open over its ordered outcomes.

Closed counts failures in a row and opens at the threshold. Open rejects calls until its time is
over; the first call after that is tried half-open. Enough successes close it, one failure opens
it again. Successes counted while closed are still there after opening, so one success may close
it; only a half-open failure and closing clear them.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstone.operators.chunks import scan_in_chunks
from wardstone.operators.quota import millis
from wardstone.sources import fixed_values as fixed

CLOSED, OPEN, HALF_OPEN = "closed", "open", "half_open"


def step(state: tuple, ms: int, failed: bool, failures: int, successes: int, open_ms: int) -> tuple[tuple, str, bool]:
    """(next state, mode the call met, admitted) for a state (mode, failures, successes, opened at).

    Only whether the success count reaches its threshold matters, so it stops there.
    """
    mode, bad, good, opened = state
    if mode == OPEN:
        if ms - opened < open_ms:
            return state, OPEN, False
        mode = HALF_OPEN
    if mode == CLOSED:
        if not failed:
            return (CLOSED, 0, min(good + 1, successes), 0), CLOSED, True
        if bad + 1 >= failures:
            return (OPEN, bad + 1, good, ms), CLOSED, True
        return (CLOSED, bad + 1, good, 0), CLOSED, True
    if failed:
        return (OPEN, bad, 0, ms), HALF_OPEN, True
    if good + 1 >= successes:
        return (CLOSED, 0, 0, 0), HALF_OPEN, True
    return (HALF_OPEN, bad, good + 1, 0), HALF_OPEN, True


def health_timeline(
    calls: DataFrame, key: str, ts: str, seq: str, failed: str, failures: int = fixed.BREAKER_FAILURES,
    successes: int = fixed.BREAKER_SUCCESSES, open_ms: int = fixed.BREAKER_OPEN_MS, chunk_ms: int = 60_000,
) -> DataFrame:
    """Every call (key, seq, ms) with the mode it met, whether it was admitted, and the mode after it.

    A chunk's transfer function: states it can be entered in are few (failure and success counts,
    closed or half-open) except for the time it opened, which only decides at which call of the
    chunk it is tried again. So the summary has one exit per countable state, and one per call
    that may be the first tried. It is built from the last call backwards.
    """
    n_good = successes + 1
    n_closed = failures * n_good  # code = bad * n_good + good; then half-open by good; then open by good
    half0, open0 = n_closed, n_closed + n_good

    def encode(state: tuple) -> tuple[int, int]:
        mode, bad, good, opened = state
        if mode == CLOSED:
            return bad * n_good + good, 0
        return (half0 + good, 0) if mode == HALF_OPEN else (open0 + good, opened)

    def decode(code: int, opened: int) -> tuple:
        if code < half0:
            return CLOSED, code // n_good, code % n_good, 0
        return (HALF_OPEN, 0, code - half0, 0) if code < open0 else (OPEN, 0, code - open0, opened)

    # next_code[failed][code]; a code from open0 on means that the call opened the circuit
    next_code = [
        [encode(step(decode(c, 0), 0, bad, failures, successes, open_ms)[0])[0] for c in range(open0)]
        for bad in (False, True)
    ]

    def summarise(rows: dict[str, list], start: int) -> tuple:
        t, bad = rows["ms"], rows["failed"]
        m = len(t)
        after = [(c, 0) for c in range(open0)]  # exits when no call is left
        half_exits: list = [None] * m
        for i in range(m - 1, -1, -1):
            retry = None
            if bad[i]:
                j = bisect_left(t, t[i] + open_ms, i)  # first call tried after an opening here
                retry = half_exits[j] if j < m else [(c, t[i]) for c in range(open0, open0 + n_good)]
            after = [after[c] if c < open0 else retry[c - open0] for c in next_code[bool(bad[i])]]
            half_exits[i] = after[half0:open0]
        late = min(bisect_left(t, start + open_ms) + 1, m)
        tried = [i for i in range(late) if i == 0 or t[i] != t[i - 1]]
        exits = [x for i in tried for x in half_exits[i]]
        return (
            [c for c, _ in after], [o for _, o in after], [t[i] for i in tried],
            [c for c, _ in exits], [o for _, o in exits],
        )

    def fold(state: tuple | None, start: int, summary: tuple) -> tuple[tuple, tuple]:
        exit_code, exit_opened, tried_ms, tried_code, tried_opened = summary
        entry = code, opened = state or (0, 0)
        if code < open0:
            return entry, (int(exit_code[code]), int(exit_opened[code]))
        i = bisect_left(tried_ms, opened + open_ms)
        if i == len(tried_ms):
            return entry, entry
        j = i * n_good + code - open0
        return entry, (int(tried_code[j]), int(tried_opened[j]))

    def replay(rows: dict[str, list], start: int, entry: tuple) -> list[tuple]:
        state, out = decode(*entry), []
        for ms, s, bad in zip(rows["ms"], rows["seq"], rows["failed"]):
            state, met, admitted = step(state, ms, bad, failures, successes, open_ms)
            out.append((ms, s, met, admitted, state[0]))
        return out

    events = calls.select(
        F.col(key).alias("key"), millis(F.col(ts)).alias("ms"), F.col(seq).cast("long").alias("seq"),
        F.coalesce(F.col(failed), F.lit(False)).alias("failed"),
    )
    out, _ = scan_in_chunks(
        events, "key", chunk_ms, summarise,
        "exit_code array<long>, exit_opened array<long>, tried_ms array<long>, tried_code array<long>, tried_opened array<long>",
        fold, "code long, opened long", replay, "ms long, seq long, met string, admitted boolean, mode string",
    )
    return out
