"""Chunked state machines against the plain sequential ones, on random logs."""

import random

import pytest
from pyspark.sql import functions as F

from wardstone.operators import approvals, health, pairing, quota, sessions

SCHEMA = "key long, seq long, at long, failed boolean"


def log(seed, n=400, span=40_000, keys=3):
    """Calls with a hot key, ties in time and idle stretches."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        at = rnd.choice([rnd.randrange(span), rnd.randrange(0, span, 1000)])
        rows.append((0 if rnd.random() < 0.5 else rnd.randrange(keys), i, at, rnd.random() < 0.5))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_millis("at"))


def in_order(rows):
    keyed = {}
    for r in sorted(rows, key=lambda r: (r[2], r[1])):
        keyed.setdefault(r[0], []).append(r)
    return keyed


@pytest.mark.parametrize("seed,capacity,period,chunk", [(1, 2, 3_000, 1_000), (2, 5, 7_000, 500), (3, 3, 10_000, 40_000), (4, 1, 700, 250)])
def test_token_bucket(spark, seed, capacity, period, chunk):
    rows = log(seed)
    want = {}
    for key, calls in in_order(rows).items():
        tokens, last = capacity * period, None
        for _, seq, at, _ in calls:
            if last is not None:
                tokens = min(capacity * period, tokens + capacity * (at - last))
            last, ok = at, tokens >= period
            tokens -= period if ok else 0
            want[seq] = (ok, tokens // period if ok else 0, 0 if ok else -((tokens - period) // capacity))
    got = quota.token_bucket(frame(spark, rows), "key", "ts", "seq", capacity, period, chunk).collect()
    assert {r["seq"]: (r["allowed"], r["remaining"], r["retry_after_ms"]) for r in got} == want


def test_token_bucket_example(spark):
    rows = [(1, 0, 0, False), (1, 1, 0, False), (1, 2, 0, False), (1, 3, 30_000, False)]
    got = quota.token_bucket(frame(spark, rows), "key", "ts", "seq", 2, 60_000).orderBy("seq").collect()
    assert [(r["allowed"], r["retry_after_ms"]) for r in got] == [(True, 0), (True, 0), (False, 30_000), (True, 0)]


@pytest.mark.parametrize("seed,failures,successes,open_ms,chunk", [(1, 3, 2, 2_000, 1_000), (2, 2, 3, 900, 3_000), (3, 5, 2, 5_000, 700)])
def test_health(spark, seed, failures, successes, open_ms, chunk):
    rows = log(seed)
    want = {}
    for key, calls in in_order(rows).items():
        state = (health.CLOSED, 0, 0, 0)
        for _, seq, at, bad in calls:
            state, met, admitted = health.step(state, at, bad, failures, successes, open_ms)
            want[seq] = (met, admitted, state[0])
    got = health.health_timeline(frame(spark, rows), "key", "ts", "seq", "failed", failures, successes, open_ms, chunk).collect()
    assert {r["seq"]: (r["met"], r["admitted"], r["mode"]) for r in got} == want
    assert {m for m, _, _ in want.values()} == {"closed", "open", "half_open"}


def test_one_success_may_close(spark):
    rows = [(1, 0, 0, False)] + [(1, i, i, True) for i in range(1, 6)] + [(1, 6, 40_000, False)]
    got = health.health_timeline(frame(spark, rows), "key", "ts", "seq", "failed").orderBy("seq").collect()
    assert [r["mode"] for r in got][-2:] == ["open", "closed"]


@pytest.mark.parametrize("chunk", [300, 5_000])
def test_distinct_requests(spark, chunk):
    rows = log(9)
    want = {}
    for key, calls in in_order(rows).items():
        opened = None
        for _, seq, at, _ in calls:
            new = opened is None or at - opened >= 2_000
            opened = at if new else opened
            want[seq] = not new
    df = frame(spark, rows).withColumn("hash", F.col("key").cast("string"))
    got = approvals.distinct_requests(df, "hash", "ts", "seq", 2, chunk).collect()
    assert {r["seq"]: r["duplicate"] for r in got} == want


def test_sessions_and_resets(spark):
    turns = spark.createDataFrame([(1, 0, 0.5), (1, 3_000, 0.25), (1, 20_000, 0.5), (1, 21_000, 0.1), (2, 0, 1.0)], "key long, at long, risk double")
    resets = spark.createDataFrame([(1, 20_500)], "key long, at long")
    ts = F.timestamp_millis("at")
    got = sessions.sessions(turns.withColumn("ts", ts), "key", "ts", "risk", resets.withColumn("ts", ts), 10, 3)
    assert sorted((r["key"], r["session_no"], r["turns"], r["risk"]) for r in got.collect()) == [
        (1, 1, 2, 0.75), (1, 2, 1, 0.5), (1, 3, 1, 0.1), (2, 1, 1, 1.0)]


def test_pairs_with_gaps(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 5, "assistant", "b"), (1, 6, "assistant", "c")], "conv long, turn long, role string, text string")
    got = pairing.pair_turns_with_gaps(df, "conv", "turn", "role", "text").collect()
    assert sorted((r["turn"], r["prompt"]) for r in got) == [(5, "a"), (6, "b")]


def test_windows_of_one_busy_content(spark):
    draw = random.Random(4)
    times = sorted({draw.randrange(3_000_000) for _ in range(4000)} | {10_000, 12_000, 14_000})
    points = spark.createDataFrame([("hot", t) for t in times] + [("one", 5), ("two", 5), ("two", 2_004), ("two", 2_005)], "key string, ms long")
    found, last = [], None
    for t in times:
        if last is None or t - last >= 2_000:
            found.append(("hot", t))
            last = t
    got = sorted((r["key"], r["ms"]) for r in approvals.window_openings(points, 2_000, 700).collect())
    assert got == found + [("one", 5), ("two", 5), ("two", 2_005)]
