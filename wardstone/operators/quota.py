"""Token-bucket quotas per key, and audits of call volumes.

Tokens are kept as integers, ``period_ms`` units each, so a refill of ``capacity`` units per
millisecond is exact. A bucket starts full, refills continuously up to its capacity, and each
call takes one token or is denied.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstone.operators.chunks import scan_in_chunks
from wardstone.sources import fixed_values as fixed
from wardstone.sources.tables import fixed_table, lookup


def millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def _add_piece(pieces: list, lo: int, hi: int, base: int, slope: int) -> None:
    if pieces:
        p = pieces[-1]
        if p[3] == slope and base == p[2] + slope * (lo - p[0]):
            p[1] = hi
            return
    pieces.append([lo, hi, base, slope])


def _drain(pieces: list, gain: int, calls: int, unit: int, full: int) -> list:
    """Transfer pieces [lo, hi, value at lo, slope 0 or 1] after a refill and ``calls`` calls."""
    out: list = []
    for lo, hi, base, slope in pieces:
        base += gain
        if slope == 0 or base >= full:
            base = min(base, full)
            _add_piece(out, lo, hi, base - unit * min(calls, base // unit), 0)
            continue
        cut = min(hi, lo + full - base - 1)  # the last entry value that does not fill the bucket
        x = lo
        while x <= cut:
            taken = min(calls, base // unit)
            end = cut if taken == calls else min(cut, x + (taken + 1) * unit - base - 1)
            _add_piece(out, x, end, base - unit * taken, 1)
            base += end - x + 1
            x = end + 1
        if cut < hi:
            _add_piece(out, cut + 1, hi, full - unit * min(calls, full // unit), 0)
    return out


def _buckets(calls: DataFrame, key: str, capacity: int, period_ms: int, chunk_ms: int):
    """Per (key, millisecond): tokens before the calls and how many were let through."""
    full = capacity * period_ms

    def summarise(rows: dict[str, list], start: int) -> tuple:
        pieces, at = [[0, full, 0, 1]], start
        for ms, n in zip(rows["ms"], rows["n"]):
            pieces = _drain(pieces, capacity * (ms - at), n, period_ms, full)
            at = ms
        return [p[0] for p in pieces], [p[2] for p in pieces], [p[3] for p in pieces], at

    def fold(state: tuple | None, start: int, summary: tuple) -> tuple[tuple, tuple]:
        lo, base, slope, last = summary
        tokens = full if state is None else min(full, state[0] + capacity * (start - state[1]))
        i = bisect_right(lo, tokens) - 1
        after = int(base[i] + slope[i] * (tokens - lo[i]))
        return (tokens, after, last), (after, last)

    def replay(rows: dict[str, list], start: int, entry: tuple) -> list[tuple]:
        tokens, at, out = entry[0], start, []
        for ms, n in zip(rows["ms"], rows["n"]):
            tokens = min(full, tokens + capacity * (ms - at))
            taken = min(n, tokens // period_ms)
            out.append((ms, tokens, taken))
            tokens, at = tokens - taken * period_ms, ms
        return out

    # Calls in the same millisecond are counted before anything is shuffled by key, so a chunk
    # never holds more rows than it has milliseconds.
    per_ms = calls.groupBy(key, "ms").agg(F.count(F.lit(1)).alias("n"))
    return scan_in_chunks(
        per_ms, key, chunk_ms, summarise, "lo array<long>, base array<long>, slope array<long>, last_ms long",
        fold, "tokens long, tokens_after long, last_ms long", replay, "ms long, tokens long, taken long",
    )


def token_bucket(
    calls: DataFrame, key: str, ts: str, seq: str, capacity: int = fixed.RATE_LIMIT_PER_MINUTE,
    period_ms: int = fixed.RATE_PERIOD_MS, chunk_ms: int = 600_000,
) -> DataFrame:
    """Every call with allowed, remaining and retry_after_ms (0 for allowed calls)."""
    timed = calls.withColumn("ms", millis(F.col(ts)))
    state, _ = _buckets(timed.select(key, "ms"), key, capacity, period_ms, chunk_ms)
    nth = F.row_number().over(Window.partitionBy(key, "ms").orderBy(seq))
    joined = timed.join(state, [key, "ms"]).withColumn("nth", nth)
    allowed = F.col("nth") <= F.col("taken")
    left = F.col("tokens") - F.least("nth", "taken") * period_ms
    return joined.select(
        *calls.columns,
        allowed.alias("allowed"),
        F.when(allowed, F.floor(left / period_ms)).otherwise(0).cast("long").alias("remaining"),
        F.when(allowed, 0).otherwise(F.ceil((period_ms - left) / capacity)).cast("long").alias("retry_after_ms"),
    )


def remaining_tokens(
    calls: DataFrame, key: str, ts: str, keys: DataFrame, as_of: str, capacity: int = fixed.RATE_LIMIT_PER_MINUTE,
    period_ms: int = fixed.RATE_PERIOD_MS, chunk_ms: int = 600_000,
) -> DataFrame:
    """Whole tokens left for each of ``keys`` at the time ``as_of``; unseen keys have them all."""
    at = F.unix_millis(F.lit(as_of).cast("timestamp"))
    timed = calls.withColumn("ms", millis(F.col(ts))).filter(F.col("ms") <= at)
    _, entries = _buckets(timed.select(key, "ms"), key, capacity, period_ms, chunk_ms)
    last = entries.groupBy(key).agg(F.max_by(F.struct("tokens_after", "last_ms"), "chunk").alias("s"))
    tokens = F.floor((F.col("s.tokens_after") + (at - F.col("s.last_ms")) * capacity) / period_ms)
    return keys.join(last, key, "left").select(
        key, F.least(F.lit(capacity), F.coalesce(tokens, F.lit(capacity))).cast("long").alias("remaining")
    )


def idle_keys(calls: DataFrame, key: str, ts: str, as_of: str, idle_ms: int = fixed.BUCKET_IDLE_MS) -> DataFrame:
    """Last call of each key and whether its state may be dropped: after an idle hour it is full again."""
    at = F.unix_millis(F.lit(as_of).cast("timestamp"))
    last = calls.select(key, millis(F.col(ts)).alias("ms")).filter(F.col("ms") <= at).groupBy(key).agg(F.max("ms").alias("last_ms"))
    return last.withColumn("evicted", at - F.col("last_ms") > idle_ms)


def quota_statistics(calls: DataFrame, key: str, ts: str, as_of: str, capacity: int = fixed.RATE_LIMIT_PER_MINUTE) -> DataFrame:
    """Number of live buckets and their capacity."""
    live = idle_keys(calls, key, ts, as_of).filter("NOT evicted")
    return live.agg(F.count(F.lit(1)).alias("active_keys")).withColumn("capacity", F.lit(capacity))


def tier_table(spark) -> DataFrame:
    return fixed_table(spark, ["tier", "deepest_layer", "per_minute", "per_month"], fixed.TIERS)


def tier_audit(calls: DataFrame, key: str, ts: str, tier: str) -> DataFrame:
    """Per key and month: calls, busiest minute, and whether either limit of the tier was passed.

    Minutes are counted first (with partial counts before the shuffle) and months from them.
    """
    minute = F.date_trunc("minute", F.col(ts))
    per_minute = calls.groupBy(key, tier, minute.alias("minute")).agg(F.count(F.lit(1)).alias("n"))
    per_month = per_minute.groupBy(key, tier, F.date_trunc("month", "minute").alias("month")).agg(
        F.sum("n").alias("calls"), F.max("n").alias("busiest_minute")
    )
    joined = lookup(per_month, tier_table(calls.sparkSession), tier)
    return joined.select(
        key, tier, "month", "calls", "busiest_minute",
        F.coalesce(F.col("calls") > F.col("per_month"), F.lit(False)).alias("over_month"),
        F.coalesce(F.col("busiest_minute") > F.col("per_minute"), F.lit(False)).alias("over_minute"),
    )
