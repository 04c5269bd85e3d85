"""Sessions of turns with accumulated risk: idle expiry, explicit resets, statistics.

A session ends after two idle hours or at a reset of its owner. Sessions are built from buckets
no wider than the idle time, in which turns always belong together; the turns of a bucket are
reduced to one row first, so only one row per owner and bucket meets in a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstone.operators.quota import millis
from wardstone.sources import fixed_values as fixed


def sessions(
    turns: DataFrame, key: str, ts: str, risk: str, resets: DataFrame | None = None,
    idle_seconds: int = fixed.SESSION_IDLE_SECONDS, bucket_seconds: int = 600,
) -> DataFrame:
    """One row per session: key, session_no, first_ms, last_ms, turns, risk.

    A turn at or after a reset belongs to the session after it. Risk is summed in thousandths, so
    the sum does not depend on the order of work.
    """
    idle, width = idle_seconds * 1000, min(bucket_seconds, idle_seconds) * 1000
    zero = F.lit(0).cast("long")
    points = turns.select(
        F.col(key).alias("key"), millis(F.col(ts)).alias("ms"), F.lit(1).cast("long").alias("turns"),
        F.round(F.col(risk) * 1000).cast("long").alias("milli_risk"), zero.alias("resets"),
    )
    if resets is not None:
        points = points.unionByName(
            resets.select(
                F.col(key).alias("key"), millis(F.col(ts)).alias("ms"), zero.alias("turns"),
                zero.alias("milli_risk"), F.lit(1).cast("long").alias("resets"),
            )
        )
    # 1. one row per (key, millisecond): combines before the shuffle
    points = points.groupBy("key", "ms").agg(*[F.sum(c).alias(c) for c in ("turns", "milli_risk", "resets")])
    points = points.withColumn("bucket", F.floor(F.col("ms") / width))
    # 2. resets so far inside each bucket; one row per (key, bucket, resets so far)
    inside = Window.partitionBy("key", "bucket").orderBy("ms").rowsBetween(Window.unboundedPreceding, 0)
    points = points.withColumn("epoch", F.sum("resets").over(inside))
    parts = points.groupBy("key", "bucket", "epoch").agg(
        F.min(F.when(F.col("turns") > 0, F.col("ms"))).alias("first_ms"),
        F.max(F.when(F.col("turns") > 0, F.col("ms"))).alias("last_ms"),
        *[F.sum(c).alias(c) for c in ("turns", "milli_risk", "resets")],
    )
    # 3. over the bucket rows of a key: resets before, and the gap to the turn before
    order = Window.partitionBy("key").orderBy("bucket", "epoch")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("era", F.sum("resets").over(running))
    parts = parts.withColumn("previous_ms", F.max("last_ms").over(before))
    parts = parts.withColumn("previous_era", F.max(F.when(F.col("turns") > 0, F.col("era"))).over(before))
    starts = (
        F.col("previous_ms").isNull()
        | (F.col("first_ms") - F.col("previous_ms") >= idle)
        | (F.col("era") > F.col("previous_era"))
    )
    parts = parts.filter("turns > 0").withColumn("starts", starts.cast("long"))
    parts = parts.withColumn("session_no", F.sum("starts").over(running))
    return parts.groupBy("key", "session_no").agg(
        F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"), F.sum("turns").alias("turns"),
        (F.sum("milli_risk") / 1000).alias("risk"),
    )


def session_statistics(
    built: DataFrame, as_of_ms: int, high_risk: float, idle_seconds: int = fixed.SESSION_IDLE_SECONDS
) -> DataFrame:
    """Active sessions, turns tracked, high-risk sessions and mean risk at a time."""
    live = built.filter(F.lit(as_of_ms) - F.col("last_ms") < idle_seconds * 1000)
    return live.agg(
        F.count(F.lit(1)).alias("active_sessions"),
        F.coalesce(F.sum("turns"), F.lit(0)).alias("turns_tracked"),
        F.count_if(F.col("risk") >= high_risk).alias("high_risk_sessions"),
        F.coalesce(F.round(F.avg("risk"), 6), F.lit(0.0)).alias("avg_risk"),
    )


def pattern_hits(flags: DataFrame, *patterns: str) -> DataFrame:
    """How many turns showed each pattern: pattern, hits; patterns without any are listed with 0.

    ``flags`` has a column for each pattern, as ``turns.turn_patterns`` gives them. One partial sum per task is shuffled.
    """
    sums = flags.agg(*(F.count_if(F.coalesce(F.col(p), F.lit(False))).alias(p) for p in patterns))
    return sums.select(F.explode(F.array(*(F.struct(F.lit(p).alias("pattern"), F.col(p).alias("hits")) for p in patterns))).alias("x")).select("x.*")
