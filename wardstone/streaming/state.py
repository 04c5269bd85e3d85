"""Streaming twins of the keyed state machines.

State per key is a few numbers. A micro-batch brings a key's new events, which are put in order
before the machine steps through them; a rate limit on the source (``maxFilesPerTrigger``,
``maxOffsetsPerTrigger``) bounds how many that are. The source must deliver a key's events in
order across batches, as one keyed log partition does; the batch jobs need no order at all.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from wardstone.operators import health
from wardstone.operators.approvals import refusal_code
from wardstone.operators.quota import millis
from wardstone.sources import fixed_values as fixed


def checkpoint_location(spark, name: str, fallback: str | None = None) -> str:
    """Folder for a query's progress under the cluster's shared checkpoint folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if root is None:
        raise ValueError("set spark.checkpoint.dir to a shared folder, or pass one")
    return f"{root.rstrip('/')}/{name}"


def _ordered(pdfs) -> pd.DataFrame:
    return pd.concat(list(pdfs)).sort_values(["ms", "seq"], kind="stable")


def token_bucket_stream(
    calls: DataFrame, key: str, ts: str, seq: str, capacity: int = fixed.RATE_LIMIT_PER_MINUTE,
    period_ms: int = fixed.RATE_PERIOD_MS, idle_ms: int = fixed.BUCKET_IDLE_MS, late: str = "10 minutes",
) -> DataFrame:
    """Every call with allowed, remaining and retry_after_ms.

    A bucket is dropped when the watermark is ``idle_ms`` past its last call. That loses nothing
    as long as a bucket refills within that time, so shorter limits are raised to the refill
    period. Calls later than ``late`` are dropped by the watermark.
    """
    full, idle_ms = capacity * period_ms, max(idle_ms, period_ms)
    key_type = dict(calls.dtypes)[key]

    def step(ids, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        tokens, at = state.get if state.exists else (full, None)
        rows = []
        pdf = _ordered(pdfs)
        for ms, s in zip(pdf["ms"].tolist(), pdf["seq"].tolist()):
            tokens = min(full, tokens + capacity * (ms - at)) if at is not None else full
            at = ms
            allowed = tokens >= period_ms
            if allowed:
                tokens -= period_ms
            retry = 0 if allowed else -((tokens - period_ms) // capacity)
            rows.append((ids[0], s, ms, allowed, tokens // period_ms if allowed else 0, retry))
        state.update((tokens, at))
        state.setTimeoutTimestamp(max(at + idle_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(rows, columns=["key", "seq", "ms", "allowed", "remaining", "retry_after_ms"])

    timed = calls.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
    events = timed.select(
        F.col(key).alias("key"), F.col(seq).cast("long").alias("seq"), millis(F.col("__ts")).alias("ms"), "__ts"
    )
    return events.groupBy("key").applyInPandasWithState(
        step, f"key {key_type}, seq long, ms long, allowed boolean, remaining long, retry_after_ms long",
        "tokens long, at long", "append", "EventTimeTimeout",
    )


def health_stream(
    calls: DataFrame, key: str, ts: str, seq: str, failed: str, failures: int = fixed.BREAKER_FAILURES,
    successes: int = fixed.BREAKER_SUCCESSES, open_ms: int = fixed.BREAKER_OPEN_MS,
) -> DataFrame:
    """Every call with the mode it met, whether it was admitted, and the mode after it."""
    key_type = dict(calls.dtypes)[key]

    def step(ids, pdfs, state):
        current = state.get if state.exists else (health.CLOSED, 0, 0, 0)
        rows = []
        pdf = _ordered(pdfs)
        for ms, s, bad in zip(pdf["ms"].tolist(), pdf["seq"].tolist(), pdf["failed"].tolist()):
            current, met, admitted = health.step(current, ms, bad, failures, successes, open_ms)
            rows.append((ids[0], ms, s, met, admitted, current[0]))
        state.update(current)
        yield pd.DataFrame(rows, columns=["key", "ms", "seq", "met", "admitted", "mode"])

    events = calls.select(
        F.col(key).alias("key"), F.col(seq).cast("long").alias("seq"), millis(F.col(ts)).alias("ms"),
        F.coalesce(F.col(failed), F.lit(False)).alias("failed"),
    )
    return events.groupBy("key").applyInPandasWithState(
        step, f"key {key_type}, ms long, seq long, met string, admitted boolean, mode string",
        "mode string, bad long, good long, opened long", "append", "NoTimeout",
    )


class _Sessions(StatefulProcessor):
    """The session that a key is in: told when it has been idle for long enough, or at a reset."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle) -> None:
        self.session = handle.getValueState("session", "first_ms long, last_ms long, turns long, milli_risk long")
        self.handle = handle

    def _told(self, key, session) -> Row:
        return Row(key=key[0], first_ms=session[0], last_ms=session[1], turns=session[2], risk=session[3] / 1000)

    def handleInputRows(self, key, rows, timerValues):
        session = self.session.get() if self.session.exists() else None
        for ms, turn, milli_risk in sorted((r["ms"], r["turn"], r["milli_risk"]) for r in rows):  # a reset before a turn of its time
            if session is not None and (not turn or ms - session[1] >= self.idle_ms):
                yield self._told(key, session)
                session = None
            if turn:
                session = (ms, ms, 1, milli_risk) if session is None else (session[0], ms, session[2] + 1, session[3] + milli_risk)
        if session is None:
            self.session.clear()
        else:
            self.session.update(session)
            self.handle.registerTimer(session[1] + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        session = self.session.get() if self.session.exists() else None
        if session is not None and session[1] + self.idle_ms <= expiredTimerInfo.getExpiryTimeInMs():
            yield self._told(key, session)
            self.session.clear()

    def close(self) -> None:
        pass


def session_stream(
    turns: DataFrame, key: str, ts: str, risk: str, late: str = "10 minutes", idle_seconds: int = fixed.SESSION_IDLE_SECONDS,
    resets: DataFrame | None = None,
) -> DataFrame:
    """Sessions that ended, by idle time or a reset: key, first_ms, last_ms, turns, risk.

    Turns and resets are one stream of events. The state store must be RocksDB, as event timers need it.
    """
    kind = dict(turns.dtypes)[key]
    own = turns.select(F.col(key).alias("key"), F.col(ts).cast("timestamp").alias("at"), millis(F.col(ts)).alias("ms"), F.lit(True).alias("turn"), F.round(F.col(risk) * 1000).cast("long").alias("milli_risk"))
    if resets is not None:
        own = own.unionByName(resets.select(F.col(key).alias("key"), F.col(ts).cast("timestamp").alias("at"), millis(F.col(ts)).alias("ms"), F.lit(False).alias("turn"), F.lit(0).cast("long").alias("milli_risk")))
    return own.withWatermark("at", late).groupBy("key").transformWithState(
        statefulProcessor=_Sessions(idle_seconds * 1000), outputStructType=f"key {kind}, first_ms long, last_ms long, turns long, risk double", outputMode="Append", timeMode="EventTime",
    )


_EVENT = (
    "approval_id string, at timestamp, ms long, kind string, requester string, created_at timestamp, severity string, cancelled boolean, "
    "decided_at timestamp, decision string, justification string, decider string, decided_via string"
)
_REQUEST = ["requester", "created_at", "severity", "cancelled"]
_DECISION = ["decided_at", "decision", "justification", "decider", "decided_via"]


class _Ledger(StatefulProcessor):
    """Keeps the request of an approval and the decisions on it, and hands both on when the request expires.

    A decision that comes later is handed on at once, one without a request once no request can come any more. All of it
    is forgotten ``keep_ms`` after expiry.
    """

    def __init__(self, expiry_ms: int, keep_ms: int):
        self.expiry_ms, self.keep_ms = expiry_ms, keep_ms

    def init(self, handle) -> None:
        self.request = handle.getValueState("request", "requester string, created_at timestamp, severity string, cancelled boolean, ms long, told boolean")
        self.decisions = handle.getListState("decisions", "decided_at timestamp, decision string, justification string, decider string, decided_via string")
        self.handle = handle

    def _row(self, key, request, decisions, settles: bool) -> Row:
        return Row(approval_id=key[0], settles=settles, request=request[:4] if request else None, decisions=[tuple(d) for d in decisions])

    def handleInputRows(self, key, rows, timerValues):
        request = self.request.get() if self.request.exists() else None
        held = []
        for row in rows:
            if row["kind"] == "request":
                if request is None:
                    request = (*(row[c] for c in _REQUEST), row["ms"], False)
                    self.request.update(request)
                    self.handle.registerTimer(row["ms"] + self.expiry_ms)
            else:
                held.append(tuple(row[c] for c in _DECISION))
                if request is None:
                    self.handle.registerTimer(row["ms"] + self.expiry_ms)
        if request is not None and request[5]:
            if held:
                yield self._row(key, request, held, False)
        else:
            for one in held:
                self.decisions.appendValue(one)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        request = self.request.get() if self.request.exists() else None
        if request is not None and request[5]:
            self.request.clear()
            return
        decisions = list(self.decisions.get()) if self.decisions.exists() else []
        if request is not None and expiredTimerInfo.getExpiryTimeInMs() < request[4] + self.expiry_ms:
            return  # the timer of a decision that came before its request
        if request is not None or decisions:
            yield self._row(key, request, decisions, request is not None)
        self.decisions.clear()
        if request is not None:
            self.request.update((*request[:5], True))
            self.handle.registerTimer(expiredTimerInfo.getExpiryTimeInMs() + self.keep_ms)

    def close(self) -> None:
        pass


def approval_stream(
    requests: DataFrame, decisions: DataFrame, late: str = "5 minutes", expiry_seconds: int = fixed.APPROVAL_EXPIRY_SECONDS,
    cooldown_seconds: int = fixed.APPROVAL_COOLDOWN_SECONDS, keep_seconds: int = 86_400,
) -> DataFrame:
    """What became of each request, by the rules of the batch ledger: approval_id, status, justification, refusals.

    Requests and decisions are one stream of events, kept by approval until the watermark says that a request has expired;
    then its status is told, with the code of every refused decision. Refused decisions that come after it, or on no known
    request, are told in rows without a status. The state store must be RocksDB
    (``spark.sql.streaming.stateStore.providerClass``), as event timers need it.
    """
    kinds = [f.split(" ") for f in _EVENT.split(", ")]

    def events(df: DataFrame, kind: str, at: str, have: list[str]) -> DataFrame:
        own = {"kind": F.lit(kind), "at": F.col(at), "ms": millis(F.col(at))} | {c: F.col(c) for c in ["approval_id", *have] if c in df.columns}
        return df.select(*(own.get(c, F.lit(None)).cast(t).alias(c) for c, t in kinds))

    both = events(requests, "request", "created_at", _REQUEST).unionByName(events(decisions, "decision", "decided_at", _DECISION))
    out = (
        "approval_id string, settles boolean, request struct<requester:string,created_at:timestamp,severity:string,cancelled:boolean>, "
        "decisions array<struct<decided_at:timestamp,decision:string,justification:string,decider:string,decided_via:string>>"
    )
    told = both.withWatermark("at", late).groupBy("approval_id").transformWithState(
        statefulProcessor=_Ledger(expiry_seconds * 1000, keep_seconds * 1000), outputStructType=out, outputMode="Append", timeMode="EventTime",
    )
    r = F.col("request")

    def judged(d):
        return refusal_code(r.isNotNull(), r["requester"], r["created_at"], r["severity"], d["decider"], d["decided_via"], d["decided_at"], expiry_seconds, cooldown_seconds)

    counted = F.array_min(F.transform(F.filter("decisions", lambda d: judged(d).isNull()), lambda d: F.struct(d["decided_at"].alias("decided_at"), d["decision"].alias("decision"), d["justification"].alias("justification"))))
    refused = F.array_sort(F.array_compact(F.transform("decisions", lambda d: F.when(judged(d).isNotNull(), F.struct(d["decided_at"].alias("decided_at"), judged(d).alias("refusal"))))))
    status = F.when(~F.col("settles"), None).when(r["cancelled"], "cancelled").otherwise(F.coalesce(F.col("__counted")["decision"], F.lit("expired")))
    return told.withColumn("__counted", counted).select(
        "approval_id", status.alias("status"), F.when(F.col("settles"), F.col("__counted")["justification"]).alias("justification"), refused.alias("refusals"),
    )


class _Openings(StatefulProcessor):
    """When the window of a content was opened; forgotten once the window has passed."""

    def __init__(self, width_ms: int):
        self.width_ms = width_ms

    def init(self, handle) -> None:
        self.opened = handle.getValueState("opened", "ms long")
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues):
        opened = self.opened.get()[0] if self.opened.exists() else None
        for ms, seq in sorted((r["ms"], r["seq"]) for r in rows):
            opens = opened is None or ms - opened >= self.width_ms
            opened = ms if opens else opened
            yield Row(hash=key[0], seq=seq, duplicate=not opens)
        self.opened.update((opened,))
        self.handle.registerTimer(opened + self.width_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.opened.exists() and self.opened.get()[0] + self.width_ms <= expiredTimerInfo.getExpiryTimeInMs():
            self.opened.clear()
        yield from ()

    def close(self) -> None:
        pass


def distinct_request_stream(
    requests: DataFrame, hash_col: str, ts: str, seq: str, window_seconds: int = fixed.APPROVAL_EXPIRY_SECONDS, late: str = "5 minutes"
) -> DataFrame:
    """Each request with ``duplicate``, as the batch job gives it: hash, seq, duplicate.

    The state store must be RocksDB, as event timers need it.
    """
    kind = dict(requests.dtypes)[seq]
    own = requests.select(F.col(hash_col).alias("hash"), F.col(ts).cast("timestamp").alias("at"), millis(F.col(ts)).alias("ms"), F.col(seq).alias("seq"))
    return own.withWatermark("at", late).groupBy("hash").transformWithState(
        statefulProcessor=_Openings(window_seconds * 1000), outputStructType=f"hash string, seq {kind}, duplicate boolean", outputMode="Append", timeMode="EventTime",
    )
