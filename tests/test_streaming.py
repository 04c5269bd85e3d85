"""Streams give what the batch jobs give."""

import pytest
from pyspark.sql import functions as F

from wardstone.operators import approvals, health, quota, sessions
from wardstone.streaming import refresh, state

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def calls(spark, tmp_path_factory):
    """Calls as files in time order, for a stream that reads one file per batch."""
    folder = str(tmp_path_factory.mktemp("calls"))
    df = spark.read.parquet(f"{SF}/events.parquet").select(
        F.col("user_id").alias("key"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"),
        (F.col("event_type") == "error").alias("failed"), ((F.col("event_id") % 100) / 100).alias("risk"))
    for part in range(3):
        low, high = f"2024-01-{1 + part * 10:02d}", f"2024-01-{11 + part * 10:02d}" if part < 2 else "2025-01-01"
        df.filter((F.col("ts") >= low) & (F.col("ts") < high)).coalesce(1).write.mode("append").parquet(folder)
    return folder, spark.read.parquet(folder)


@pytest.fixture
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set(name, before)


def drain(spark, stream, name, tmp_path):
    query = (stream.writeStream.outputMode("append").format("memory").queryName(name)
             .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start())
    try:
        assert query.awaitTermination(60)
    finally:
        query.stop()
    return spark.table(name)


def source(spark, calls):
    folder, df = calls
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_token_bucket(spark, calls, tmp_path):
    cols = ["key", "seq", "allowed", "remaining", "retry_after_ms"]
    batch = quota.token_bucket(calls[1], "key", "ts", "seq", 2, 86_400_000, 7_200_000)
    stream = state.token_bucket_stream(source(spark, calls), "key", "ts", "seq", 2, 86_400_000)
    got = rows(drain(spark, stream, "buckets", tmp_path), *cols)
    assert got == rows(batch, *cols)
    assert len({r[2] for r in got}) == 2


def test_health(spark, calls, tmp_path):
    cols = ["key", "ms", "seq", "met", "admitted", "mode"]
    batch = health.health_timeline(calls[1], "key", "ts", "seq", "failed", 2, 2, 43_200_000, 7_200_000)
    stream = state.health_stream(source(spark, calls), "key", "ts", "seq", "failed", 2, 2, 43_200_000)
    assert rows(drain(spark, stream, "health", tmp_path), *cols) == rows(batch, *cols)


def test_sessions(spark, rocksdb, calls, tmp_path):
    """The stream has every session but those its watermark still holds open."""
    cols = ["key", "first_ms", "last_ms", "turns", "risk"]
    batch = rows(sessions.sessions(calls[1], "key", "ts", "risk"), *cols)
    got = rows(drain(spark, state.session_stream(source(spark, calls), "key", "ts", "risk"), "sessions", tmp_path), *cols)
    last = max(r[2] for r in batch)
    assert set(got) <= set(batch)
    assert all(r[2] > last - 7_200_000 - 600_000 for r in set(batch) - set(got))


def test_distinct_requests(spark, rocksdb, calls, tmp_path):
    def hashed(df):
        return df.withColumn("hash", (F.col("seq") % 5).cast("string"))

    batch = approvals.distinct_requests(hashed(calls[1]), "hash", "ts", "seq", 86_400)
    stream = state.distinct_request_stream(hashed(source(spark, calls)), "hash", "ts", "seq", 86_400)
    got = rows(drain(spark, stream, "distinct", tmp_path), "seq", "duplicate")
    assert got == rows(batch, "seq", "duplicate") and sum(not d for _, d in got) > 20


def test_sessions_with_resets(spark, rocksdb, tmp_path):
    hour, turns, resets = 3_600_000, [], []
    for key in (1, 2, 3):
        at = 1_000 * hour
        for i in range(40):
            at += [600_000, 60_000, 3 * hour, 1_000][(i * key) % 4]
            turns.append((key, at, (i % 10) / 10))
            if i % 9 == key:
                resets.append((key, at + (0 if i % 2 else 500)))
    frames = [spark.createDataFrame(turns, "key long, at long, risk double"), spark.createDataFrame(resets, "key long, at long")]
    frames = [df.select("*", F.timestamp_millis("at").alias("ts")) for df in frames]
    end = spark.createDataFrame([(9, 2_000 * hour, 0.0)], "key long, at long, risk double").select("*", F.timestamp_millis("at").alias("ts"))
    for name, parts in (("t", [frames[0], end]), ("r", [frames[1]])):
        for part in parts:
            part.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    streams = [spark.readStream.schema(df.schema).parquet(str(tmp_path / name)) for df, name in zip(frames, "tr")]
    cols = ("key", "first_ms", "last_ms", "turns", "risk")
    got = rows(drain(spark, state.session_stream(streams[0], "key", "ts", "risk", "1 minute", 7_200, streams[1]), "resets", tmp_path), *cols)
    assert got == rows(sessions.sessions(frames[0], "key", "ts", "risk", frames[1], 7_200), *cols) and len(got) > 30


def test_approvals(spark, rocksdb, tmp_path):
    """The stream tells what the batch ledger says: statuses, justifications and the code of every refusal."""
    minute, rows_r, rows_d = 60_000, [], []
    for i in range(120):
        at = (10_000 + i * 4) * minute
        rows_r.append((f"a{i}", "ann", at, ["low", "medium", "high", None][i % 4], i % 17 == 0))
        for k in range(i % 4):
            rows_d.append((f"a{i}", at + [30_000, 5 * minute, 20 * minute, 45 * minute][(i + k) % 4], ["approved", "rejected"][k % 2], f"why {k}",
                           ["bob", "ann", None][(i // 4 + k) % 3], ["dashboard", "agent", "scanner"][(i // 3 + k) % 3]))
    rows_d += [("a1", 10_004 * minute + 30_000, "approved", "quick", "bob", "agent"), ("nobody", 10_050 * minute, "approved", "x", "bob", "dashboard"), ("a3", 10_600 * minute, "approved", "late", "bob", "dashboard")]
    end = [("end", "ann", 14_000 * minute, "low", False)]
    kinds = ["approval_id string, requester string, ms long, severity string, cancelled boolean", "approval_id string, ms long, decision string, justification string, decider string, decided_via string"]
    frames = [spark.createDataFrame(rows, kind).withColumn(name, F.timestamp_millis("ms")).drop("ms") for rows, kind, name in ((rows_r, kinds[0], "created_at"), (rows_d, kinds[1], "decided_at"))]
    last = spark.createDataFrame(end, kinds[0]).withColumn("created_at", F.timestamp_millis("ms")).drop("ms")
    sources = []
    for name, parts in (("r", [frames[0].where("approval_id < 'a5'"), frames[0].where("approval_id >= 'a5'"), last]), ("d", [frames[1]])):
        for part in parts:
            part.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        sources.append(spark.readStream.schema(parts[0].schema).parquet(str(tmp_path / name)))
    told = drain(spark, state.approval_stream(*sources, late="1 minute"), "approvals", tmp_path).collect()
    batch = approvals.approval_states(frames[0], frames[1], "1970-01-09 18:00:00").collect()
    assert {r.approval_id: (r.status, r.justification) for r in told if r.status} == {r.approval_id: (r.status, r.justification) for r in batch}
    refused = approvals.decision_refusals(frames[0], frames[1]).where("refusal IS NOT NULL").collect()
    assert sorted((r.approval_id, x.decided_at, x.refusal) for r in told for x in r.refusals) == sorted((r.approval_id, r.decided_at, r.refusal) for r in refused)
    assert {r.refusal for r in refused} == {"APPROVAL_NOT_FOUND", "SCANNER_ROUTE_DENIED", "DASHBOARD_REQUIRED", "COOLDOWN_ACTIVE", "SELF_APPROVAL_BLOCKED", "EXPIRED"}
    assert {r.status for r in batch} == {"approved", "rejected", "expired", "cancelled"}


def test_catalogue_refresh_keeps_last_good(spark, tmp_path):
    good = [(0, r"(?i)\bGB\d{6}\b", "pii_iban", 0.9), (1, "x", "pii_unheard_of", 1.0), (2, "(", "pii_ssn", 0.5)]
    schema = "ordinal long, pattern string, threat_type string, confidence double"
    answers = [spark.createDataFrame(good, schema), spark.createDataFrame([], schema), None]

    def read():
        if not answers:
            raise OSError("unreachable")
        return answers.pop(0)

    live = refresh.LiveCatalogue(read)
    assert [d.name for d in live.refresh()] == ["iban"]
    assert [d.name for d in live.refresh()] == ["iban"]
    assert [d.name for d in live.refresh()] == ["iban"]
    assert [d.name for d in live.refresh()] == ["iban"] and live.last_error == "unreachable"


def test_redact_stream(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("mail a@b.co",), ("clean",)], "text string").write.parquet(folder)
    live = refresh.LiveCatalogue(lambda: None)
    query = refresh.redact_stream(
        spark.readStream.schema("text string").parquet(folder), "text", live,
        lambda df, _: df.write.mode("append").parquet(out), str(tmp_path / "cp"))
    query.processAllAvailable()
    query.stop()
    assert {r[0] for r in spark.read.parquet(out).select("redacted_text").collect()} == {"mail [EMAIL_1]", "clean"}
