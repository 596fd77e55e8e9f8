"""Counts as of a time, bursts and health of hosts as streams."""

import random

import numpy as np
from pyspark.sql import functions as F

from waymark.operators.logs import bursts, folded, health_after
from waymark.operators.trailing import HOUR_US, counts_as_of, trailing_counts
from waymark.streaming.state import rocksdb, streaming_bursts, streaming_health


def test_counts_as_of_any_time(spark):
    rng = random.Random(1)
    events = [(rng.randint(-50, 400), rng.choice("ab")) for _ in range(300)]
    probes = [(i, rng.randint(-80, 450), rng.choice("ab"), rng.random() < 0.5) for i in range(200)]
    left = spark.createDataFrame(events, "at long, kind string")
    right = spark.createDataFrame(probes, "id long, at long, kind string, strict boolean")
    for by in ([], ["kind"]):
        for slice_us in (1, 7, 1000):
            got = {r.id: r.n for r in counts_as_of(left.select("at", *by), right.select("id", "at", *by, "strict"), by, slice_us).collect()}
            for i, at, kind, strict in probes:
                assert got[i] == sum(1 for t, k in events if (t < at or (t == at and not strict)) and (not by or k == kind))


def test_trailing_hour_with_ties_and_edges(spark):
    rng = random.Random(2)
    times = [rng.randint(0, 6) * HOUR_US // 2 + rng.choice([0, 0, 1, -1]) for _ in range(120)]
    rows = spark.createDataFrame(list(enumerate(times)), "id long, at long")
    got = {r.id: r.n for r in trailing_counts(rows, []).collect()}
    for i, t in enumerate(times):
        assert got[i] == sum(1 for x in times if t - HOUR_US <= x <= t)
    assert trailing_counts(rows.limit(0), []).count() == 0


def failures(rng, n):
    at, rows = np.datetime64("2024-01-01T00:00:00"), []
    for i in range(n):
        at += np.timedelta64(rng.choice([1, 20, 40, 200, 5000]), "s")
        rows.append((i, at.astype("datetime64[us]").item(), rng.choice([1, 2, None]), rng.choice(["timeout", "timeout", "other", "403 Forbidden", None]), rng.random() < 0.3))
    return rows


SCHEMA = "event_id long, ts timestamp, host long, error_message string, ok boolean"


def run(spark, stream, folder, checkpoint, mode):
    def keep(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(folder)

    with rocksdb(spark):
        query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(keep).trigger(availableNow=True).start()
    query.awaitTermination()


def test_burst_stream_equals_the_batch_over_triggers_and_a_restart(spark, tmp_path):
    rows = failures(random.Random(3), 240)
    folder, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    for part in range(4):
        spark.createDataFrame(rows[part * 60 : part * 60 + 60], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        if part % 2:  # the query ends after two files and starts again from its checkpoint
            stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
            run(spark, streaming_bursts(stream, "host"), out, state, "append")
    table = spark.read.parquet(out)
    assert table.select("batch").distinct().count() == 4
    want = {r.event_id: r.blocked for r in bursts(spark.createDataFrame(rows, SCHEMA), "host").collect()}
    got = {r.event_id: r.blocked for r in table.collect()}
    assert got == want and 10 < sum(got.values()) < 230


def test_buffers_are_forgotten_after_their_time(spark, tmp_path):
    first = [(i, f"2024-01-01 00:00:{i:02d}", 1) for i in range(6)]
    later = [(10 + i, f"2024-01-03 00:00:{i:02d}", 2 if i else 1) for i in range(3)]
    last = [(20 + i, f"2024-01-03 00:01:{i:02d}", 1) for i in range(4)]
    folder, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    for part in (first, later, last):
        frame = spark.createDataFrame(part, "event_id long, at string, host long").selectExpr("event_id", "CAST(at AS timestamp) AS ts", "host", "'x' AS error_message")
        frame.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        run(spark, streaming_bursts(stream, "host", most=10, least=5, ttl="1 hour"), out, state, "append")
    got = {r.event_id: r.blocked for r in spark.read.parquet(out).collect()}
    # the old buffer of host 1 is gone: five quick failures of its new life mark the last
    assert [i for i in sorted(got) if got[i]] == [4, 5, 23]


def test_health_stream_equals_the_fold_over_triggers_and_timers(spark, tmp_path):
    rows = failures(random.Random(5), 200)
    folder, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    for part in range(4):
        spark.createDataFrame(rows[part * 50 : part * 50 + 50], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
        run(spark, streaming_health(stream, F.col("host"), F.col("ok"), late="1 second"), out, state, "update")
    last = spark.read.parquet(out).groupBy("host").agg(F.max_by(F.struct("score", "failures", "active", "n"), "version").alias("h"))
    got = {r.host: tuple(r.h) for r in last.collect()}
    at = F.unix_micros("ts") / 1e6
    batch = folded(spark.createDataFrame(rows, SCHEMA), "host", ["ts", "event_id"], [F.col("ok"), at], (100, 0, True, 0.0), health_after, "score long, failures long, active boolean, last double")
    until = spark.createDataFrame(rows, SCHEMA).agg(F.max(F.unix_micros("ts") / 1e6)).first()[0] - 1
    for r in batch.collect():
        forgiven = not r.active and until - r["last"] > 3600
        assert got[r.host] == (r.score, 0 if forgiven else r.failures, r.active or forgiven, r.n)


def test_a_timer_switches_a_host_on_again(spark, tmp_path):
    rows = [(i, f"2024-01-01 00:0{i}:00", 1, False) for i in range(4)] + [(9, "2024-01-01 05:00:00", 2, True)]
    frame = spark.createDataFrame(rows, "event_id long, at string, host long, ok boolean").selectExpr("event_id", "CAST(at AS timestamp) AS ts", "host", "ok")
    frame.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/in")
    run(spark, streaming_health(stream, F.col("host"), F.col("ok")), f"{tmp_path}/out", f"{tmp_path}/state", "update")
    seen = sorted((r.version, r.active, r.failures) for r in spark.read.parquet(f"{tmp_path}/out").where("host = 1").collect())
    assert seen == [(1, False, 4), (2, True, 0)]
