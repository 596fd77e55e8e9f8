"""Registered streaming queries: run over the available events and hold the closed result as a table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from waymark.operators.logs import BURST_SQL, DELAY_SQL, HEALTH_SQL, IDLE_S
from waymark.plans.durable import shared_dir
from waymark.plans.registry import query
from waymark.streaming.state import rocksdb, streaming_bursts, streaming_health
from waymark.streaming.windows import adaptive_delays, hourly_failures, read_events, with_messages


def _complete(v, stream, mode: str):
    """All rows of a stream's last trigger as a data frame."""
    name = f"s{uuid.uuid4().hex}"
    to = f"{shared_dir(v.spark)}/{name}"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{to}-state").trigger(availableNow=True)

    def keep(batch, number: int) -> None:
        batch.withColumn("batch_", F.lit(number)).write.mode("overwrite" if mode == "complete" else "append").parquet(to)

    with rocksdb(v.spark):
        running = writer.foreachBatch(keep).start()
    running.awaitTermination()
    return v.spark.read.parquet(to)


@query("SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1")
def stream_failure_hourly(v):
    """Hourly failures from a stream in complete mode, so that open windows are there too."""
    out = _complete(v, hourly_failures(read_events(v.spark, f"{v.sf_dir}/events.parquet")), "complete")
    return out.select(F.col("hour").cast("timestamp_ntz").alias("hour"), "n")


@query(DELAY_SQL)
def stream_adaptive_delay(v):
    """Delays per key after the last batch. Outcomes count in order within a batch, so files are to arrive in order."""
    out = _complete(v, adaptive_delays(read_events(v.spark, f"{v.sf_dir}/events.parquet"), "user_id"), "update")
    last = out.groupBy("user_id").agg(F.max_by("delay", "batch_").alias("delay"), F.max_by("n", "batch_").alias("n"))
    return last.withColumn("delay", F.round("delay", 6))


@query(BURST_SQL)
def stream_bursts(v):
    """Marks of failures from a stream; the same as those of the whole log where files arrive in order."""
    events = read_events(v.spark, f"{v.sf_dir}/events.parquet").where("event_type = 'error'")
    return _complete(v, streaming_bursts(with_messages(events), "user_id"), "append").select("event_id", "blocked")


@query(f"""WITH {HEALTH_SQL}, w AS (SELECT epoch_us(max(ts) - INTERVAL 10 MINUTE) AS at FROM events)
SELECT host, CAST(s.score AS BIGINT) AS score, CASE WHEN NOT s.active AND w.at - s.last > {IDLE_S * 1_000_000}::BIGINT THEN 0 ELSE CAST(s.failures AS BIGINT) END AS failures,
  s.active OR w.at - s.last > {IDLE_S * 1_000_000}::BIGINT AS active, n FROM f, w""")
def stream_host_health(v):
    """Score, failures and use of each host from a stream, timers up to the last watermark included."""
    events = read_events(v.spark, f"{v.sf_dir}/events.parquet")
    out = _complete(v, streaming_health(events, F.col("user_id") % 50, F.col("event_type") != "error"), "update")
    last = out.groupBy("host").agg(F.max_by(F.struct("score", "failures", "active", "n"), "version").alias("h"))
    return last.select("host", "h.score", "h.failures", "h.active", "h.n")
