"""Streaming forms of the log analytics, as plain Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from waymark.functions.text import error_class
from waymark.operators.logs import delay_after
from waymark.sources.views import error_message_sql


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """Event files (a folder, or one file) as a stream with a proper event time."""
    table = spark.read.parquet(path)
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_trigger)
    folder, _, name = path.rstrip("/").rpartition("/")
    if any(f.rstrip("/").endswith(f"/{name}") for f in table.inputFiles()):  # streams read folders only
        reader, path = reader.option("pathGlobFilter", name), folder
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def with_messages(events: DataFrame) -> DataFrame:
    """Error events with the messages that the view `failures` gives them."""
    return events.withColumn("error_message", F.expr(error_message_sql()))


def hourly_failures(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Failures per hour (tumbling windows)."""
    failed = events.where("event_type = 'error'").withWatermark("ts", late)
    return failed.groupBy(F.window("ts", "1 hour")).agg(F.count("*").alias("n")).select(F.col("window.start").alias("hour"), "n")


def failure_patterns(failures: DataFrame, late: str = "1 hour", share: float = 0.3) -> DataFrame:
    """Classes of failures in sliding hours, and whether missing selectors exceed a share of them (a structure change)."""
    windows = failures.withWatermark("ts", late).groupBy(F.window("ts", "1 hour", "5 minutes"))
    missing = F.count_if(error_class(F.col("error_message")) == "selector_missing")
    out = windows.agg(F.count("*").alias("n"), missing.alias("missing"))
    return out.select(F.col("window.start").alias("start"), "n", "missing", (F.col("missing") > share * F.col("n")).alias("changed"))


def fresh_only(rows: DataFrame, key: str, hours: int = 24) -> DataFrame:
    """Rows whose key was not seen within some hours (a cache with a time to live)."""
    return rows.withWatermark("ts", f"{hours} hours").dropDuplicatesWithinWatermark([key])


def sessions(events: DataFrame, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Activity sessions per key."""
    grouped = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), key)
    return grouped.agg(F.count("*").alias("n")).select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def adaptive_delays(events: DataFrame, key: str) -> DataFrame:
    """Request delay per key after each batch; outcomes count in event order within a batch."""

    def update(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        delay, ok, failed, n = state.get if state.exists else (2.0, 0, 0, 0)
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        delay, ok, failed = delay_after((rows["event_type"] != "error").tolist(), delay, ok=ok, failed=failed)
        state.update((delay, ok, failed, n + len(rows)))
        yield pd.DataFrame([(name[0], delay, n + len(rows))], columns=[key, "delay", "n"])

    return events.groupBy(key).applyInPandasWithState(
        update, f"{key} long, delay double, n long", "delay double, ok long, failed long, n long", "update", "NoTimeout"
    )


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there and stop; an outside scheduler starts it again, the checkpoint resumes it."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query.format("parquet").option("path", path).start().awaitTermination()
