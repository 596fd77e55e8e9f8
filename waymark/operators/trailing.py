"""Windows over time that end at any moment: running counts as of a time, trailing failures, figures of the last day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.text import error_class
from waymark.plans.durable import small_side, written
from waymark.plans.registry import query

HOUR_US, DAY_S = 3_600_000_000, 86_400
#: Microseconds of a slice of time; a task holds the rows of one slice and key.
SLICE_US = 60_000_000


def counts_as_of(events: DataFrame, probes: DataFrame, by: list[str], slice_us: int = SLICE_US) -> DataFrame:
    """probes (id, at, *by, strict) with n: how many events (at, *by) of the same key lie before `at`, at it counted unless strict.

    Time is cut into slices. Events before a probe's slice come from running totals over the slices' counts, whose
    number grows with the time that the table spans and not with its rows; those in the slice from a running count of
    events and probes in order. So no key's rows meet in one task, only those of a key's slice do.
    """
    part = F.floor(F.col("at") / slice_us).alias("slice")
    # among equal times: strict probes, events, other probes
    marks = events.select(*by, "at", part, F.lit(1).alias("place"), F.lit(1).alias("one"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("boolean").alias("strict"))
    asked = probes.select(*by, "at", part, F.when(F.col("strict"), 0).otherwise(2).alias("place"), F.lit(0).alias("one"), "id", "strict")
    both = marks.unionByName(asked)
    totals = both.groupBy(*by, "slice").agg(F.sum("one").alias("inside"))
    earlier = Window.partitionBy(*[F.col(c) for c in by] or [F.lit(0)]).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = written(totals.select(*by, "slice", F.coalesce(F.sum("inside").over(earlier), F.lit(0)).alias("before")))
    running = Window.partitionBy(*by, "slice").orderBy("at", "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = both.withColumn("inside", F.sum("one").over(running)).where("id IS NOT NULL")
    return counted.join(small_side(before), [*by, "slice"]).select("id", "at", *by, "strict", (F.col("before") + F.col("inside")).alias("n"))


def trailing_counts(rows: DataFrame, by: list[str], back_us: int = HOUR_US) -> DataFrame:
    """(id, n) for rows (id, at, *by): rows of the same key from back_us before each row's time up to it, both ends counted."""
    now = rows.select("id", "at", *by, F.lit(False).alias("strict"))
    then = rows.select("id", (F.col("at") - back_us).alias("at"), *by, F.lit(True).alias("strict"))
    counts = counts_as_of(rows.select("at", *by), now.unionByName(then), by)
    return counts.groupBy("id").agg(F.sum(F.when(F.col("strict"), -F.col("n")).otherwise(F.col("n"))).alias("n"))


#: Share of one class among the failures of an hour from which on a page's structure counts as changed.
CHANGED_SHARE = 0.3

CLASS_SQL = """CASE WHEN lower(error_message) LIKE '%no such element%' THEN 'selector_missing' WHEN lower(error_message) LIKE '%timeout%' THEN 'timeout'
  WHEN lower(error_message) LIKE '%forbidden%' THEN 'ip_blocked' WHEN lower(error_message) LIKE '%rate limit%' THEN 'rate_limit' ELSE 'unknown' END"""


def trailing_failures_of(failures: DataFrame) -> DataFrame:
    """(event_id, failures, alike, changed): at every failure the failures of the hour up to it, those of its own class, and
    whether these are more than three in ten. Failures without a time are left out; event_id must tell failures apart."""
    at = F.unix_micros(F.col("ts").cast("timestamp")).alias("at")
    rows = written(failures.where("ts IS NOT NULL").select(F.col("event_id").alias("id"), at, error_class(F.col("error_message")).alias("kind")))
    every, alike = trailing_counts(rows, []), trailing_counts(rows, ["kind"]).withColumnRenamed("n", "alike")
    out = every.join(alike, "id")
    return out.select(F.col("id").alias("event_id"), F.col("n").alias("failures"), "alike", (F.col("alike") > F.col("n") * CHANGED_SHARE).alias("changed"))


@query(f"""WITH f AS (SELECT event_id, ts, {CLASS_SQL} AS kind FROM failures),
w AS (SELECT event_id, count(*) OVER (ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS failures,
  count(*) OVER (PARTITION BY kind ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS alike FROM f)
SELECT event_id, failures, alike, alike > failures * {CHANGED_SHARE} AS changed FROM w""")
def trailing_hour(v):
    return trailing_failures_of(v.failures)


def last_day(log: DataFrame, seconds: Column) -> DataFrame:
    """One row: sessions of the day before the latest one, those completed, success rate, and of the completed ones the mean
    minutes, mean and total stores. An empty log gives zeros and nulls."""
    latest = log.agg(F.max("created_at").alias("until_"))
    last = log.withColumn("seconds_", seconds).join(F.broadcast(latest), F.col("created_at") >= F.col("until_") - F.expr("INTERVAL 1 DAY"))
    done = F.col("status") == "completed"

    def of_done(value: Column) -> Column:
        return F.when(done, value)

    return last.agg(
        F.count("*").alias("sessions"), F.count_if(done).alias("completed"), F.round(F.try_divide(F.count_if(done) * 100.0, F.count("*")), 6).alias("success_rate"),
        F.round(F.avg(of_done(F.col("seconds_"))) / 60, 6).alias("minutes"), F.round(F.avg(of_done(F.col("found").cast("double"))), 6).alias("stores"),
        F.coalesce(F.sum(of_done(F.col("found"))), F.lit(0)).alias("total_stores"),
    )


@query("""WITH s AS (SELECT *, date_diff('microsecond', created_at, lead(created_at) OVER (PARTITION BY user_id ORDER BY created_at, id)) / 1e6 AS seconds FROM crawl_log),
l AS (SELECT s.* FROM s WHERE created_at >= (SELECT max(created_at) FROM crawl_log) - INTERVAL 1 DAY)
SELECT count(*) AS sessions, count(*) FILTER (WHERE status = 'completed') AS completed, round(count(*) FILTER (WHERE status = 'completed') * 100.0 / count(*), 6)::DOUBLE AS success_rate,
  round(avg(seconds) FILTER (WHERE status = 'completed') / 60, 6) AS minutes, round(avg(found::DOUBLE) FILTER (WHERE status = 'completed'), 6) AS stores,
  coalesce(sum(found) FILTER (WHERE status = 'completed'), 0)::BIGINT AS total_stores FROM l""")
def performance_last_day(v):
    """A session lasts until the next one of its user."""
    after = F.lead("created_at").over(Window.partitionBy("user_id").orderBy("created_at", "id"))
    log = v.crawl_log.withColumn("after_", after)
    seconds = (F.unix_micros(F.col("after_").cast("timestamp")) - F.unix_micros(F.col("created_at").cast("timestamp"))) / 1e6
    return last_day(log, seconds)
