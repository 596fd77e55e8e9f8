"""Analytics over crawl logs and events: rates, windows, bursts, controllers, trends."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.columns import chain
from waymark.functions.text import cache_key, error_class, query_parameter
from waymark.operators.grid import DISTRICTS
from waymark.plans.registry import query

BLOCK_WORDS = ("blocked", "forbidden", "403", "429", "rate limit", "too many requests", "access denied", "captcha")


@query("SELECT date_trunc('hour', ts) AS hour, count(*) AS n, count(DISTINCT user_id) AS users FROM failures GROUP BY 1")
def failure_hourly(v):
    return v.failures.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


@query("SELECT event_id, regexp_extract(url, '[?&]rid=([^&#]*)', 1) AS rid, 'f:' || left(sha256(url), 16) AS cache_key FROM failures")
def failure_ids(v):
    return v.failures.select("event_id", query_parameter(F.col("url"), "rid").alias("rid"), cache_key("f", F.col("url")).alias("cache_key"))


def is_blocked(message: Column) -> Column:
    low = F.lower(message)
    return chain([(low.contains(w), F.lit(True)) for w in BLOCK_WORDS], F.lit(False))


def bursts(failures: DataFrame, key: str, most: int = 10, least: int = 5, minutes: int = 5) -> DataFrame:
    """failures with blocked: a block word, or `least` of the last `most` plain failures of the key within some minutes."""
    plain = failures.withColumn("worded", is_blocked(F.col("error_message")))
    last = Window.partitionBy(key, "worded").orderBy("ts", "event_id").rowsBetween(-(most - 1), 0)
    span = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.min(F.col("ts").cast("timestamp")).over(last))
    quick = (F.count("*").over(last) >= least) & (span < minutes * 60_000_000)
    return plain.withColumn("blocked", F.col("worded") | quick)


_WORDED = " OR ".join(f"contains(lower(error_message), '{w}')" for w in BLOCK_WORDS)
BURST_SQL = f"""WITH w AS (SELECT *, {_WORDED} AS worded FROM failures),
b AS (SELECT event_id, worded, count(*) OVER x AS n, date_diff('microsecond', min(ts) OVER x, ts) AS span FROM w
  WINDOW x AS (PARTITION BY user_id, worded ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
SELECT event_id, worded OR (n >= 5 AND span < 300000000) AS blocked FROM b"""


@query(BURST_SQL)
def burst_detect(v):
    return bursts(v.failures, "user_id").select("event_id", "blocked")


@query("""SELECT id, round(m, 6) AS memory, CASE WHEN n < 5 THEN 0 WHEN m > 1500 THEN -1 WHEN s < 80 THEN -1 WHEN m < 800 AND s > 95 AND t < 300 THEN 1 ELSE 0 END AS step FROM (
  SELECT id, count(*) OVER x AS n, avg(CAST(found AS DOUBLE) * 8) OVER x AS t, avg(CAST(found AS DOUBLE) * 25) OVER x AS m, avg(CASE WHEN status = 'completed' THEN 100.0 ELSE 0.0 END) OVER x AS s FROM crawl_log
  WINDOW x AS (PARTITION BY user_id ORDER BY created_at, id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) q""")
def worker_adjust(v):
    return worker_steps(v.crawl_log.withColumn("memory", F.col("found") * F.lit(25.0)).withColumn("seconds", F.col("found") * F.lit(8.0)))


def worker_steps(log: DataFrame, most_memory: float = 1500, least_memory: float = 800, least_success: float = 80, good_success: float = 95, most_seconds: float = 300) -> DataFrame:
    """Means of the last five measures (memory, status, seconds) of a worker decide on one worker more or less."""
    last = Window.partitionBy("user_id").orderBy("created_at", "id").rowsBetween(-4, 0)
    ok = F.when(F.col("status") == "completed", 100.0).otherwise(0.0)
    rows = log.select("id", F.count("*").over(last).alias("n"), F.avg("memory").over(last).alias("m"), F.avg(ok).over(last).alias("s"), F.avg("seconds").over(last).alias("t"))
    grow = (F.col("m") < least_memory) & (F.col("s") > good_success) & (F.col("t") < most_seconds)
    step = chain([(F.col("n") < 5, 0), (F.col("m") > most_memory, -1), (F.col("s") < least_success, -1), (grow, 1)], 0)
    return rows.select("id", F.round("m", 6).alias("memory"), step.alias("step"))


@query("""WITH h AS (SELECT DISTINCT date_trunc('hour', ts) AS h FROM failures), l AS (SELECT max(ts) AS t FROM failures)
SELECT count(*) AS failures, count(DISTINCT url) AS urls, round(count(*) FILTER (WHERE lower(error_message) LIKE '%no such element%') * 1.0 / count(*), 6) AS selector_share,
  (SELECT count(*) FROM h) AS hours FROM failures, l WHERE ts > l.t - INTERVAL 1 DAY AND ts <= l.t""")
def trailing_failures(v):
    """Failures of the last day before the latest one."""
    latest = v.failures.agg(F.max("ts").alias("t"), F.count_distinct(F.date_trunc("hour", "ts")).alias("hours"))
    last = v.failures.crossJoin(F.broadcast(latest)).where(F.col("ts") > F.col("t") - F.expr("INTERVAL 1 DAY"))
    share = F.count_if(error_class(F.col("error_message")) == "selector_missing") / F.count("*")
    return last.agg(F.count("*").alias("failures"), F.countDistinct("url").alias("urls"), F.round(share, 6).alias("selector_share"), F.max("hours").alias("hours"))


@query("""SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS day, count(*) AS total, count(*) FILTER (WHERE status = 'failed') AS failed,
  round(count(*) FILTER (WHERE status = 'completed') * 100.0 / greatest(count(*), 1), 6) AS success_rate FROM crawl_log GROUP BY 1""")
def daily_stats(v):
    done = F.count_if(F.col("status") == "completed")
    return v.crawl_log.groupBy(F.to_date("created_at").cast("string").alias("day")).agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == "failed").alias("failed"), F.round(done * 100.0 / F.greatest(F.count("*"), F.lit(1)), 6).alias("success_rate")
    )


@query("""SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS day, CASE user_id % 3 WHEN 0 THEN '강남구' WHEN 1 THEN '마포구' ELSE '서초구' END AS district,
  count(*) FILTER (WHERE status = 'completed') AS opened, count(*) FILTER (WHERE status = 'failed') AS closed FROM crawl_log GROUP BY 1, 2""")
def trend_by_day(v):
    district = chain([(F.col("user_id") % 3 == 0, F.lit("강남구")), (F.col("user_id") % 3 == 1, F.lit("마포구"))], F.lit("서초구"))
    return v.crawl_log.groupBy(F.to_date("created_at").cast("string").alias("day"), district.alias("district")).agg(
        F.count_if(F.col("status") == "completed").alias("opened"), F.count_if(F.col("status") == "failed").alias("closed")
    )


@query("""SELECT issue_type, count(*) AS n, count(*) FILTER (WHERE auto_fixed) AS fixed, greatest(0, 100 - 2 * count(*)) AS score FROM quality_issues
WHERE created_at >= TIMESTAMP '1998-01-01' AND created_at < TIMESTAMP '1998-01-08' GROUP BY issue_type""")
def daily_quality(v):
    week = v.quality_issues.where("created_at >= TIMESTAMP_NTZ '1998-01-01' AND created_at < TIMESTAMP_NTZ '1998-01-08'")
    return week.groupBy("issue_type").agg(
        F.count("*").alias("n"), F.count_if("auto_fixed").alias("fixed"), F.greatest(F.lit(0), 100 - 2 * F.count("*")).alias("score")
    )


@query("""SELECT user_id, count(*) AS sessions, count(*) FILTER (WHERE status = 'completed') AS completed, CAST(sum(found) AS BIGINT) AS found, round(avg(CAST(found AS DOUBLE)), 6) AS mean_found,
  arg_max(id, created_at) AS last_id FROM crawl_log GROUP BY user_id""")
def weekly_sessions(v):
    return v.crawl_log.groupBy("user_id").agg(
        F.count("*").alias("sessions"),
        F.count_if(F.col("status") == "completed").alias("completed"),
        F.sum("found").alias("found"),
        F.round(F.avg(F.col("found").cast("double")), 6).alias("mean_found"),
        F.max_by("id", "created_at").alias("last_id"),
    )


@query("""SELECT user_id, id, created_at AS gap_start, after AS gap_end FROM (SELECT *, lead(created_at) OVER (PARTITION BY user_id ORDER BY created_at, id) AS after FROM crawl_log) x
WHERE date_diff('second', created_at, after) > 86400""")
def inactivity_gaps(v):
    """Gaps of more than a day between a key's events."""
    after = F.lead("created_at").over(Window.partitionBy("user_id").orderBy("created_at", "id"))
    gaps = v.crawl_log.withColumn("gap_end", after).where(F.unix_seconds(F.col("gap_end").cast("timestamp")) - F.unix_seconds(F.col("created_at").cast("timestamp")) > 86400)
    return gaps.select("user_id", "id", F.col("created_at").alias("gap_start"), "gap_end")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_at, id) - row_number() OVER (PARTITION BY user_id, status ORDER BY created_at, id) AS run FROM crawl_log)
SELECT user_id, min(id) AS any_id, count(*) AS errors FROM r WHERE status = 'failed' GROUP BY user_id, run HAVING count(*) >= 3""")
def error_streaks(v):
    """Runs of at least three failures in a row."""
    every = Window.partitionBy("user_id").orderBy("created_at", "id")
    same = Window.partitionBy("user_id", "status").orderBy("created_at", "id")
    runs = v.crawl_log.withColumn("run", F.row_number().over(every) - F.row_number().over(same)).where("status = 'failed'")
    return runs.groupBy("user_id", "run").agg(F.min("id").alias("any_id"), F.count("*").alias("errors")).where("errors >= 3").drop("run")


@query("""SELECT hour(ts) AS hour, count(*) AS n, round(count(*) FILTER (WHERE event_type = 'view') * 100.0 / count(*), 6) AS hit_rate FROM events GROUP BY 1""")
def cache_hit_rate(v):
    hits = F.count_if(F.col("event_type") == "view")
    return v.events.groupBy(F.hour("ts").cast("long").alias("hour")).agg(F.count("*").alias("n"), F.round(hits * 100.0 / F.count("*"), 6).alias("hit_rate"))


def delay_after(events: list[bool], delay: float = 2.0, low: float = 0.5, high: float = 30.0, ok: int = 0, failed: int = 0) -> tuple[float, int, int]:
    """The request delay after outcomes in order: five successes shorten it, each failure in a row lengthens it more."""
    for success in events:
        if success:
            ok, failed = ok + 1, 0
            if ok >= 5:
                delay, ok = max(low, delay * 0.9), 0
        else:
            ok, failed = 0, failed + 1
            delay = min(high, delay * (1.5 + failed * 0.2))
    return delay, ok, failed


def folded(log: DataFrame, key: str, order: list[str], columns: list[Column], start: tuple, step: Callable, schema: str) -> DataFrame:
    """(key, state..., n): a state of each key after all its rows in order.

    step(state, row values as lists) gives the next state. Rows come sorted and are folded as they stream by, so no key
    is gathered; one key's rows are one sequence and stay in one task. Null keys make one state, an empty table no row.
    """
    names, width = [part.split()[0] for part in schema.split(",")], len(columns)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state, n, began = None, start, 0, False
        for batch in batches:
            out = []
            for name, part in batch.groupby("key", sort=False, dropna=False):
                name = None if pd.isna(name) else name
                if began and name != now:
                    out.append((now, *state, n))
                    state, n = start, 0
                now, n, began = name, n + len(part), True
                state = step(state, *(part[f"v{i}"].tolist() for i in range(width)))
            yield pd.DataFrame(out, columns=["key", *names, "n"])
        if began:
            yield pd.DataFrame([(now, *state, n)], columns=["key", *names, "n"])

    values = [c.alias(f"v{i}") for i, c in enumerate(columns)]
    sort = [f"o{i}" for i in range(len(order))]
    rows = log.select(F.col(key).alias("key"), *[F.col(c).alias(o) for c, o in zip(order, sort, strict=True)], *values)
    rows = rows.repartition("key").sortWithinPartitions("key", *sort)
    return rows.mapInPandas(fold, f"key long, {schema}, n long").withColumnRenamed("key", key)


def adaptive_delays(log: DataFrame, key: str, order: list[str], success: Column) -> DataFrame:
    """(key, delay, n): the final delay of each key."""

    def step(state: tuple, outcomes: list[bool]) -> tuple:
        return delay_after(outcomes, state[0], ok=state[1], failed=state[2])

    return folded(log, key, order, [success], (2.0, 0, 0), step, "delay double, ok long, failed long").drop("ok", "failed")


# each event as a struct of the state's own shape, folded in order
DELAY_SQL = """WITH o AS (SELECT user_id, list({'delay': 0.0::DOUBLE, 'ok': (event_type <> 'error')::INT, 'failed': 0} ORDER BY ts, event_id) AS l FROM events GROUP BY user_id),
f AS (SELECT user_id, len(l) AS n, list_reduce(l, lambda s, x: CASE WHEN x.ok = 1 AND s.ok = 4 THEN {'delay': greatest(0.5::DOUBLE, s.delay * 0.9::DOUBLE), 'ok': 0, 'failed': 0}
  WHEN x.ok = 1 THEN {'delay': s.delay, 'ok': s.ok + 1, 'failed': 0}
  ELSE {'delay': least(30.0::DOUBLE, s.delay * (1.5::DOUBLE + (s.failed + 1)::DOUBLE * 0.2::DOUBLE)), 'ok': 0, 'failed': s.failed + 1} END, {'delay': 2.0::DOUBLE, 'ok': 0, 'failed': 0}) AS s FROM o)
SELECT user_id, round(s.delay, 6) AS delay, n FROM f"""


@query(DELAY_SQL)
def adaptive_delay(v):
    out = adaptive_delays(v.crawl_log, "user_id", ["created_at", "id"], F.col("status") == "completed")
    return out.withColumn("delay", F.round("delay", 6))


#: Fixed values of a host's health: loss and gain of an outcome, failures that switch it off, idle seconds that switch it on.
LOSS, GAIN, OFF_AFTER, IDLE_S = 10, 5, 3, 3600


def health_after(state: tuple, outcomes: list[bool], seconds: list[float]) -> tuple:
    """(score, failures, active, last) after outcomes at times in order; an idle hour forgives a host that is off."""
    score, failures, active, last = state
    for ok, at in zip(outcomes, seconds, strict=True):
        if not active and at - last > IDLE_S:
            active, failures = True, 0
        if ok:
            score, failures = min(100, score + GAIN), max(0, failures - 1)
        else:
            score, failures = max(0, score - LOSS), failures + 1
            active = active and failures < OFF_AFTER
        last = at
    return score, failures, active, last


HEALTH_SQL = f"""o AS (SELECT user_id % 50 AS host, list({{'score': (status = 'completed')::INT, 'failures': 0, 'active': true, 'last': epoch_us(created_at)}} ORDER BY created_at, id) AS l FROM crawl_log GROUP BY 1),
f AS (SELECT host, len(l) AS n, list_reduce(l, lambda s, x: CASE WHEN x.score = 1 THEN {{'score': least(100, s.score + {GAIN}),
  'failures': CASE WHEN NOT s.active AND x.last - s.last > {IDLE_S * 1_000_000}::BIGINT THEN 0 ELSE greatest(0, s.failures - 1) END, 'active': s.active OR x.last - s.last > {IDLE_S * 1_000_000}::BIGINT, 'last': x.last}}
  WHEN NOT s.active AND x.last - s.last > {IDLE_S * 1_000_000}::BIGINT THEN {{'score': greatest(0, s.score - {LOSS}), 'failures': 1, 'active': true, 'last': x.last}}
  ELSE {{'score': greatest(0, s.score - {LOSS}), 'failures': s.failures + 1, 'active': s.active AND s.failures + 1 < {OFF_AFTER}, 'last': x.last}} END,
  {{'score': 100, 'failures': 0, 'active': true, 'last': 0::BIGINT}}) AS s FROM o)"""


@query(f"""WITH {HEALTH_SQL}
SELECT host, CAST(s.score AS BIGINT) AS score, CAST(s.failures AS BIGINT) AS failures, s.active AS active, n FROM f""")
def host_health(v):
    """Score, failures and use of each host after its whole log."""
    log = v.crawl_log.withColumn("host", F.col("user_id") % 50)
    at = F.unix_micros(F.col("created_at").cast("timestamp")) / 1e6
    out = folded(log, "host", ["created_at", "id"], [F.col("status") == "completed", at], (100, 0, True, 0.0), health_after, "score long, failures long, active boolean, last double")
    return out.drop("last")


@query("WITH d(name, tier, expected) AS (VALUES " + ", ".join(f"('{d[0]}', {d[1]}, {d[2]})" for d in DISTRICTS) + """)
SELECT CAST(t AS BIGINT) AS tier, count(name) AS districts, CAST(coalesce(sum(expected), 0) AS BIGINT) AS expected FROM (SELECT unnest(range(1, 6)) AS t) s LEFT JOIN d ON d.tier = t GROUP BY t""")
def coverage_by_tier(v):
    districts = v.spark.createDataFrame([d[:3] for d in DISTRICTS], "name string, tier long, expected long")
    tiers = v.spark.range(1, 6).withColumnRenamed("id", "tier")
    return tiers.join(districts, "tier", "left").groupBy("tier").agg(F.count("name").alias("districts"), F.coalesce(F.sum("expected"), F.lit(0)).alias("expected"))
