"""Review activity, status evidence and decisions, ordered upserts and other table changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.columns import chain, total
from waymark.functions.text import plausible_phone
from waymark.plans.durable import row_numbers, small_side
from waymark.plans.registry import query

#: Registered queries look at the world as of this date.
AS_OF = "2001-08-01"
#: Which status may follow which; closed is final.
TRANSITIONS = {"open": ("suspended", "closed"), "suspended": ("open", "closed"), "closed": ()}


def review_activity(reviews: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """(place_id, last_review, total, recent, days_since, score) of places with reviews up to a date."""
    day = F.lit(as_of).cast("date")
    at = F.to_date("created_at")
    out = reviews.where(at <= day).groupBy("place_id").agg(
        F.max(at).alias("last_review"), F.count("*").alias("total"), F.count_if(at >= F.date_sub(day, 30)).alias("recent")
    )
    days = F.date_diff(day, F.col("last_review"))
    fresh = chain([(days <= 7, 0.3), (days <= 30, 0.2), (days <= 90, 0.1)], 0.0)
    score = F.least(F.lit(0.5), F.col("recent") * 0.1) + fresh + F.least(F.lit(0.2), F.col("total") * 0.01)
    return out.withColumn("days_since", days.cast("long")).withColumn("score", F.round(F.least(F.lit(1.0), score), 6))


ACTIVITY_SQL = f"""SELECT place_id, max(CAST(created_at AS DATE)) AS last_review, count(*) AS total,
  count(*) FILTER (WHERE CAST(created_at AS DATE) >= DATE '{AS_OF}' - 30) AS recent FROM reviews WHERE CAST(created_at AS DATE) <= DATE '{AS_OF}' GROUP BY place_id"""
SCORE_SQL = f"""SELECT place_id, last_review, total, recent, CAST(date_diff('day', last_review, DATE '{AS_OF}') AS BIGINT) AS days_since,
  round(least(1.0, least(0.5, recent * 0.1) + CASE WHEN date_diff('day', last_review, DATE '{AS_OF}') <= 7 THEN 0.3 WHEN date_diff('day', last_review, DATE '{AS_OF}') <= 30 THEN 0.2
  WHEN date_diff('day', last_review, DATE '{AS_OF}') <= 90 THEN 0.1 ELSE 0.0 END + least(0.2, total * 0.01)), 6)::DOUBLE AS score FROM ({ACTIVITY_SQL}) a"""


@query(f"SELECT place_id, total, recent, days_since, score FROM ({SCORE_SQL}) s")
def place_review_activity(v):
    return review_activity(v.reviews).drop("last_review")


def status_checks(places: DataFrame, activity: DataFrame) -> DataFrame:
    """(place_id, status, confidence, strong, temporary, new_status, needs_review) from phone and review evidence."""
    joined = places.join(activity, "place_id", "left")
    has_phone, reachable = F.coalesce(F.col("phone") != "", F.lit(False)), plausible_phone(F.col("phone"))
    active = F.coalesce(F.col("score") > 0.3, F.lit(False))
    days = F.coalesce("days_since", F.lit(0))
    dead_phone = has_phone & ~reachable
    confidence = F.array_max(F.array(chain([(dead_phone, 0.7), (has_phone, 0.1)], 0.0), F.when(active, 0.1).otherwise(0.4)))
    strong = total([dead_phone.cast("int"), (~active & (days == 90)).cast("int")])
    temporary = (~active & (days == 30)).cast("int")
    decided = chain(
        [((F.col("confidence") > 0.7) & (F.col("strong") >= 2), F.lit("closed")), ((F.col("confidence") > 0.5) & ((F.col("strong") >= 1) | (F.col("temporary") >= 2)), F.lit("suspended"))],
        F.col("status"),
    )
    out = joined.select("place_id", "status", confidence.alias("confidence"), strong.alias("strong"), temporary.alias("temporary")).withColumn("new_status", decided)
    return out.withColumn("needs_review", (F.col("confidence") > 0.6) & (F.col("new_status") != F.col("status")))


CHECK_SQL = rf"""WITH a AS ({SCORE_SQL}), e AS (SELECT p.place_id, p.status, coalesce(p.phone <> '', false) AS has_phone,
  NOT (length(regexp_replace(coalesce(p.phone, ''), '[^0-9]', '', 'g')) BETWEEN 9 AND 11
    AND length(replace(regexp_replace(coalesce(p.phone, ''), '[^0-9]', '', 'g'), left(regexp_replace(coalesce(p.phone, ''), '[^0-9]', '', 'g'), 1), '')) > 0
    AND regexp_replace(coalesce(p.phone, ''), '[^0-9]', '', 'g') NOT LIKE '%1234567890%' AND regexp_replace(coalesce(p.phone, ''), '[^0-9]', '', 'g') NOT LIKE '%0987654321%') AS bad,
  coalesce(a.score > 0.3, false) AS active, coalesce(a.days_since, 0) AS days FROM places p LEFT JOIN a USING (place_id)),
c AS (SELECT place_id, status, greatest(CASE WHEN has_phone AND bad THEN 0.7 WHEN has_phone THEN 0.1 ELSE 0 END, CASE WHEN active THEN 0.1 ELSE 0.4 END) AS confidence,
  CASE WHEN has_phone AND bad THEN 1 ELSE 0 END + CASE WHEN NOT active AND days = 90 THEN 1 ELSE 0 END AS strong, CASE WHEN NOT active AND days = 30 THEN 1 ELSE 0 END AS temporary FROM e),
d AS (SELECT *, CASE WHEN confidence > 0.7 AND strong >= 2 THEN 'closed' WHEN confidence > 0.5 AND (strong >= 1 OR temporary >= 2) THEN 'suspended' ELSE status END AS new_status FROM c)"""


@query(CHECK_SQL + " SELECT place_id, status, round(confidence, 6)::DOUBLE AS confidence, CAST(strong AS BIGINT) AS strong, new_status, confidence > 0.6 AND new_status <> status AS needs_review FROM d")
def status_decision(v):
    out = status_checks(v.places, review_activity(v.reviews))
    return out.select("place_id", "status", F.round("confidence", 6).alias("confidence"), F.col("strong").cast("long").alias("strong"), "new_status", "needs_review")


def legal_changes(checks: DataFrame) -> DataFrame:
    """Checks that change a status in a way that the transition table allows."""
    spark = checks.sparkSession
    table = spark.createDataFrame([(a, b) for a, bs in TRANSITIONS.items() for b in bs], "status string, new_status string")
    return checks.join(F.broadcast(table), ["status", "new_status"], "left_semi")


def upsert(target: DataFrame, batch: DataFrame, key: str, order: str, keep_old: list[str], overwrite: list[str]) -> DataFrame:
    """target with a batch applied in order: the last non-null value wins in keep_old columns, the last value in overwrite columns."""
    latest = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"new_{c}") for c in keep_old]
    latest += [F.max_by(F.col(c), F.col(order)).alias(f"new_{c}") for c in overwrite]
    once = batch.groupBy(key).agg(*latest).withColumn("touched", F.lit(True))
    joined = target.join(once, key, "full_outer")
    columns = []
    for c in target.columns:
        if c in keep_old:
            columns.append(F.coalesce(f"new_{c}", c).alias(c))
        elif c in overwrite:
            columns.append(F.when(F.col("touched"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    return joined.select(*columns)


@query("""SELECT p.place_id, coalesce(b.address, p.address) AS address, round(coalesce(b.src_rating, p.src_rating), 6) AS src_rating, coalesce(b.status, p.status) AS status FROM places p
LEFT JOIN (SELECT place_id, arg_max(address, batch_seq) FILTER (WHERE address IS NOT NULL) AS address, arg_max(src_rating, batch_seq) FILTER (WHERE src_rating IS NOT NULL) AS src_rating,
  arg_max(status, batch_seq) AS status FROM upsert_batch GROUP BY place_id) b USING (place_id)""")
def upsert_apply(v):
    target = v.places.select("place_id", "address", "src_rating", "status")
    out = upsert(target, v.upsert_batch, "place_id", "batch_seq", ["address", "src_rating"], ["status"])
    return out.withColumn("src_rating", F.round("src_rating", 6))


def insert_ignore(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """target and those rows, once each, whose key it does not hold."""
    return target.unionByName(rows.join(target, key, "left_anti").dropDuplicates([key]))


@query("SELECT place_id, status FROM places WHERE seq % 3 = 0 UNION ALL SELECT place_id, status FROM places WHERE seq % 3 <> 0 AND seq % 2 = 0")
def insert_ignored(v):
    p = v.places.select("place_id", "status", "seq")
    return insert_ignore(p.where("seq % 3 = 0"), p.where("seq % 2 = 0"), "place_id").drop("seq")


def replace_links(links: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """links with those of the keys in fresh replaced."""
    return links.join(fresh.select(key).distinct(), key, "left_anti").unionByName(fresh)


@query("""SELECT place_id, category_id FROM place_categories WHERE CAST(place_id AS BIGINT) % 5 <> 0 UNION ALL SELECT place_id, 6 FROM places WHERE seq % 5 = 0""")
def links_replaced(v):
    fresh = v.places.where("seq % 5 = 0").select("place_id", F.lit(6).cast("long").alias("category_id"))
    return replace_links(v.place_categories, fresh, "place_id")


@query("SELECT place_id, category_id FROM place_categories b WHERE b.category_id IN (SELECT id FROM categories WHERE name NOT IN ('양식', '중식'))")
def links_without_categories(v):
    gone = v.categories.where(F.col("name").isin("양식", "중식")).select(F.col("id").alias("category_id"))
    return v.place_categories.join(small_side(gone), "category_id", "left_anti").select("place_id", "category_id")


@query(f"SELECT l_orderkey, l_linenumber, issue_type FROM quality_issues WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 400 DAY")
def retention_kept(v):
    """Issues younger than the retention; the rest would not be written again."""
    floor = F.to_timestamp_ntz(F.lit(f"{AS_OF} 00:00:00")) - F.expr("INTERVAL 400 DAYS")
    return v.quality_issues.where(F.col("created_at") >= floor).select("l_orderkey", "l_linenumber", "issue_type")


@query("SELECT user_id, arg_max(status, id) AS status, max(id) AS id FROM crawl_log GROUP BY user_id")
def session_state(v):
    """Latest event of each session key."""
    return v.crawl_log.groupBy("user_id").agg(F.max_by("status", "id").alias("status"), F.max("id").alias("id"))


@query("SELECT name, CAST(dense_rank() OVER (ORDER BY name) AS BIGINT) AS id FROM (SELECT DISTINCT refill_type AS name FROM places) x")
def category_ids(v):
    """Ids for a small dimension, by name."""
    names = v.places.select(F.col("refill_type").alias("name")).distinct()
    return row_numbers(names, [F.col("name").asc()], "id")
