"""Run, session and enhancement reports, links and sets, score cards, change logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.columns import chain, count_where
from waymark.functions.price import parse_price
from waymark.operators.grid import DISTRICTS
from waymark.plans.durable import small_side
from waymark.plans.registry import query

#: Steps of each score (least value, score), lowest score last, and the weights of the total.
INSERT_STEPS = ((1000, 100), (500, 80), (100, 60))
HIT_STEPS = ((80, 100), (60, 80), (40, 60), (20, 40))
CORE_STEPS = ((8, 100), (4, 80), (2, 60))
SHARES = (0.4, 0.3, 0.3)
#: Defaults that settings fall back on.
DEFAULTS = {"AUTOMOBILE": "car", "BUILDING": "house", "OTHER": "none"}
#: Korean numbering plan: area and mobile prefixes with the digits that may follow (a documented subset).
NUMBERING = "^(02[0-9]{7,8}|0(3[1-3]|4[1-4]|5[1-5]|6[1-4])[0-9]{7,8}|01[016789][0-9]{7,8}|070[0-9]{8}|050[0-9]{8,9}|1[568][0-9]{6})$"


#: The week's plan, day by day, and its priorities.
SCHEDULE = (
    ("monday", "highest", ("강남구", "마포구", "서초구")),
    ("tuesday", "high", ("송파구", "영등포구", "용산구")),
    ("wednesday", "high", ("성동구", "광진구")),
    ("thursday", "medium", ("관악구", "서대문구", "종로구", "중구")),
    ("friday", "medium", ("성북구", "동대문구")),
    ("saturday", "low", ("노원구", "강북구", "은평구", "강서구", "양천구")),
    ("sunday", "low", ("구로구", "금천구", "동작구", "강동구", "중랑구", "도봉구")),
)


def graded(value: Column, steps: tuple, lowest: int) -> Column:
    return chain([(value >= least, F.lit(score)) for least, score in steps], F.lit(lowest))


def _graded(value: str, steps: tuple, lowest: int) -> str:
    return "CASE " + " ".join(f"WHEN {value} >= {least} THEN {score}" for least, score in steps) + f" ELSE {lowest} END"


@query(f"""WITH m AS (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE status = 'completed') * 100.0 / count(*) AS hit, user_id % 10 AS cores FROM crawl_log GROUP BY user_id),
s AS (SELECT user_id, {_graded('n', INSERT_STEPS, 40)} AS insert_score, {_graded('hit', HIT_STEPS, 20)} AS hit_score, {_graded('cores', CORE_STEPS, 40)} AS core_score FROM m)
SELECT *, CAST(floor((insert_score * 4 + hit_score * 3 + core_score * 3) / 10.0) AS BIGINT) AS total FROM s""")
def score_cards(v):
    """Three graded measures of each worker and their weighted total, rounded down."""
    hit = F.count_if(F.col("status") == "completed") * 100.0 / F.count("*")
    m = v.crawl_log.groupBy("user_id").agg(F.count("*").alias("n"), hit.alias("hit"))
    m = m.select("user_id", graded(F.col("n"), INSERT_STEPS, 40).alias("insert_score"), graded(F.col("hit"), HIT_STEPS, 20).alias("hit_score"), graded(F.col("user_id") % 10, CORE_STEPS, 40).alias("core_score"))
    parts = sum(round(10 * w) * F.col(c) for w, c in zip(SHARES, ("insert_score", "hit_score", "core_score"), strict=True))
    return m.withColumn("total", F.floor(parts / 10.0))


@query("""SELECT count(*) AS tasks, count(*) FILTER (WHERE status = 'completed') AS completed, count(*) FILTER (WHERE status = 'failed') AS failed, round(count(*) FILTER (WHERE status = 'completed') * 100.0 / count(*), 6) AS success_rate,
  CAST(sum(found) AS BIGINT) AS found, round(sum(found) / (date_diff('second', min(created_at), max(created_at)) / 3600.0), 4) AS per_hour,
  round(sum(found) * 1.0 / count(DISTINCT user_id), 6) AS per_district FROM crawl_log""")
def run_summary(v):
    """One row about a whole run: rates per hour and per district."""
    hours = F.timestamp_diff("SECOND", F.min("created_at"), F.max("created_at")) / 3600.0
    return v.crawl_log.agg(
        F.count("*").alias("tasks"), F.count_if(F.col("status") == "completed").alias("completed"), F.count_if(F.col("status") == "failed").alias("failed"),
        F.round(F.count_if(F.col("status") == "completed") * 100.0 / F.count("*"), 6).alias("success_rate"), F.sum("found").alias("found"),
        F.round(F.sum("found") / hours, 4).alias("per_hour"), F.round(F.sum("found") * 1.0 / F.count_distinct("user_id"), 6).alias("per_district"),
    )


@query("""SELECT count(*) AS total, round(count(lat) * 100.0 / count(*), 6) AS geocoding_rate,
  round((SELECT count(*) FROM places p JOIN price_text t ON p.seq = t.id WHERE regexp_matches(t.price_text, '[0-9]')) * 100.0 / count(*), 6) AS price_rate,
  round((SELECT count(DISTINCT place_id) FROM place_categories) * 100.0 / count(*), 6) AS category_rate,
  round((count(*) - (SELECT count(*) FROM (SELECT DISTINCT name, address FROM places) d)) * 100.0 / count(*), 6) AS duplicate_rate FROM places""")
def enhancement_rates(v):
    """Shares of places with coordinates, with a readable price, with a category, and of exact duplicates."""
    priced = v.price_text.select(F.col("id").alias("seq"), parse_price(F.col("price_text")).alias("p")).select("seq", (F.col("p.min_price") > 0).alias("priced"))
    linked = v.place_categories.select("place_id").distinct().withColumn("linked", F.lit(True))
    rows = v.places.join(priced, "seq", "left").join(linked, "place_id", "left")
    by_place = rows.groupBy("name", "address").agg(F.count("*").alias("n"), F.count("lat").alias("located"), count_where(F.col("priced")).alias("priced"), F.count("linked").alias("linked"))
    t = F.sum("n")
    return by_place.agg(
        t.alias("total"), F.round(F.sum("located") * 100.0 / t, 6).alias("geocoding_rate"), F.round(F.sum("priced") * 100.0 / t, 6).alias("price_rate"),
        F.round(F.sum("linked") * 100.0 / t, 6).alias("category_rate"), F.round(F.sum(F.col("n") - 1) * 100.0 / t, 6).alias("duplicate_rate"),
    )


@query("""WITH s AS (SELECT d, unnest(d2) AS district FROM (SELECT '월' AS d, ['강남구', '마포구'] AS d2 UNION ALL SELECT '화', ['서초구', '강북구', '송파구']) x)
SELECT s.d AS day, count(DISTINCT s.district) AS districts, count(p.seq) AS stores, round(count(p.seq) * 1.0 / count(DISTINCT s.district), 6) AS mean FROM s LEFT JOIN places p ON split_part(p.address, ' ', 2) = s.district GROUP BY s.d""")
def weekly_totals(v):
    """Places of the districts that each day of the plan covers."""
    plan = v.spark.createDataFrame([("월", "강남구"), ("월", "마포구"), ("화", "서초구"), ("화", "강북구"), ("화", "송파구")], "day string, district string")
    counts = v.places.groupBy(F.split_part("address", F.lit(" "), F.lit(2)).alias("district")).agg(F.count("*").alias("n"))
    one = plan.join(counts, "district", "left").groupBy("day").agg(F.count("*").alias("districts"), F.coalesce(F.sum("n"), F.lit(0)).alias("stores"))
    return one.withColumn("mean", F.round(F.col("stores") * 1.0 / F.col("districts"), 6))


def planned(spark) -> DataFrame:
    """(day, priority, district, place, expected): a row for each of the 25 districts of the plan."""
    expected = {d[0]: d[2] for d in DISTRICTS}
    order = {d[0]: i for i, d in enumerate(DISTRICTS)}
    rows = [(day, priority, d, order[d], expected[d]) for day, priority, ds in SCHEDULE for d in ds]
    return spark.createDataFrame(rows, "day string, priority string, district string, place long, expected long")


_PLAN = ", ".join(f"('{day}', '{priority}', '{d}', {[x[0] for x in DISTRICTS].index(d)}, {next(x[2] for x in DISTRICTS if x[0] == d)})" for day, priority, ds in SCHEDULE for d in ds)


@query(f"""WITH s(day, priority, district, place, expected) AS (VALUES {_PLAN}), c AS (SELECT split_part(address, ' ', 2) AS district, count(*) AS n FROM places GROUP BY 1)
SELECT day, count(*) AS districts, CAST(sum(expected) AS BIGINT) AS expected, round(sum(expected) * 1.0 / count(*), 6)::DOUBLE AS mean, CAST(coalesce(sum(n), 0) AS BIGINT) AS stores, round(coalesce(sum(n), 0) * 100.0 / sum(expected), 6)::DOUBLE AS covered FROM s LEFT JOIN c USING (district) GROUP BY day""")
def weekly_plan(v):
    """Districts, expected places, their mean and the places that there are, for each day of the plan."""
    counts = v.places.groupBy(F.split_part("address", F.lit(" "), F.lit(2)).alias("district")).agg(F.count("*").alias("n"))
    rows = planned(v.spark).join(counts, "district", "left").groupBy("day").agg(F.count("*").alias("districts"), F.sum("expected").alias("expected"), F.coalesce(F.sum("n"), F.lit(0)).alias("stores"))
    mean, covered = F.round(F.col("expected") / F.col("districts"), 6), F.round(F.col("stores") * 100.0 / F.col("expected"), 6)
    return rows.select("day", "districts", "expected", mean.alias("mean"), "stores", covered.alias("covered"))


@query(f"""WITH s(day, priority, district, place, expected) AS (VALUES {_PLAN}), l AS (SELECT user_id % 40 AS place, arg_max(status, id) AS status FROM crawl_log GROUP BY 1)
SELECT district, priority, coalesce(status, 'waiting') AS status FROM s LEFT JOIN l USING (place) WHERE priority IN ('highest', 'high', 'medium') AND coalesce(status, 'waiting') IN ('waiting', 'running', 'failed')""")
def due_districts(v):
    """Districts of some priorities whose last session is not complete, or that had none."""
    last = v.crawl_log.groupBy((F.col("user_id") % 40).alias("place")).agg(F.max_by("status", "id").alias("status"))
    rows = planned(v.spark).join(last, "place", "left").withColumn("status", F.coalesce("status", F.lit("waiting")))
    return rows.where(F.col("priority").isin("highest", "high", "medium") & F.col("status").isin("waiting", "running", "failed")).select("district", "priority", "status")


@query("SELECT id, status, found FROM crawl_log ORDER BY created_at DESC, id DESC LIMIT 5")
def recent_sessions(v):
    """The five latest sessions: a top-k."""
    return v.crawl_log.orderBy(F.desc("created_at"), F.desc("id")).limit(5).select("id", "status", "found")


@query("SELECT user_id AS district, min(status) AS first_status FROM crawl_log WHERE status IN ('failed', 'running') GROUP BY user_id")
def incomplete_districts(v):
    """Districts with work that is not complete."""
    return v.crawl_log.where(F.col("status").isin("failed", "running")).groupBy(F.col("user_id").alias("district")).agg(F.min("status").alias("first_status"))


@query("SELECT p.place_id, c.id AS category_id FROM places p, categories c WHERE c.name = '고기' AND p.name = 'Store 1'")
def literal_links(v):
    """Links of the places of one name with the categories of one name."""
    one = v.categories.where("name = '고기'").select(F.col("id").alias("category_id"))
    return v.places.where("name = 'Store 1'").select("place_id").crossJoin(small_side(one))


@query("SELECT DISTINCT tag FROM (SELECT unnest(string_split(raw, ' ')) AS tag FROM raw_categories) x WHERE tag <> ''")
def distinct_tags(v):
    """Every tag once."""
    return v.raw_categories.select(F.explode(F.split("raw", " ")).alias("tag")).where("tag <> ''").distinct()


@query("""SELECT DISTINCT word FROM (SELECT raw AS word FROM raw_categories WHERE raw <> '' UNION ALL SELECT name FROM categories) x""")
def category_union(v):
    """Raw and known categories as one set."""
    return v.raw_categories.where("raw <> ''").select(F.col("raw").alias("word")).unionByName(v.categories.select(F.col("name").alias("word"))).distinct()


@query("""WITH own AS (SELECT refill_type AS k, concat('n', count(*)) AS value FROM places GROUP BY refill_type), d(k, value) AS (VALUES """
       + ", ".join(f"('{k}', '{x}')" for k, x in DEFAULTS.items()) + """)
SELECT k, value FROM own UNION ALL SELECT k, value FROM d WHERE k NOT IN (SELECT k FROM own)""")
def merged_settings(v):
    """Own values, and defaults where a key has none."""
    own = v.places.groupBy(F.col("refill_type").alias("k")).agg(F.concat(F.lit("n"), F.count("*").cast("string")).alias("value"))
    defaults = v.spark.createDataFrame(list(DEFAULTS.items()), "k string, value string")
    return own.unionByName(defaults.join(own.select("k"), "k", "left_anti"))


@query("SELECT name, seq, address FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY seq) AS r FROM places) q WHERE r = 1")
def first_by_name(v):
    """The first place of each name, by an aggregate rather than a sort of each name's rows."""
    return v.places.groupBy("name").agg(F.min("seq").alias("seq"), F.min_by("address", "seq").alias("address"))


@query("""WITH g AS (SELECT name, address, min(seq) AS first FROM places GROUP BY name, address HAVING count(*) > 1)
SELECT p.place_id, 'duplicate' AS issue_type, 'medium' AS severity, g.first AS primary_seq FROM places p JOIN g ON p.name = g.name AND p.address = g.address WHERE p.seq <> g.first""")
def duplicate_issues(v):
    """An issue for each copy of a place but the first."""
    firsts = v.places.groupBy("name", "address").agg(F.min("seq").alias("primary_seq"), F.count("*").alias("n")).where("n > 1").drop("n")
    copies = v.places.join(firsts, ["name", "address"]).where(F.col("seq") != F.col("primary_seq"))
    return copies.select("place_id", F.lit("duplicate").alias("issue_type"), F.lit("medium").alias("severity"), "primary_seq")


@query("""SELECT b.place_id, p.status AS old_status, b.status AS new_status, max(b.batch_seq) AS batch_seq FROM upsert_batch b JOIN places p ON p.place_id = b.place_id WHERE b.status <> p.status GROUP BY 1, 2, 3""")
def change_log(v):
    """Changes of status that a batch brings, one row each, to be appended to a log."""
    old = v.places.select("place_id", F.col("status").alias("old_status"))
    changed = v.upsert_batch.select("place_id", F.col("status").alias("new_status"), "batch_seq").join(old, "place_id").where("old_status <> new_status")
    return changed.groupBy("place_id", "old_status", "new_status").agg(F.max("batch_seq").alias("batch_seq"))


@query(f"""SELECT place_id, regexp_matches(regexp_replace(coalesce(phone, ''), '[^0-9]', '', 'g'), '{NUMBERING}') AS valid FROM places""")
def phone_plan(v):
    """Whether a number fits the numbering plan."""
    return v.places.select("place_id", F.regexp_replace(F.coalesce("phone", F.lit("")), "[^0-9]", "").rlike(NUMBERING).alias("valid"))


@query("""SELECT seq, name, lng AS geom_x, lat AS geom_y FROM places WHERE lat IS NOT NULL ORDER BY seq LIMIT 20""")
def migration_preview(v):
    """A dry run: the first twenty rows as they would be written, with the derived point and without the dropped columns."""
    derived = v.places.where("lat IS NOT NULL").withColumn("geom_x", F.col("lng")).withColumn("geom_y", F.col("lat"))
    kept = derived.drop("address", "nation_id", "naver_rating", "kakao_rating", "src_rating", "status", "phone", "refill_type", "is_confirmed", "place_id", "lat", "lng")
    return kept.orderBy("seq").limit(20)
