"""Migration of places to target schemas, and category mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.category import EXACT, KEYWORDS, NO_CATEGORY, REFILL, map_exact, map_many, map_refill
from waymark.functions.columns import blank_to_null
from waymark.functions.geo import within
from waymark.plans.registry import query

#: The city's box, and the city hall, which stands in for missing places.
SEOUL, CITY_HALL = (37.4, 37.7, 126.8, 127.2), (37.5665, 126.978)


def split_rejects(rows: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with reason): reason is null for rows that pass."""
    judged = rows.withColumn("reason", reason)
    return judged.where("reason IS NULL").drop("reason"), judged.where("reason IS NOT NULL")


def reject_reason(strict: bool) -> Column:
    """Why a place cannot move: no coordinates, and if strict no name or address, or outside the city."""
    missing = F.coalesce(F.col("lat"), F.lit(0.0)).eqNullSafe(0.0) | F.coalesce(F.col("lng"), F.lit(0.0)).eqNullSafe(0.0)
    reason = F.when(missing, F.lit("no coordinates"))
    if strict:
        empty = F.coalesce(F.trim("name"), F.lit("")).eqNullSafe("") | F.coalesce(F.trim("address"), F.lit("")).eqNullSafe("")
        reason = F.when(empty, F.lit("no name or address")).when(missing, F.lit("no coordinates"))
        reason = reason.when(~within(F.col("lat"), F.col("lng"), SEOUL), F.lit("outside the city"))
    return reason


def description(parts: list[Column]) -> Column:
    """Parts that are not blank, joined, 500 characters at most."""
    return F.left(F.concat_ws(" | ", *map(blank_to_null, parts)), F.lit(500))


@query("""SELECT place_id, name, round(lat, 6) AS position_lat, round(lng, 6) AS position_lng, round(lng, 6) AS position_x, round(lat, 6) AS position_y, coalesce(address, '') AS address
FROM places WHERE lat <> 0 AND lng <> 0""")
def migrate_v1(v):
    kept, _ = split_rejects(v.places, reject_reason(False))
    lat, lng = F.round("lat", 6), F.round("lng", 6)
    return kept.select("place_id", "name", lat.alias("position_lat"), lng.alias("position_lng"), lng.alias("position_x"), lat.alias("position_y"), F.coalesce("address", F.lit("")).alias("address"))


@query("""SELECT place_id, trim(name) AS name, round(lat, 6) AS position_lat, round(lng, 6) AS position_lng, left(concat_ws(' | ', nullif(trim(refill_type), '') || ' 전문점', nullif(trim(status), '')), 500) AS description
FROM places WHERE trim(name) <> '' AND trim(address) <> '' AND lat BETWEEN 37.4 AND 37.7 AND lng BETWEEN 126.8 AND 127.2""")
def migrate_v2(v):
    kept, _ = split_rejects(v.places, reject_reason(True))
    told = description([F.concat("refill_type", F.lit(" 전문점")), F.col("status")])
    return kept.select("place_id", F.trim("name").alias("name"), F.round("lat", 6).alias("position_lat"), F.round("lng", 6).alias("position_lng"), told.alias("description"))


def safe_coordinate(value: Column, default: Column) -> Column:
    """The coordinate if it lies in either range of the city, else the default."""
    return F.when(value.between(SEOUL[0], SEOUL[1]) | value.between(SEOUL[2], SEOUL[3]), value).otherwise(default)


@query("""SELECT place_id, coalesce(nullif(trim(name), ''), '무한리필 가게') AS name, coalesce(nullif(trim(address), ''), '주소 정보 없음') AS address,
  round(CASE WHEN lat BETWEEN 37.4 AND 37.7 OR lat BETWEEN 126.8 AND 127.2 THEN lat ELSE 37.5665 END, 6) AS position_lat,
  round(CASE WHEN lng BETWEEN 37.4 AND 37.7 OR lng BETWEEN 126.8 AND 127.2 THEN lng ELSE 126.978 END, 6) AS position_lng FROM places""")
def migrate_v3(v):
    return v.places.select(
        "place_id",
        F.coalesce(blank_to_null(F.trim("name")), F.lit("무한리필 가게")).alias("name"),
        F.coalesce(blank_to_null(F.trim("address")), F.lit("주소 정보 없음")).alias("address"),
        F.round(safe_coordinate(F.col("lat"), F.lit(CITY_HALL[0])), 6).alias("position_lat"),
        F.round(safe_coordinate(F.col("lng"), F.lit(CITY_HALL[1])), 6).alias("position_lng"),
    )


@query("""SELECT place_id, CASE WHEN lat IS NULL OR lng IS NULL THEN 'no coordinates' ELSE 'outside the city' END AS reason FROM places
WHERE lat IS NULL OR lng IS NULL OR NOT (lat BETWEEN 37.4 AND 37.7 AND lng BETWEEN 126.8 AND 127.2)""")
def migrate_rejects(v):
    _, lost = split_rejects(v.places, reject_reason(True))
    return lost.select("place_id", "reason")


def _values(pairs: list[tuple[str, str]]) -> str:
    return ", ".join(f"('{k}', '{c}', {i})" for i, (k, c) in enumerate(pairs))


PAIRS_MANY = [(k, c) for c, ks in KEYWORDS.items() for k in ks]
PAIRS_EXACT = [(k, c) for c, ks in EXACT.items() for k in ks]


@query(f"""WITH d(k, c, o) AS (VALUES {_values(PAIRS_MANY)}),
r AS (SELECT place_id, lower(trim(replace(raw, '#', ''))) AS t FROM raw_categories),
m AS (SELECT place_id, string_agg(DISTINCT c, ',' ORDER BY c) AS cs FROM r JOIN d ON contains(t, k) WHERE NOT regexp_matches(t, '{NO_CATEGORY}') GROUP BY place_id)
SELECT place_id, coalesce(cs, '한식') AS categories FROM r LEFT JOIN m USING (place_id)""")
def category_map_v1(v):
    return v.raw_categories.select("place_id", F.array_join(map_many(F.array("raw")), ",").alias("categories"))


def _first_sql(pairs: list[tuple[str, str]], default: str, text: str = "raw") -> str:
    return f"""d(k, c, o) AS (VALUES {_values(pairs)}),
f AS (SELECT place_id, coalesce(max(c) FILTER (WHERE k = {text}), arg_min(c, o)) AS c FROM raw_categories JOIN d ON {text} <> '' AND (contains({text}, k) OR contains(k, {text})) GROUP BY place_id),
s AS (SELECT place_id, raw, coalesce(c, '{default}') AS c FROM raw_categories LEFT JOIN f USING (place_id))"""


@query(f"WITH {_first_sql(PAIRS_EXACT, '한식')} SELECT place_id, c AS categories FROM s")
def category_map_v2(v):
    return v.raw_categories.select("place_id", F.array_join(map_exact(F.array("raw")), ",").alias("categories"))


@query(f"""WITH {_first_sql(list(REFILL), '무한리필')} SELECT place_id, CASE WHEN (contains(raw, '무한') OR contains(raw, '리필')) AND c <> '무한리필'
  THEN least(c, '무한리필') || ',' || greatest(c, '무한리필') ELSE c END AS categories FROM s""")
def category_map_v3(v):
    return v.raw_categories.select("place_id", F.array_join(map_refill(F.array("raw")), ",").alias("categories"))


@query(f"""WITH d(k, c, o) AS (VALUES {_values(PAIRS_MANY)}), r AS (SELECT place_id, lower(trim(replace(raw, '#', ''))) AS t FROM raw_categories),
m AS (SELECT DISTINCT place_id, c FROM r JOIN d ON contains(t, k) WHERE NOT regexp_matches(t, '{NO_CATEGORY}')),
a AS (SELECT place_id, coalesce(c, '한식') AS c FROM r LEFT JOIN m USING (place_id))
SELECT g.name AS category, count(a.place_id) AS n FROM categories g LEFT JOIN a ON a.c = g.name GROUP BY g.name""")
def category_distribution(v):
    """Places per standard category of a mapping run, zeros kept."""
    mapped = v.raw_categories.select("place_id", F.explode(map_many(F.array("raw"))).alias("category")).groupBy("category").agg(F.count("*").alias("n"))
    return v.categories.select(F.col("name").alias("category")).join(mapped, "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("n"))
