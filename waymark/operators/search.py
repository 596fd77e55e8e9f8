"""Spatial and filtered search over places."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.geo import haversine_m, near_box, sql_distance
from waymark.plans.durable import small_side
from waymark.plans.registry import query

#: Where the registered searches look, and how far in metres.
CENTRE, RADIUS = (37.55, 126.95), 5000.0


def with_distance(places: DataFrame, at: tuple[float, float], radius_m: float, name: str = "distance") -> DataFrame:
    """Places within a radius and their distance in metres. The box is filtered at the scan, the circle after it."""
    boxed = places.where(near_box(F.col("lat"), F.col("lng"), at, radius_m))
    return boxed.withColumn(name, haversine_m(F.col("lat"), F.col("lng"), F.lit(at[0]), F.lit(at[1]))).where(F.col(name) <= radius_m)


def within_radius(places: DataFrame, at: tuple[float, float], radius_m: float, status: str = "open") -> DataFrame:
    """Open places within a radius, nearest first."""
    found = with_distance(places.where(F.col("status") == status), at, radius_m)
    return found.orderBy("distance", "place_id")


def filter_places(
    places: DataFrame, bridge: DataFrame, categories: DataFrame, at: tuple[float, float], max_distance: float,
    min_rating: float | None = None, wanted: list[str] | None = None,
) -> DataFrame:
    """within_radius with an optional rating floor (best of three) and optional categories (semi-join)."""
    found = within_radius(places, at, max_distance)
    if min_rating is not None:
        found = found.where(F.greatest("naver_rating", "kakao_rating", "src_rating") >= min_rating)
    if wanted is not None:
        named = categories.where(F.col("name").isin(wanted)).select(F.col("id").alias("category_id"))
        found = found.join(bridge.join(small_side(named), "category_id"), "place_id", "left_semi")
    return found.orderBy("distance", "place_id")


def nearby(places: DataFrame, at: tuple[float, float], radius_km: int = 5) -> DataFrame:
    """Places of any status within kilometres, distance rounded to metres."""
    found = with_distance(places, at, radius_km * 1000.0).withColumn("distance_km", F.round(F.col("distance") / 1000, 3))
    return found.select("place_id", "name", "distance_km", "refill_type", "is_confirmed").orderBy("distance_km", "place_id")


def search(places: DataFrame, text: str | None = None, min_rating: float | None = None, status: list[str] | None = None, confirmed: bool | None = None) -> Column:
    """The conjunction of the filters that are given."""
    parts: list[Column] = []
    if text:
        parts.append(F.col("name").ilike(f"%{text}%") | F.col("address").ilike(f"%{text}%"))
    if min_rating:
        parts.append(F.col("src_rating") >= min_rating)
    if status:
        parts.append(F.col("status").isin(status))
    if confirmed is not None:
        parts.append(F.col("is_confirmed") == confirmed)
    return reduce(lambda a, b: a & b, parts, F.lit(True))


DISTANCE = sql_distance("37.55", "126.95", "lat", "lng")


@query(f"SELECT place_id, name, status, round({DISTANCE}, 6) AS distance FROM places WHERE status = 'open' AND {DISTANCE} <= 5000")
def places_within_radius(v):
    found = within_radius(v.places, CENTRE, RADIUS)
    return found.select("place_id", "name", "status", F.round("distance", 6).alias("distance"))


@query(f"""
SELECT place_id, name, round({DISTANCE}, 6) AS distance FROM places p
WHERE status = 'open' AND {DISTANCE} <= 8000 AND greatest(naver_rating, kakao_rating, src_rating) >= 3.0
  AND EXISTS (SELECT 1 FROM place_categories b JOIN categories c ON b.category_id = c.id WHERE b.place_id = p.place_id AND c.name IN ('고기', '한식'))""")
def places_filter(v):
    found = filter_places(v.places, v.place_categories, v.categories, CENTRE, 8000.0, 3.0, ["고기", "한식"])
    return found.select("place_id", "name", F.round("distance", 6).alias("distance"))


@query(f"SELECT place_id, name, round({DISTANCE} / 1000, 3) AS distance_km, refill_type, is_confirmed FROM places WHERE {DISTANCE} <= 3000")
def nearby_km(v):
    return nearby(v.places, CENTRE, 3)


@query(f"""
SELECT place_id, name, address, round({DISTANCE}, 6) AS distance FROM places
WHERE {DISTANCE} <= 20000 AND (name ILIKE '%store 1%' OR address ILIKE '%강남%') AND src_rating >= 2.5 AND status IN ('open', 'suspended')
ORDER BY distance, place_id LIMIT 50""")
def search_dynamic_filters(v):
    chosen = search(v.places, "store 1", 2.5, ["open", "suspended"]) | (search(v.places, "강남", 2.5, ["open", "suspended"]))
    found = with_distance(v.places.where(chosen), CENTRE, 20_000.0).withColumn("distance", F.round("distance", 6))
    return found.select("place_id", "name", "address", "distance").orderBy("distance", "place_id").limit(50)


@query("SELECT place_id, name, address FROM places WHERE name ILIKE '%store 29%'")
def search_by_name(v):
    return v.places.where(F.col("name").ilike("%store 29%")).select("place_id", "name", "address")


FULLTEXT_TERMS = ["the", "and"]


#: What a word is made of.
WORD = "[\\p{L}\\p{N}]"


def fulltext(docs: DataFrame, terms: list[str], key: str = "doc_id", text: str = "text", most: int | None = None) -> DataFrame:
    """Rows that hold every term as a word, and their rank: occurrences of the terms per logarithm of the number of words.

    Texts are first searched for the terms as plain strings, and only those that hold all of them are looked through for
    words, which are counted where they stand and never gathered. most: only so many, best first (ties: smaller key).
    """
    low = F.lower(text)
    held = docs.select(key, low.alias("low_")).where(reduce(lambda a, b: a & b, [F.col("low_").contains(t) for t in terms]))
    hits = [F.col(f"tf{i}") for i in range(len(terms))]
    found = [F.regexp_count("low_", F.lit(f"(?<!{WORD})\\Q{t}\\E(?!{WORD})")).alias(f"tf{i}") for i, t in enumerate(terms)]
    counted = held.select(key, "low_", *found).where(reduce(lambda a, b: a & b, [h > 0 for h in hits]))
    counted = counted.withColumn("n", F.regexp_count("low_", F.lit(f"{WORD}+")))
    rank = reduce(lambda a, b: a + b, hits) / (1 + F.log(F.greatest(F.col("n"), F.lit(1)).cast("double")))
    out = counted.select(key, F.col("n").cast("long").alias("n_words"), F.round(rank, 6).alias("rank"))
    return out if most is None else out.orderBy(F.desc("rank"), key).limit(most)


@query(r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws FROM documents),
c AS (SELECT doc_id, len(ws) AS n, len(list_filter(ws, lambda x: x = 'the')) AS a, len(list_filter(ws, lambda x: x = 'and')) AS b FROM w)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, round((a + b) / (1 + ln(greatest(n, 1))), 6) AS rank FROM c WHERE a > 0 AND b > 0""")
def fulltext_rank(v):
    return fulltext(v.documents, FULLTEXT_TERMS)
