"""The enhancing run: positions, prices and categories for every place, then copies merged; counters gathered while it writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from waymark.functions.category import NO_CATEGORY, map_many
from waymark.functions.columns import present
from waymark.functions.price import parse_price
from waymark.operators.addresses import CASCADE_SQL, geocode
from waymark.operators.entity import GROUPS_SQL, duplicate_groups, golden_records
from waymark.operators.migrate import PAIRS_MANY
from waymark.operators.quality import PRICE_SQL
from waymark.plans.durable import small_side, written
from waymark.plans.registry import query


def enhance(places: DataFrame, prices: DataFrame, categories: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Places with position, price and categories, one of each group of copies; and the counters of the run.

    places: seq, place_id, name, address, phone, lat, lng; prices: seq, price_text; categories: seq, raw (an array). The
    counters are observed as the rows are written (at the top of the plan, where a task that is run again counts once),
    so nothing is read again for them: total, located, priced (a price text, readable or not), mapped (raw
    categories), final, and removed copies.
    """
    found = geocode(places.select("seq", "address", "lat", "lng")).select("seq", F.col("lat").alias("y"), F.col("lng").alias("x"), "source")
    price = parse_price(F.col("price_text"))
    rows = places.join(small_side(written(found)), "seq").join(prices, "seq", "left").join(categories, "seq", "left")
    rows = rows.select(
        "seq", "place_id", "name", "address", "phone", F.col("y").alias("lat"), F.col("x").alias("lng"), F.when(F.col("y").isNotNull(), F.col("source")).alias("source"),
        F.when(present(F.col("price_text")), price).alias("price"), F.when(F.size("raw") > 0, map_many(F.col("raw"))).alias("categories"),
    )
    seen, kept = Observation("enhanced"), Observation("merged")
    rows = written(rows.observe(
        seen, F.count("*").alias("total"), F.count("lat").alias("located"), F.count("price").alias("priced"), F.count("categories").alias("mapped")
    ))
    groups = written(duplicate_groups(rows))
    merged = golden_records(rows, groups).select("seed", "place_id", "name", "address", "lat", "lng", "phone", "merged")
    chosen = merged.join(rows.select("place_id", "source", "price", "categories"), "place_id")
    alone = rows.join(groups.select(F.col("member").alias("seq")), "seq", "left_anti").withColumn("merged", F.lit(1).cast("long"))
    columns = ["place_id", "name", "address", "lat", "lng", "phone", "merged", "source", "price", "categories"]
    out = written(alone.select(*columns).unionByName(chosen.select(*columns)).observe(kept, F.count("*").alias("final")))
    counters = {**seen.get, **kept.get}
    return out, counters | {"removed": counters["total"] - counters["final"]}


def _run(v) -> tuple[DataFrame, dict[str, int]]:
    places = v.rough_places.join(v.places.select("seq", "place_id", "name", "phone"), "seq")
    raw = v.raw_categories.select(F.col("place_id").cast("long").alias("seq"), F.when(F.col("raw") != "", F.array("raw")).alias("raw"))
    return enhance(places, v.price_text.select(F.col("id").alias("seq"), "price_text"), raw)


ENHANCED_SQL = f"""loc AS (WITH {CASCADE_SQL} SELECT seq, lat, lng, 'given' AS source FROM o WHERE own UNION ALL SELECT seq, lat, lng, 'lookup' FROM l WHERE lat IS NOT NULL
  UNION ALL SELECT l.seq, b.lat, b.lng, CASE WHEN b.seq IS NOT NULL THEN 'estimated' END FROM l LEFT JOIN b ON b.seq = l.seq AND b.r = 1 WHERE l.lat IS NULL),
amounts AS (WITH {PRICE_SQL} SELECT id AS seq, price_type FROM parsed),
cats AS (WITH d(k, c) AS (VALUES {", ".join(f"('{k}', '{c}')" for k, c in PAIRS_MANY)}), r AS (SELECT place_id, lower(trim(replace(raw, '#', ''))) AS t FROM raw_categories WHERE raw <> ''),
  m AS (SELECT place_id, string_agg(DISTINCT c, ',' ORDER BY c) AS cs FROM r JOIN d ON contains(t, k) WHERE NOT regexp_matches(t, '{NO_CATEGORY}') GROUP BY place_id) SELECT CAST(place_id AS BIGINT) AS seq, coalesce(cs, '한식') AS categories FROM r LEFT JOIN m USING (place_id)),
enhanced AS (SELECT r.seq, p.place_id, p.name, r.address, p.phone, loc.lat, loc.lng, loc.source, CASE WHEN trim(t.price_text) <> '' THEN amounts.price_type END AS price_type, cats.categories
  FROM rough_places r JOIN places p ON p.seq = r.seq JOIN loc ON loc.seq = r.seq LEFT JOIN price_text t ON t.id = r.seq LEFT JOIN amounts ON amounts.seq = r.seq LEFT JOIN cats ON cats.seq = r.seq),
grouped AS (WITH {GROUPS_SQL.replace(" FROM places", " FROM enhanced")} SELECT member, seed FROM grouped),
gm AS (SELECT g.seed, e.*, CASE WHEN lat <> 0 AND lng <> 0 THEN 2.0 ELSE 0 END + CASE WHEN name <> '' THEN 1 ELSE 0 END + CASE WHEN address <> '' THEN 1 ELSE 0 END + CASE WHEN phone <> '' THEN 0.5 ELSE 0 END AS score FROM enhanced e JOIN grouped g ON e.seq = g.member),
gk AS (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY score DESC, seq) AS rank FROM gm), go AS (SELECT *, CASE WHEN rank = 1 THEN -1 ELSE seq END AS o FROM gk),
gold AS (SELECT max(place_id) FILTER (WHERE rank = 1) AS place_id, arg_min(name, o) FILTER (WHERE name <> '') AS name, arg_min(address, o) FILTER (WHERE address <> '') AS address, arg_min(lat, o) FILTER (WHERE lat <> 0) AS lat,
  arg_min(lng, o) FILTER (WHERE lng <> 0) AS lng, arg_min(phone, o) FILTER (WHERE phone <> '') AS phone, count(*) AS merged FROM go GROUP BY seed),
final AS (SELECT place_id, name, address, lat, lng, phone, 1 AS merged, source, price_type, categories FROM enhanced WHERE seq NOT IN (SELECT member FROM grouped)
  UNION ALL SELECT gold.*, e.source, e.price_type, e.categories FROM gold JOIN enhanced e USING (place_id))"""


@query(f"WITH {ENHANCED_SQL} SELECT place_id, name, address, round(lat, 6) AS lat, round(lng, 6) AS lng, phone, merged, source, price_type, categories FROM final")
def enhanced_places(v):
    """Places after the run."""
    out, _ = _run(v)
    return out.select("place_id", "name", "address", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"), "phone", "merged", "source", "price.price_type", F.array_join("categories", ",").alias("categories"))


@query(f"""WITH {ENHANCED_SQL}, n AS (SELECT count(*) AS total, (SELECT count(*) FROM final) AS final, count(lat) AS located, count(price_type) AS priced, count(categories) AS mapped FROM enhanced)
SELECT total, final, round(located * 100.0 / total, 6)::DOUBLE AS geocoding_rate, round(priced * 100.0 / total, 6)::DOUBLE AS price_rate, round(mapped * 100.0 / total, 6)::DOUBLE AS category_rate, round((total - final) * 100.0 / total, 6)::DOUBLE AS duplicate_rate,
  total = (SELECT count(*) FROM places) AS all_seen FROM n""")
def enhancement_counters(v):
    """The counters of the run, as rates of all places."""
    _, n = _run(v)
    rates = {"geocoding_rate": "located", "price_rate": "priced", "category_rate": "mapped", "duplicate_rate": "removed"}
    total = v.places.agg(F.count("*").alias("counted"))
    return total.select(
        F.lit(n["total"]).cast("long").alias("total"), F.lit(n["final"]).cast("long").alias("final"), *[F.round(F.lit(100.0 * n[c] / max(1, n["total"])), 6).alias(r) for r, c in rates.items()], (F.col("counted") == n["total"]).alias("all_seen")
    )
