"""Aggregate views over places, categories and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.columns import chain, count_where, present
from waymark.functions.geo import within
from waymark.operators.quality import BOXES, _in
from waymark.plans.durable import small_side
from waymark.plans.registry import query


def categories_of(places: DataFrame, bridge: DataFrame, categories: DataFrame) -> DataFrame:
    """places with category_names, sorted; empty where there are none."""
    names = bridge.join(small_side(categories.select(F.col("id").alias("category_id"), F.col("name").alias("category"))), "category_id")
    lists = names.groupBy("place_id").agg(F.array_sort(F.collect_set("category")).alias("category_names"))
    return places.join(lists, "place_id", "left").withColumn("category_names", F.coalesce("category_names", F.array().cast("array<string>")))


def region_of(address: Column) -> Column:
    """First bucket whose word the address holds."""
    return chain(
        [
            (address.contains("강남"), F.lit("강남")),
            (address.contains("홍대") | address.contains("마포"), F.lit("홍대/마포")),
            (address.contains("강북"), F.lit("강북")),
            (address.contains("서울"), F.lit("기타 서울")),
        ],
        F.lit("기타"),
    )


REGION_SQL = """CASE WHEN address LIKE '%강남%' THEN '강남' WHEN address LIKE '%홍대%' OR address LIKE '%마포%' THEN '홍대/마포'
  WHEN address LIKE '%강북%' THEN '강북' WHEN address LIKE '%서울%' THEN '기타 서울' ELSE '기타' END"""
NAMES_SQL = """LEFT JOIN (SELECT b.place_id, list_sort(list(DISTINCT c.name)) AS names FROM place_categories b JOIN categories c ON b.category_id = c.id
  GROUP BY b.place_id) n USING (place_id)"""


@query(f"""SELECT {REGION_SQL} AS region, count(*) AS total, count(*) FILTER (WHERE is_confirmed) AS confirmed,
  round(avg(src_rating), 6) AS avg_rating, count(*) FILTER (WHERE phone IS NOT NULL) AS with_phone FROM places GROUP BY 1""")
def regional_stats(v):
    return (
        v.places.groupBy(region_of(F.col("address")).alias("region"))
        .agg(
            F.count("*").alias("total"),
            count_where(F.col("is_confirmed")).alias("confirmed"),
            F.round(F.avg("src_rating"), 6).alias("avg_rating"),
            F.count("phone").alias("with_phone"),
        )
        .orderBy(F.desc("total"), "region")
    )


@query("""SELECT count(*) AS total, count(*) FILTER (WHERE lat IS NOT NULL AND lng IS NOT NULL) AS with_coordinates,
  count(*) FILTER (WHERE phone IS NOT NULL AND phone <> '') AS with_phone, count(src_rating) AS with_rating, round(avg(src_rating), 6) AS avg_rating,
  (SELECT count(*) FROM categories) AS categories, max(seq) AS last_seq FROM places""")
def crawl_stats(v):
    stats = v.places.agg(
        F.count("*").alias("total"),
        count_where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).alias("with_coordinates"),
        count_where(F.col("phone") != "").alias("with_phone"),
        F.count("src_rating").alias("with_rating"),
        F.round(F.avg("src_rating"), 6).alias("avg_rating"),
        F.max("seq").alias("last_seq"),
    )
    return stats.crossJoin(F.broadcast(v.categories.agg(F.count("*").alias("categories"))))


@query("""SELECT count(*) AS total, count(naver_rating) AS with_naver, count(kakao_rating) AS with_kakao,
  count(*) FILTER (WHERE len(names) > 0) AS with_items, round(avg(naver_rating), 6) AS avg_naver, round(avg(kakao_rating), 6) AS avg_kakao
  FROM places """ + NAMES_SQL)
def store_statistics(v):
    return categories_of(v.places, v.place_categories, v.categories).agg(
        F.count("*").alias("total"),
        F.count("naver_rating").alias("with_naver"),
        F.count("kakao_rating").alias("with_kakao"),
        count_where(F.size("category_names") > 0).alias("with_items"),
        F.round(F.avg("naver_rating"), 6).alias("avg_naver"),
        F.round(F.avg("kakao_rating"), 6).alias("avg_kakao"),
    )


@query("SELECT c.id, c.name, count(b.place_id) AS n FROM categories c LEFT JOIN place_categories b ON c.id = b.category_id GROUP BY c.id, c.name")
def category_counts(v):
    counts = v.place_categories.groupBy("category_id").agg(F.count("*").alias("n"))
    out = v.categories.join(counts, F.col("id") == F.col("category_id"), "left")
    return out.select("id", "name", F.coalesce("n", F.lit(0)).alias("n")).orderBy(F.desc("n"), "name")


@query("""SELECT c.name, count(DISTINCT b.place_id) AS n FROM categories c LEFT JOIN place_categories b ON c.id = b.category_id
  GROUP BY c.name ORDER BY n DESC, c.name LIMIT 20""")
def category_counts_distinct(v):
    counts = v.place_categories.groupBy("category_id").agg(F.countDistinct("place_id").alias("n"))
    out = v.categories.join(counts, F.col("id") == F.col("category_id"), "left")
    return out.select("name", F.coalesce("n", F.lit(0)).alias("n")).orderBy(F.desc("n"), "name").limit(20)


@query(f"SELECT place_id, name, coalesce(array_to_string(names, ','), '') AS category_names FROM places {NAMES_SQL} WHERE is_confirmed")
def confirmed_with_categories(v):
    out = categories_of(v.places.where("is_confirmed"), v.place_categories, v.categories)
    return out.select("place_id", "name", F.array_join("category_names", ",").alias("category_names"))


@query("""SELECT p.place_id, p.name, CAST(max(r.created_at) AS TIMESTAMP) AS last_review, count(*) AS reviews FROM places p JOIN reviews r USING (place_id)
  WHERE r.created_at >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY AND r.created_at <= TIMESTAMP '2001-08-01' GROUP BY p.place_id, p.name""")
def recent_places(v):
    as_of = F.to_timestamp_ntz(F.lit("2001-08-01 00:00:00"))
    recent = v.reviews.where((F.col("created_at") >= as_of - F.expr("INTERVAL 30 DAYS")) & (F.col("created_at") <= as_of))
    counts = recent.groupBy("place_id").agg(F.max("created_at").alias("last_review"), F.count("*").alias("reviews"))
    return v.places.join(counts, "place_id").select("place_id", "name", "last_review", "reviews")


@query(f"""SELECT place_id, name, round(coalesce(naver_rating, 0) + coalesce(kakao_rating, 0), 6) AS combined, coalesce(array_to_string(names, ','), '') AS category_names
  FROM places {NAMES_SQL} WHERE naver_rating IS NOT NULL OR kakao_rating IS NOT NULL ORDER BY combined DESC, place_id LIMIT 50""")
def top_rated(v):
    rated = v.places.where(F.col("naver_rating").isNotNull() | F.col("kakao_rating").isNotNull())
    rated = rated.withColumn("combined", F.round(F.coalesce("naver_rating", F.lit(0.0)) + F.coalesce("kakao_rating", F.lit(0.0)), 6))
    best = rated.orderBy(F.desc("combined"), "place_id").limit(50)
    out = categories_of(best, v.place_categories, v.categories)
    return out.select("place_id", "name", "combined", F.array_join("category_names", ",").alias("category_names")).orderBy(F.desc("combined"), "place_id")


@query(f"SELECT place_id, name, len(names) AS n_items FROM places {NAMES_SQL} WHERE len(names) > 0")
def most_items(v):
    out = categories_of(v.places, v.place_categories, v.categories).withColumn("n_items", F.size("category_names").cast("long"))
    return out.where("n_items > 0").select("place_id", "name", "n_items").orderBy(F.desc("n_items"), "name", "place_id")


@query("SELECT status, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share FROM places GROUP BY status")
def status_distribution(v):
    counts = v.places.groupBy("status").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 6))


COMPLETE = ("name", "address", "phone", "status", "refill_type")


@query("SELECT count(*) AS total, count(*) FILTER (WHERE lat IS NULL) AS no_lat, " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL OR {c} = '') AS no_{c}" for c in COMPLETE) + " FROM places")
def completeness_profile(v):
    gaps = [count_where(F.coalesce(F.col(c), F.lit("")) == "").alias(f"no_{c}") for c in COMPLETE]
    return v.places.agg(F.count("*").alias("total"), count_where(F.col("lat").isNull()).alias("no_lat"), *gaps)


@query(f"""SELECT count(*) AS total, count(*) FILTER (WHERE len(names) > 0) AS with_images,
  round(avg(CASE WHEN names IS NULL THEN 0 WHEN len(names) > 0 THEN len(names) END), 6) AS avg_images FROM places {NAMES_SQL}""")
def image_profile(v):
    """Null arrays count as 0 in the mean, empty ones are left out."""
    lists = v.place_categories.join(small_side(v.categories), F.col("category_id") == F.col("id")).groupBy("place_id").agg(F.collect_set("name").alias("names"))
    sizes = v.places.join(lists, "place_id", "left")
    mean = F.avg(F.when(F.col("names").isNull(), 0).when(F.size("names") > 0, F.size("names")))
    return sizes.agg(F.count("*").alias("total"), count_where(F.size("names") > 0).alias("with_images"), F.round(mean, 6).alias("avg_images"))


@query("SELECT name, address, count(*) AS n FROM places GROUP BY name, address HAVING count(*) > 1 ORDER BY n DESC, name, address LIMIT 10")
def dup_name_address(v):
    return v.places.groupBy("name", "address").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "name", "address").limit(10)


@query("""SELECT round(lat, 6) AS lat, round(lng, 6) AS lng, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names FROM places
  WHERE lat IS NOT NULL AND lng IS NOT NULL GROUP BY lat, lng HAVING count(*) > 2""")
def colocated(v):
    groups = v.places.where("lat IS NOT NULL AND lng IS NOT NULL").groupBy("lat", "lng")
    out = groups.agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("name")), ",").alias("names")).where("n > 2")
    return out.select(F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"), "n", "names")


@query("SELECT per_place, count(*) AS places FROM (SELECT place_id, count(*) AS per_place FROM place_categories GROUP BY place_id) x GROUP BY per_place")
def bridge_histogram(v):
    return v.place_categories.groupBy("place_id").agg(F.count("*").alias("per_place")).groupBy("per_place").agg(F.count("*").alias("places"))


@query("SELECT word, count(*) AS n FROM (SELECT unnest(string_split(address, ' ')) AS word FROM places) x GROUP BY word")
def raw_category_freq(v):
    return v.places.select(F.explode(F.split("address", " ")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


@query("SELECT refill_type, count(*) AS n FROM places GROUP BY refill_type ORDER BY n DESC, refill_type LIMIT 10")
def type_distribution(v):
    return v.places.groupBy("refill_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "refill_type").limit(10)


@query("""SELECT count(*) AS with_coordinates, count(*) FILTER (WHERE lat BETWEEN 37.4 AND 37.7 AND lng BETWEEN 126.8 AND 127.2) AS in_seoul,
  count(*) FILTER (WHERE NOT (lat BETWEEN 33 AND 43 AND lng BETWEEN 124 AND 132)) AS abroad FROM places WHERE lat IS NOT NULL AND lng IS NOT NULL""")
def coordinate_profile(v):
    lat, lng = F.col("lat"), F.col("lng")
    return v.places.where(lat.isNotNull() & lng.isNotNull()).agg(
        F.count("*").alias("with_coordinates"),
        count_where(lat.between(37.4, 37.7) & lng.between(126.8, 127.2)).alias("in_seoul"),
        count_where(~(lat.between(33, 43) & lng.between(124, 132))).alias("abroad"),
    )


_SPREAD = "SELECT lat + seq % 9 - 2 AS lat, lng + (seq % 11) - 5 AS lng FROM rough_places"


@query(" UNION ALL ".join(f"SELECT '{name}' AS box, count(*) FILTER (WHERE {_in(box)}) AS inside, count(*) FILTER (WHERE NOT ({_in(box)})) AS outside FROM ({_SPREAD}) x" for name, box in BOXES.items()))
def box_profile(v):
    """Coordinates inside and outside each of the boxes in use, in one pass."""
    moved = v.rough_places.select((F.col("lat") + F.col("seq") % 9 - 2).alias("lat"), (F.col("lng") + F.col("seq") % 11 - 5).alias("lng"))
    inside = {name: within(F.col("lat"), F.col("lng"), box) for name, box in BOXES.items()}
    one = moved.agg(*[c for name, test in inside.items() for c in (count_where(test).alias(f"{name}_in"), count_where(~test).alias(f"{name}_out"))])
    rows = F.array(*[F.struct(F.lit(name).alias("box"), F.col(f"{name}_in").alias("inside"), F.col(f"{name}_out").alias("outside")) for name in BOXES])
    return one.select(F.explode(rows).alias("b")).select("b.*")


@query("""SELECT count(*) AS total, count(*) FILTER (WHERE trim(phone) <> '') AS phones, count(*) FILTER (WHERE lat IS NOT NULL) AS coordinates,
  count(*) FILTER (WHERE src_rating IS NOT NULL) AS ratings, round(count(*) FILTER (WHERE trim(phone) <> '') * 100.0 / count(*), 6) AS phone_rate FROM places""")
def collection_rates(v):
    return v.places.agg(
        F.count("*").alias("total"),
        count_where(present(F.col("phone"))).alias("phones"),
        F.count("lat").alias("coordinates"),
        F.count("src_rating").alias("ratings"),
        F.round(F.try_divide(count_where(present(F.col("phone"))) * 100.0, F.count("*")), 6).alias("phone_rate"),
    )


@query("""SELECT p.place_id, c.name FROM places p CROSS JOIN categories c WHERE c.name = '한식' AND NOT EXISTS (SELECT 1 FROM place_categories b WHERE b.place_id = p.place_id)""")
def default_category_assign(v):
    """Places without a category get the default one."""
    missing = v.places.join(v.place_categories, "place_id", "left_anti").select("place_id")
    return missing.crossJoin(small_side(v.categories.where(F.col("name") == "한식").select("name")))


@query("""SELECT nation_id, place_id, address FROM (SELECT nation_id, place_id, address, row_number() OVER (PARTITION BY nation_id ORDER BY src_rating DESC NULLS LAST, place_id) AS r
  FROM places) x WHERE r <= 5""")
def top5_per_group(v):
    rank = F.row_number().over(Window.partitionBy("nation_id").orderBy(F.desc_nulls_last("src_rating"), "place_id"))
    return v.places.withColumn("r", rank).where("r <= 5").select("nation_id", "place_id", "address")


@query("""SELECT place_id, name, phone FROM (SELECT *, row_number() OVER (PARTITION BY phone ORDER BY seq) AS r FROM places WHERE phone IS NOT NULL AND phone <> '') x WHERE r = 1""")
def first_per_key(v):
    """First row of each phone in input order; rows without a phone are dropped."""
    rank = F.row_number().over(Window.partitionBy("phone").orderBy("seq"))
    return v.places.where(F.col("phone") != "").withColumn("r", rank).where("r = 1").select("place_id", "name", "phone")


@query("""SELECT count(*) AS places, count(DISTINCT category_id) AS used, (SELECT count(*) FROM categories) - count(DISTINCT category_id) AS unused FROM place_categories""")
def category_coverage(v):
    used = v.place_categories.agg(F.count("*").alias("places"), F.countDistinct("category_id").alias("used"))
    return used.crossJoin(F.broadcast(v.categories.agg(F.count("*").alias("all")))).select("places", "used", (F.col("all") - F.col("used")).alias("unused"))
