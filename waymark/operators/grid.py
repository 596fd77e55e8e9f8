"""Rectangles and search grids over districts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.columns import chain
from waymark.functions.geo import rect_around, rect_text
from waymark.functions.text import district_code
from waymark.plans.registry import query

#: District, tier, expected places, centre.
DISTRICTS = (
    ("강남구", 1, 80, 37.5173, 127.0473), ("마포구", 1, 75, 37.5663, 126.9019), ("서초구", 1, 70, 37.4837, 127.0324),
    ("송파구", 2, 65, 37.5145, 127.1059), ("영등포구", 2, 60, 37.5264, 126.8962), ("용산구", 2, 55, 37.5384, 126.9654),
    ("성동구", 2, 55, 37.5636, 127.0365), ("광진구", 2, 50, 37.5384, 127.0822), ("관악구", 3, 45, 37.4781, 126.9515),
    ("서대문구", 3, 40, 37.5791, 126.9368), ("종로구", 3, 40, 37.5735, 126.9788), ("중구", 3, 35, 37.5641, 126.9979),
    ("성북구", 3, 35, 37.5894, 127.0167), ("동대문구", 3, 35, 37.5744, 127.0098), ("노원구", 4, 30, 37.6542, 127.0568),
    ("강북구", 4, 30, 37.6398, 127.0256), ("은평구", 4, 30, 37.6176, 126.9227), ("강서구", 4, 30, 37.5509, 126.8495),
    ("양천구", 4, 25, 37.5170, 126.8664), ("구로구", 4, 25, 37.4954, 126.8874), ("금천구", 4, 25, 37.4519, 126.9018),
    ("동작구", 4, 25, 37.5124, 126.9393), ("강동구", 5, 20, 37.5301, 127.1238), ("중랑구", 5, 20, 37.6063, 127.0925),
    ("도봉구", 5, 20, 37.6688, 127.0471),
)
#: Codes of the districts that have one.
CODES = {"강남구": "gangnam", "서초구": "seocho", "송파구": "songpa", "강동구": "gangdong", "마포구": "mapo", "영등포구": "yeongdeungpo", "용산구": "yongsan", "성동구": "seongdong", "광진구": "gwangjin"}
#: Places in a grid above which it is split, and below which it is marked for merging.
SPLIT_ABOVE, MERGE_BELOW = 50, 5


def counts_in(rects: DataFrame, places: DataFrame, size: float = 0.05) -> DataFrame:
    """rects with n, the places inside (borders included): an equi-join on cells that each rectangle covers, then the exact test."""
    cells = rects.select("rect_id", "min_lat", "min_lng", "max_lat", "max_lng").withColumn(
        "cx", F.explode(F.sequence(F.floor(F.col("min_lat") / size), F.floor(F.col("max_lat") / size)))
    ).withColumn("cy", F.explode(F.sequence(F.floor(F.col("min_lng") / size), F.floor(F.col("max_lng") / size))))
    points = places.where((F.col("lat") != 0) & (F.col("lng") != 0)).select("lat", "lng", F.floor(F.col("lat") / size).alias("cx"), F.floor(F.col("lng") / size).alias("cy"))
    inside = F.col("lat").between(F.col("min_lat"), F.col("max_lat")) & F.col("lng").between(F.col("min_lng"), F.col("max_lng"))
    n = cells.join(points, ["cx", "cy"]).where(inside).groupBy("rect_id").agg(F.count("*").alias("n"))
    return rects.join(n, "rect_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("SELECT r.rect_id, count(p.place_id) AS n FROM rects r LEFT JOIN places p ON p.lat BETWEEN r.min_lat AND r.max_lat AND p.lng BETWEEN r.min_lng AND r.max_lng GROUP BY r.rect_id")
def rect_counts(v):
    return counts_in(v.rects, v.places).select("rect_id", "n")


def adapt(grids: DataFrame) -> DataFrame:
    """Crowded grids become four of half the size, those with few places are renamed for merging if there is another grid to
    merge with, others stay. grids: name, rect columns, grid_size, n."""
    others = grids.select("name").distinct().limit(2).count() > 1
    mid_lat, mid_lng = (F.col("min_lat") + F.col("max_lat")) / 2, (F.col("min_lng") + F.col("max_lng")) / 2

    def part(name: str, a, b, c, d):
        return F.struct(
            F.concat(F.col("name"), F.lit(f"_{name}")).alias("name"), a.alias("min_lat"), b.alias("min_lng"), c.alias("max_lat"), d.alias("max_lng"),
            F.floor(F.col("grid_size") / 2).cast("long").alias("grid_size"),
        )

    lo_lat, lo_lng, hi_lat, hi_lng = (F.col(c) for c in ("min_lat", "min_lng", "max_lat", "max_lng"))
    four = F.array(
        part("NW", lo_lat, lo_lng, mid_lat, mid_lng), part("NE", lo_lat, mid_lng, mid_lat, hi_lng),
        part("SW", mid_lat, lo_lng, hi_lat, mid_lng), part("SE", mid_lat, mid_lng, hi_lat, hi_lng),
    )
    name = F.when((F.col("n") < MERGE_BELOW) & F.lit(others), F.concat("name", F.lit("_merged"))).otherwise(F.col("name"))
    one = F.array(F.struct(name.alias("name"), lo_lat.alias("min_lat"), lo_lng.alias("min_lng"), hi_lat.alias("max_lat"), hi_lng.alias("max_lng"), F.col("grid_size").cast("long").alias("grid_size")))
    return grids.select(F.explode(F.when(F.col("n") > SPLIT_ABOVE, four).otherwise(one)).alias("g")).select("g.*")


@query("""WITH c AS (SELECT r.rect_id, 'g' || r.rect_id AS name, r.min_lat, r.min_lng, r.max_lat, r.max_lng, count(p.place_id) AS n FROM rects r
  LEFT JOIN places p ON p.lat BETWEEN r.min_lat AND r.max_lat AND p.lng BETWEEN r.min_lng AND r.max_lng GROUP BY ALL)
SELECT name || CASE WHEN n < 5 AND (SELECT count(*) FROM c) > 1 THEN '_merged' ELSE '' END AS name, round(min_lat, 6) AS min_lat, round(min_lng, 6) AS min_lng, CAST(800 AS BIGINT) AS grid_size FROM c WHERE n <= 50
UNION ALL SELECT name || q.s, round(CASE WHEN q.a = 0 THEN min_lat ELSE (min_lat + max_lat) / 2 END, 6), round(CASE WHEN q.b = 0 THEN min_lng ELSE (min_lng + max_lng) / 2 END, 6), 400
FROM c, (VALUES ('_NW', 0, 0), ('_NE', 0, 1), ('_SW', 1, 0), ('_SE', 1, 1)) q(s, a, b) WHERE n > 50""")
def grid_adapt(v):
    grids = counts_in(v.rects, v.places).withColumn("name", F.concat(F.lit("g"), F.col("rect_id").cast("string"))).withColumn("grid_size", F.lit(800))
    return adapt(grids).select("name", F.round("min_lat", 6).alias("min_lat"), F.round("min_lng", 6).alias("min_lng"), "grid_size")


@query("WITH d(name, lat, lng) AS (VALUES " + ", ".join(f"('{d[0]}', {d[3]}::DOUBLE, {d[4]}::DOUBLE)" for d in DISTRICTS) + """)
SELECT name, printf('%.4f,%.4f,%.4f,%.4f', lat - 0.018, lng - 0.018 / 1.1, lat + 0.018, lng + 0.018 / 1.1) AS rect FROM d""")
def region_rects(v):
    districts = v.spark.createDataFrame([(d[0], d[3], d[4]) for d in DISTRICTS], "name string, lat double, lng double")
    return districts.select("name", rect_text(rect_around(F.col("lat"), F.col("lng"), F.lit(2.0))).alias("rect"))


@query("SELECT place_id, CASE WHEN address LIKE '%강남구%' THEN 'gangnam' WHEN address LIKE '%서초구%' THEN 'seocho' WHEN address LIKE '%송파구%' THEN 'songpa' WHEN address LIKE '%마포구%' THEN 'mapo' ELSE 'others' END AS district FROM places")
def district_of(v):
    return v.places.select("place_id", district_code(F.col("address"), CODES).alias("district"))


@query("SELECT place_id, CASE WHEN src_rating >= 4.5 THEN 300 WHEN src_rating >= 3.5 THEN 500 WHEN src_rating >= 2.5 THEN 800 ELSE 1200 END AS grid_size FROM places")
def grid_size_by_score(v):
    score = F.col("src_rating") * 2
    size = chain([(score >= 9, 300), (score >= 7, 500), (score >= 5, 800)], 1200)
    return v.places.select("place_id", size.alias("grid_size"))
