"""What detail pages hold: menu and price lines, coordinates and menus in scripts, images, notices, opening texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions.columns import blank_to_null, chain, extract, let, present, total
from waymark.functions.geo import geodesic_m, geodesic_sql, haversine_m, sql_distance, within
from waymark.operators.quality import BOXES
from waymark.plans.registry import query

#: Words and patterns that decide.
MENU_HEADERS = ("Advertisement", "advertisement", "메뉴정보", "운영정보", "영업시간", "전화번호", "주소", "평점", "리뷰", "사진")
REFILL_WORDS = ("무한리필", "무제한", "셀프바")
FOOD_WORDS = ("고기", "삼겹살", "소고기", "돼지고기", "초밥", "회", "해산물", "야채")
RELEVANT_WORDS = ("무한리필", "뷔페", "무제한", "리필", "자유이용권")
KEPT_LINE_WORDS = ("무한리필", "추천", "할인", "세트", "코스")
REVIEW_WORDS = (
    "맛있", "좋았", "별로", "추천해", "후기", "리뷰", "평점", "별점", "재방문", "맛집", "블로그", "안녕하세요", "먹어보니", "찾고 계신다면",
    "제로에요", "잇님들", "ㄷㄷ", "보이시죠", "폐업신고", "정보수정", "유명하다는", "느낌은 아니었지만", "간절할때",
)
CLOSURE_WORDS = ("폐업", "영업종료", "문을 닫았습니다", "운영중단", "임시휴업", "휴업", "잠시 문을 닫습니다", "리뉴얼", "이전", "폐점")
ALL_DAY_WORDS = ("24시간", "24hour", "24hr", "24H", "무휴", "24/7")
WON = "([0-9]{1,3}(?:,[0-9]{3})*) *원"
MENU_LINE = "([가-힣 ()]*(?:무한리필|뷔페|셀프바)[가-힣 ()]*?) +" + WON
COORDINATES = (("latitude", "longitude"), ("lat", "lng"), ("poi_lat", "poi_lng"), ("mapLat", "mapLng"))
NUMBER = "[\"']? *[:=] *([0-9]+\\.?[0-9]*)"
CITY_CENTRES = {
    "서울": (37.5665, 126.9780), "부산": (35.1796, 129.0756), "대구": (35.8714, 128.6014), "인천": (37.4563, 126.7052),
    "광주": (35.1595, 126.8526), "대전": (36.3504, 127.3845), "울산": (35.5384, 129.3114),
}
CITY_REACH_M = 50_000.0
PAGE_BOX = BOXES["pages"]
MENU_LEAST, MENU_MOST, JS_LEAST, JS_MOST = 5_000, 50_000, 5_000, 100_000


def listed(values: tuple[str, ...]) -> str:
    """The values as a SQL list."""
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def words_in(text: Column, words: tuple[str, ...]) -> Column:
    """The words of a fixed list that a text contains, in the order of the list."""
    return F.filter(F.array(*map(F.lit, words)), lambda w: F.coalesce(text.contains(w), F.lit(False)))


def mentions(text: Column, words: tuple[str, ...]) -> Column:
    return F.size(words_in(text, words)) > 0


def menu_name(raw: Column) -> Column:
    """What follows the last header word, with single spaces."""
    last = F.regexp_replace(F.coalesce(raw, F.lit("")), "(?s)^.*(?:" + "|".join(MENU_HEADERS) + ")", "")
    return F.trim(F.regexp_replace(last, "\\s+", " "))


@query(f"SELECT id, trim(regexp_replace(regexp_replace(raw_menu, '^.*({'|'.join(MENU_HEADERS)})', '', 's'), '\\s+', ' ', 'g')) AS menu FROM details")
def menu_names(v):
    return v.details.select("id", menu_name(F.col("raw_menu")).alias("menu"))


@query(f"""SELECT id, array_to_string(list_filter({listed(REFILL_WORDS + FOOD_WORDS)}, lambda w: contains(lower(section), w))[1:10], ',') AS words FROM details""")
def menu_keywords(v):
    """The first ten known words of a section, in the order of the list."""
    found = F.slice(words_in(F.lower("section"), REFILL_WORDS + FOOD_WORDS), 1, 10)
    return v.details.select("id", F.array_join(found, ",").alias("words"))


def menu_lines(section: Column) -> Column:
    """Lines of three letters or more that are no review and hold a price or a menu word."""
    lines = F.transform(F.split(section, "\n"), lambda x: F.trim(x))
    return F.filter(lines, lambda x: (F.char_length(x) >= 3) & ~x.rlike("|".join(REVIEW_WORDS)) & x.rlike(WON + "|" + "|".join(KEPT_LINE_WORDS)))


@query(f"""SELECT id, array_to_string(list_filter(list_transform(string_split(section, chr(10)), lambda x: trim(x)), lambda x: length(x) >= 3
  AND NOT regexp_matches(x, '{'|'.join(REVIEW_WORDS)}') AND regexp_matches(x, '{WON}|{'|'.join(KEPT_LINE_WORDS)}')), '/') AS lines FROM details""")
def section_lines(v):
    return v.details.select("id", F.array_join(menu_lines(F.col("section")), "/").alias("lines"))


def mined_menu(section: Column) -> Column:
    """(price, place, name) of refill items with a price in range: the first of each name, cheapest first."""
    lines = F.array_join(menu_lines(section), "\n")
    names = F.regexp_extract_all(lines, F.lit(MENU_LINE), F.lit(1))
    prices = F.transform(F.regexp_extract_all(lines, F.lit(MENU_LINE), F.lit(2)), lambda p: F.replace(p, F.lit(","), F.lit("")).cast("long"))
    names = F.transform(names, lambda n: F.trim(F.regexp_replace(n, " +", " ")))
    items = F.zip_with(names, prices, lambda n, p: F.struct(p.alias("price"), n.alias("name")))
    items = F.transform(items, lambda x, i: F.struct(x["price"].alias("price"), i.alias("place"), x["name"].alias("name")))
    items = F.filter(items, lambda x: x["price"].between(MENU_LEAST, MENU_MOST) & F.char_length(x["name"]).between(3, 30))
    named = F.array_sort(F.transform(items, lambda x: F.struct(x["name"].alias("name"), x["place"].alias("place"), x["price"].alias("price"))))
    # sorted by name and place, the first of a name is the one whose neighbour has another
    first = let(named, lambda every: F.filter(every, lambda x, i: (i == 0) | (F.get(every, i - 1)["name"] != x["name"])))
    return F.array_sort(F.transform(first, lambda x: F.struct(x["price"].alias("price"), x["place"].alias("place"), x["name"].alias("name"))))


@query(f"""WITH l AS (SELECT id, array_to_string(list_filter(list_transform(string_split(section, chr(10)), lambda x: trim(x)), lambda x: length(x) >= 3
  AND NOT regexp_matches(x, '{'|'.join(REVIEW_WORDS)}') AND regexp_matches(x, '{WON}|{'|'.join(KEPT_LINE_WORDS)}')), chr(10)) AS t FROM details),
m AS (SELECT id, unnest(regexp_extract_all(t, '{MENU_LINE}', 1)) AS name, unnest(regexp_extract_all(t, '{MENU_LINE}', 2)) AS price, unnest(range(len(regexp_extract_all(t, '{MENU_LINE}', 1)))) AS place FROM l),
k AS (SELECT id, trim(regexp_replace(name, ' +', ' ', 'g')) AS name, CAST(replace(price, ',', '') AS BIGINT) AS price, place FROM m),
g AS (SELECT *, row_number() OVER (PARTITION BY id, name ORDER BY place) AS r FROM k WHERE price BETWEEN {MENU_LEAST} AND {MENU_MOST} AND length(name) BETWEEN 3 AND 30)
SELECT id, row_number() OVER (PARTITION BY id ORDER BY price, place) - 1 AS rank, name, price FROM g WHERE r = 1""")
def menu_from_text(v):
    found = v.details.select("id", F.posexplode(mined_menu(F.col("section"))).alias("rank", "item"))
    return found.select("id", F.col("rank").cast("long").alias("rank"), "item.name", "item.price")


@query("""WITH x AS (SELECT id, unnest(string_split(section, chr(10))) AS line, unnest(range(len(string_split(section, chr(10))))) AS pos FROM details),
p AS (SELECT id, pos, line, coalesce(TRY_CAST(replace(nullif(regexp_extract(line, '([0-9,]+) *원', 1), ''), ',', '') AS BIGINT), 0) AS price FROM x)
SELECT id, row_number() OVER (PARTITION BY id ORDER BY price = 0, CASE WHEN price > 0 THEN price END, pos) - 1 AS rank, price, contains(line, '추천') AS recommended FROM p""")
def priced_lines(v):
    """Lines with their price and a flag, the priced ones by price, the free ones behind in input order."""
    line = F.transform(F.split("section", "\n"), lambda x, i: F.struct(
        F.coalesce(F.replace(extract(x, "([0-9,]+) *원"), F.lit(","), F.lit("")).try_cast("long"), F.lit(0)).alias("price"), i.alias("at"), x.contains("추천").alias("recommended")))
    placed = F.transform(line, lambda x: F.struct((x["price"] == 0).alias("free"), x["price"].alias("price"), x["at"].alias("at"), x["recommended"].alias("recommended")))
    found = v.details.select("id", F.posexplode(F.array_sort(placed)).alias("rank", "x"))
    return found.select("id", F.col("rank").cast("long").alias("rank"), "x.price", "x.recommended")


def script_pair(script: Column) -> Column:
    """(lat, lng) by the first pair of names that both have a number."""
    pairs = []
    for lat, lng in COORDINATES:
        y, x = (extract(script, f"(?i){n}{NUMBER}").try_cast("double") for n in (lat, lng))
        pairs.append(F.when(y.isNotNull() & x.isNotNull(), F.struct(y.alias("lat"), x.alias("lng"))))
    return F.coalesce(*pairs)


def script_coordinates(script: Column) -> Column:
    """The coordinates of a script; null outside the country."""
    found = script_pair(script)
    return F.when(within(found["lat"], found["lng"], PAGE_BOX), found)


def _number_sql(name: str) -> str:
    pattern = f"(?i){name}{NUMBER}".replace("'", "''")
    return f"TRY_CAST(nullif(regexp_extract(script, '{pattern}', 1), '') AS DOUBLE)"


@query("WITH c AS (SELECT id, CASE " + " ".join(
    f"WHEN {_number_sql(a)} IS NOT NULL AND {_number_sql(b)} IS NOT NULL THEN [{_number_sql(a)}, {_number_sql(b)}]" for a, b in COORDINATES
) + f""" END AS p FROM details)
SELECT id, CASE WHEN p[1] BETWEEN {PAGE_BOX[0]} AND {PAGE_BOX[1]} AND p[2] BETWEEN {PAGE_BOX[2]} AND {PAGE_BOX[3]} THEN p[1] END AS lat,
  CASE WHEN p[1] BETWEEN {PAGE_BOX[0]} AND {PAGE_BOX[1]} AND p[2] BETWEEN {PAGE_BOX[2]} AND {PAGE_BOX[3]} THEN p[2] END AS lng FROM c""")
def coordinates_from_script(v):
    found = v.details.select("id", script_coordinates(F.col("script")).alias("p"))
    return found.select("id", "p.lat", "p.lng")


JS_MENU = "array<struct<menu:struct<list:array<struct<menu:string,price:string>>>>>"


@query(f"""WITH j AS (SELECT id, unnest(CAST(json_extract(regexp_extract(menu_script, 'aData *= *(\\[.*?\\]);', 1, 's'), '$[0].menu.list[*]') AS JSON[])) AS x FROM details),
m AS (SELECT id, trim(json_extract_string(x, '$.menu')) AS name, TRY_CAST(regexp_replace(json_extract_string(x, '$.price'), '[^0-9]', '', 'g') AS BIGINT) AS price FROM j)
SELECT id, name, price FROM m WHERE price BETWEEN {JS_LEAST} AND {JS_MOST} AND name <> ''""")
def menu_from_script(v):
    """Items of the menu that a script assigns to aData, with a price in range."""
    data = F.from_json(extract(F.col("menu_script"), "(?s)aData *= *(\\[.*?\\]);"), JS_MENU)
    items = v.details.select("id", F.explode(F.get(data, F.lit(0))["menu"]["list"]).alias("x"))
    price = F.regexp_replace("x.price", "[^0-9]", "").try_cast("long")
    out = items.select("id", F.trim("x.menu").alias("name"), price.alias("price"))
    return out.where(F.col("price").between(JS_LEAST, JS_MOST) & (F.col("name") != ""))


@query("""SELECT id, array_to_string(list_sort(list_distinct(list_filter(string_split(image_list, '|'), lambda u: regexp_matches(u, '^https?://'))))[1:5], '|') AS urls,
  len(list_filter(string_split(image_list, '|'), lambda u: regexp_matches(u, '^(https?:)?//'))) AS loose FROM details""")
def image_urls(v):
    """At most five distinct absolute addresses in order, and how many a rule that allows // would take."""
    urls = F.split("image_list", "\\|")
    strict = F.slice(F.array_sort(F.array_distinct(F.filter(urls, lambda u: u.rlike("^https?://")))), 1, 5)
    return v.details.select("id", F.array_join(strict, "|").alias("urls"), F.size(F.filter(urls, lambda u: u.rlike("^(https?:)?//"))).cast("long").alias("loose"))


@query("""SELECT id, CASE WHEN nullif(open_hours, '') IS NOT NULL THEN concat_ws(' / ', open_hours, '브레이크타임: ' || nullif(break_time, ''), '휴무: ' || nullif(holiday, '')) END AS shown FROM details""")
def open_hours_text(v):
    """Hours, break and closing day in one line; null without hours."""
    shown = F.concat_ws(" / ", "open_hours", F.concat(F.lit("브레이크타임: "), blank_to_null(F.col("break_time"))), F.concat(F.lit("휴무: "), blank_to_null(F.col("holiday"))))
    return v.details.select("id", F.when(present(F.col("open_hours")), shown).alias("shown"))


@query(f"SELECT id FROM details WHERE len(list_filter({listed(ALL_DAY_WORDS)}, lambda w: contains(open_hours, w))) > 0 AND coalesce(break_time, '') <> ''")
def all_day_conflicts(v):
    """Claims of being always open next to a break."""
    return v.details.where(mentions(F.col("open_hours"), ALL_DAY_WORDS) & present(F.col("break_time"))).select("id")


@query(f"""SELECT id, array_to_string(list_concat(list_transform(list_filter({listed(CLOSURE_WORDS)}, lambda w: contains(notice, w)), lambda w: '키워드 발견: ' || w),
  CASE WHEN contains(notice, '준비중') AND NOT contains(notice, '오픈') THEN ['준비중 상태'] ELSE [] END,
  CASE WHEN contains(notice, '공사중') OR contains(notice, '리모델링') THEN ['공사/리모델링 중'] ELSE [] END), ', ') AS evidence FROM details WHERE notice IS NOT NULL""")
def closure_evidence(v):
    """Words of closure in a notice, and two composite signs."""
    t = F.col("notice")
    found = F.transform(words_in(t, CLOSURE_WORDS), lambda w: F.concat(F.lit("키워드 발견: "), w))
    signs = F.array(F.when(t.contains("준비중") & ~t.contains("오픈"), "준비중 상태"), F.when(t.contains("공사중") | t.contains("리모델링"), "공사/리모델링 중"))
    return v.details.where(t.isNotNull()).select("id", F.array_join(F.concat(found, signs), ", ").alias("evidence"))


@query(f"""SELECT d.id, len(list_filter({listed(RELEVANT_WORDS)}, lambda w: contains(d.raw_menu, w))) > 0 OR
  len(list_filter({listed(RELEVANT_WORDS)}, lambda w: contains(d.section, w))) > 0 AS relevant FROM details d""")
def refill_relevance(v):
    """Any word of the theme in the name or the description."""
    return v.details.select("id", (mentions(F.col("raw_menu"), RELEVANT_WORDS) | mentions(F.col("section"), RELEVANT_WORDS)).alias("relevant"))


@query("SELECT id, nullif(trim(regexp_extract(raw_menu, '([^ ]+) *무한리필', 1)), '') AS item FROM details")
def refill_items(v):
    """What a text says can be refilled."""
    return v.details.select("id", extract(F.col("raw_menu"), "([^ ]+) *무한리필").alias("item"))


@query("""WITH a AS (SELECT id, list_filter([nullif(trim(regexp_extract(raw_menu, '([^ ]+) *무한리필', 1)), ''), nullif(regexp_extract(section, '성인 ([가-힣]+)', 1), ''),
  nullif(regexp_extract(section, '점심 ([가-힣]+)', 1), ''), name], lambda x: x IS NOT NULL) AS l FROM details)
SELECT id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i)[1:10], '|') AS summary FROM a""")
def item_summary(v):
    """Three lists of names in one, each name once at its first place, ten at most."""
    parts = F.array(extract(F.col("raw_menu"), "([^ ]+) *무한리필"), extract(F.col("section"), "성인 ([가-힣]+)"), extract(F.col("section"), "점심 ([가-힣]+)"), F.col("name"))
    return v.details.select("id", F.array_join(F.slice(F.array_distinct(F.array_compact(parts)), 1, 10), "|").alias("summary"))


@query(f"""SELECT place_id, CAST(CASE WHEN places.name <> '' THEN 10 ELSE 0 END + CASE WHEN address <> '' THEN 15 ELSE 0 END + CASE WHEN lat <> 0 AND lng <> 0 THEN 15 ELSE 0 END
  + CASE WHEN phone <> '' THEN 20 ELSE 0 END + CASE WHEN open_hours <> '' THEN 10 ELSE 0 END + CASE WHEN break_time <> '' THEN 5 ELSE 0 END + CASE WHEN holiday <> '' THEN 5 ELSE 0 END
  + CASE WHEN section LIKE '%원%' THEN 5 ELSE 0 END + CASE WHEN regexp_matches(image_list, 'https?://') THEN 5 ELSE 0 END + CASE WHEN raw_menu LIKE '%무한리필%' THEN 5 ELSE 0 END
  + CASE WHEN len(list_filter({listed(FOOD_WORDS)}, lambda w: contains(section, w))) > 0 THEN 5 ELSE 0 END AS BIGINT) AS score FROM places JOIN details ON seq = id""")
def record_quality(v):
    """0 to 100 by which fields a record fills."""
    c = F.col
    located = F.coalesce((c("lat") != 0) & (c("lng") != 0), F.lit(False))
    rules = [
        (present(c("name")), 10), (present(c("address")), 15), (located, 15), (present(c("phone")), 20), (present(c("open_hours")), 10), (present(c("break_time")), 5),
        (present(c("holiday")), 5), (c("section").contains("원"), 5), (c("image_list").rlike("https?://"), 5), (c("raw_menu").contains("무한리필"), 5), (mentions(c("section"), FOOD_WORDS), 5),
    ]
    score = total([F.when(F.coalesce(rule, F.lit(False)), points).otherwise(0) for rule, points in rules])
    joined = v.places.join(v.details.drop("name"), F.col("seq") == F.col("id"))
    return joined.select("place_id", score.cast("long").alias("score"))


@query("SELECT place_id, city, round(metres, 3) AS metres, metres > 50000 AS mismatch FROM (SELECT place_id, CASE "
       + " ".join(f"WHEN contains(address, '{c}') THEN '{c}'" for c in CITY_CENTRES) + " END AS city, CASE "
       + " ".join(f"WHEN contains(address, '{c}') THEN {sql_distance('lat', 'lng', str(y), str(x))}" for c, (y, x) in CITY_CENTRES.items())
       + " END AS metres FROM places WHERE lat IS NOT NULL) q")
def city_mismatch(v):
    """Distance to the centre of the first city that the address names, and whether it is over 50 km."""
    a = F.col("address")
    city = chain([(a.contains(c), F.lit(c)) for c in CITY_CENTRES])
    metres = chain([(a.contains(c), haversine_m(F.col("lat"), F.col("lng"), F.lit(y), F.lit(x))) for c, (y, x) in CITY_CENTRES.items()])
    out = v.places.where("lat IS NOT NULL").select("place_id", city.alias("city"), metres.alias("m"))
    return out.select("place_id", "city", F.round("m", 3).alias("metres"), (F.col("m") > CITY_REACH_M).alias("mismatch"))


_CENTRES = " ".join(f"WHEN contains(address, '{c}') THEN [{y}, {x}]" for c, (y, x) in CITY_CENTRES.items())


@query(f"""WITH RECURSIVE c AS (SELECT place_id AS id, lat AS lat1, lng AS lng1, CASE {_CENTRES} END AS p FROM places WHERE lat IS NOT NULL AND lng IS NOT NULL),
pts AS (SELECT id, lat1, lng1, CAST(p[1] AS DOUBLE) AS lat2, CAST(p[2] AS DOUBLE) AS lng2 FROM c WHERE p IS NOT NULL), {geodesic_sql('pts')}
SELECT id AS place_id, round(metres, 3) AS metres, metres > {CITY_REACH_M} AS mismatch FROM geo""")
def city_geodesic(v):
    """Distance on the ellipsoid to the centre of the first city that the address names."""
    a = F.col("address")
    centre = chain([(a.contains(c), F.struct(F.lit(y).alias("y"), F.lit(x).alias("x"))) for c, (y, x) in CITY_CENTRES.items()])
    placed = v.places.where("lat IS NOT NULL AND lng IS NOT NULL").select("place_id", "lat", "lng", centre.alias("c")).where("c IS NOT NULL")
    out = placed.select("place_id", geodesic_m(F.col("lat"), F.col("lng"), F.col("c.y"), F.col("c.x")).alias("m"))
    return out.select("place_id", F.round("m", 3).alias("metres"), (F.col("m") > CITY_REACH_M).alias("mismatch"))


@query("""SELECT seq, printf('%.6f,%.6f,%.6f,%.6f', lat - s, lng - s, lat + s, lng + s) AS rect, lng AS x, lat AS y
FROM (SELECT seq, lat, lng, (1000 + 500 * (seq % 3)) * 0.009 / 1000 / 2 AS s FROM places WHERE lat IS NOT NULL) q""")
def point_grids(v):
    """A square around each place, its side given in metres, and the place as a point (x, y)."""
    side = (1000 + 500 * (F.col("seq") % 3)) * F.lit(0.009) / 1000 / 2
    corners = [F.format_string("%.6f", c) for c in (F.col("lat") - side, F.col("lng") - side, F.col("lat") + side, F.col("lng") + side)]
    point = F.struct(F.col("lng").alias("x"), F.col("lat").alias("y")).alias("point")
    return v.places.where("lat IS NOT NULL").select("seq", F.concat_ws(",", *corners).alias("rect"), point).select("seq", "rect", "point.x", "point.y")


@query("""WITH d AS (SELECT DISTINCT split_part(address, ' ', 2) AS d FROM places), h AS (SELECT DISTINCT split_part(address, ' ', 2) AS d, split_part(address, ' ', 3) AS h FROM places)
SELECT d, unnest(['서울 ' || d || ' 무한리필', d || ' 고기무한리필', d || ' 무한리필 맛집', d || ' 회식 무한리필', d || ' 가족 무한리필', d || ' 저렴한 무한리필']) AS keyword FROM d
UNION ALL SELECT d, unnest([h || ' 무한리필', h || ' 고기무한리필', h || '역 무한리필']) FROM h""")
def search_keywords(v):
    """Search phrases of each district and of its busy spots."""
    d, h = F.col("d"), F.col("h")
    spots = v.places.select(F.split_part("address", F.lit(" "), F.lit(2)).alias("d"), F.split_part("address", F.lit(" "), F.lit(3)).alias("h")).distinct()
    own = F.array(F.concat(F.lit("서울 "), d, F.lit(" 무한리필")), *[F.concat(d, F.lit(f" {w}")) for w in ("고기무한리필", "무한리필 맛집", "회식 무한리필", "가족 무한리필", "저렴한 무한리필")])
    near = F.array(*[F.concat(h, F.lit(w)) for w in (" 무한리필", " 고기무한리필", "역 무한리필")])
    one = spots.select("d").distinct().select("d", F.explode(own).alias("keyword"))
    return one.unionByName(spots.select("d", F.explode(near).alias("keyword")))


@query("SELECT id, array_to_string(regexp_extract_all(replace(replace(raw, ' ', ''), '.', ''), '[A-Z][a-z]*|[a-z]+'), ',') AS words FROM (SELECT p_partkey AS id, concat('.', upper(left(p_name, 1)), substr(p_name, 2), upper(left(p_type, 1)), lower(substr(p_type, 2))) AS raw FROM part) q")
def selector_words(v):
    """Words of a class selector, cut at capitals."""
    raw = F.concat(F.lit("."), F.upper(F.left("p_name", F.lit(1))), F.expr("substring(p_name, 2)"), F.upper(F.left("p_type", F.lit(1))), F.lower(F.expr("substring(p_type, 2)")))
    found = F.regexp_extract_all(F.replace(F.replace(raw, F.lit(" "), F.lit("")), F.lit("."), F.lit("")), F.lit("[A-Z][a-z]*|[a-z]+"), F.lit(0))
    return v.part.select(F.col("p_partkey").alias("id"), F.array_join(found, ",").alias("words"))


@query("SELECT id, TRY_CAST(nullif(trim(break_time), '') AS DOUBLE) AS a, TRY_CAST(regexp_replace(menu_script, '[^0-9.]', '', 'g') AS DOUBLE) AS b FROM details")
def safe_numbers(v):
    """Texts as numbers; null where a text is none."""
    return v.details.select("id", blank_to_null(F.col("break_time")).try_cast("double").alias("a"), F.regexp_replace("menu_script", "[^0-9.]", "").try_cast("double").alias("b"))
