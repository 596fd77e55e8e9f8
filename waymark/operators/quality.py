"""Rule-based quality checks: issues, scores and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import hours as H
from waymark.functions.columns import blank_to_null, chain, count_where, let, present, total
from waymark.functions.geo import within
from waymark.functions.price import AMOUNT, BAND, CONDITIONS, INQUIRY, RANGES, SINGLES, TIMES, parse_price
from waymark.functions.text import address_part, error_class, find_phone, format_phone, menu_items, normalise_address, plausible_phone, refill_type, repair_phone
from waymark.operators.opening import fill_sql
from waymark.plans.durable import spread, value_at, written
from waymark.plans.registry import query

#: Boxes as (min_lat, max_lat, min_lng, max_lng), severities and their weights.
KOREA = (33.0, 38.6, 124.5, 132.0)
BOXES = {"checks": KOREA, "pages": (33.0, 38.5, 124.0, 132.0), "settings": (33.0, 39.0, 124.0, 132.0), "profile": (33.0, 43.0, 124.0, 132.0)}
DISTRICTS = {"강남구": (37.4979, 37.5279, 127.0276, 127.0576), "마포구": (37.54, 37.57, 126.9, 126.94), "서초구": (37.47, 37.51, 127.0, 127.05)}
FORBIDDEN = {"인천공항": (37.44, 37.47, 126.43, 126.46), "김포공항": (37.55, 37.57, 126.79, 126.81)}
WEIGHTS = {"low": 1, "medium": 3, "high": 7, "critical": 15}


def issue(kind: str, severity: str, fixable: bool) -> Column:
    return F.struct(F.lit(kind).alias("issue_type"), F.lit(severity).alias("severity"), F.lit(fixable).alias("auto_fixable"))


def coordinate_issues(places: DataFrame) -> DataFrame:
    """One row per issue; missing coordinates stop the other rules. A zero coordinate counts as missing."""
    lat, lng, address = F.col("lat"), F.col("lng"), F.coalesce("address", F.lit(""))
    missing = F.coalesce(lat, F.lit(0.0)).eqNullSafe(0.0) | F.coalesce(lng, F.lit(0.0)).eqNullSafe(0.0)
    outside = chain([(address.contains(name), ~within(lat, lng, box)) for name, box in DISTRICTS.items()], F.lit(False))
    airport = F.lit(False)
    for box in FORBIDDEN.values():
        airport = airport | within(lat, lng, box)
    rules = F.array(
        F.when(missing, issue("missing_coordinates", "high", True)),
        F.when(~missing & ~within(lat, lng, KOREA), issue("coordinates_outside_korea", "critical", True)),
        F.when(~missing & outside, issue("address_coordinate_mismatch", "medium", True)),
        F.when(~missing & airport, issue("suspicious_location", "medium", False)),
    )
    found = F.filter(rules, lambda r: r.isNotNull())
    return places.select("place_id", F.explode(found).alias("i")).select("place_id", "i.*")


def quality_score(issues: DataFrame, n_places: Column | int) -> DataFrame:
    """max(0, 100 - weighted issues / (places * 15) * 100), one decimal; 100 without places."""
    weight = chain([(F.col("severity") == s, w) for s, w in WEIGHTS.items()], 1)
    lost = F.coalesce(F.sum(weight), F.lit(0))
    n = F.lit(n_places) if isinstance(n_places, int) else n_places
    return issues.agg(F.when(n == 0, 100.0).otherwise(F.round(F.greatest(F.lit(0.0), 100 - lost / (n * 15) * 100), 1)).alias("score"), lost.alias("lost"))


def _in(box: tuple[float, float, float, float]) -> str:
    return f"lat BETWEEN {box[0]} AND {box[1]} AND lng BETWEEN {box[2]} AND {box[3]}"


ISSUES_SQL = f"""SELECT place_id, 'missing_coordinates' AS issue_type, 'high' AS severity, true AS auto_fixable FROM places WHERE lat IS NULL OR lng IS NULL OR lat = 0 OR lng = 0
UNION ALL SELECT place_id, 'coordinates_outside_korea', 'critical', true FROM places WHERE NOT ({_in(KOREA)})
UNION ALL SELECT place_id, 'address_coordinate_mismatch', 'medium', true FROM places WHERE """ + " OR ".join(
    f"(address LIKE '%{d}%' AND NOT ({_in(b)}))" for d, b in DISTRICTS.items()
) + "\nUNION ALL SELECT place_id, 'suspicious_location', 'medium', false FROM places WHERE " + " OR ".join(f"({_in(b)})" for b in FORBIDDEN.values())


@query(ISSUES_SQL)
def coord_issues(v):
    return coordinate_issues(v.places)


@query("""SELECT round(greatest(0.0, 100 - sum(w) / ((SELECT count(*) FROM places) * 15.0) * 100), 1)::DOUBLE AS score, CAST(sum(w) AS BIGINT) AS lost
FROM (SELECT CASE severity WHEN 'low' THEN 1 WHEN 'medium' THEN 3 WHEN 'high' THEN 7 ELSE 15 END AS w FROM quality_issues) q""")
def place_quality_score(v):
    """The score over all issues, and the weight that it is made from, as the score ends at 0."""
    n = v.places.agg(F.count("*").alias("n"))
    return quality_score(v.quality_issues.crossJoin(F.broadcast(n)), F.max("n"))


@query("""SELECT issue_type, severity, count(*) AS n, count(*) FILTER (WHERE auto_fixed) AS fixed FROM quality_issues GROUP BY issue_type, severity""")
def issue_counts(v):
    return v.quality_issues.groupBy("issue_type", "severity").agg(F.count("*").alias("n"), count_where(F.col("auto_fixed")).alias("fixed"))


@query("""SELECT 'invalid_seoul_coordinates' AS check_name, count(*) AS issue_count FROM places WHERE lat < 37.4 OR lat > 37.7 OR lng < 126.8 OR lng > 127.2
UNION ALL SELECT 'empty_names', count(*) FROM places WHERE name IS NULL OR trim(name) = ''
UNION ALL SELECT 'empty_addresses', count(*) FROM places WHERE address IS NULL OR trim(address) = ''
UNION ALL SELECT 'without_categories', count(*) FROM places p WHERE NOT EXISTS (SELECT 1 FROM place_categories b WHERE b.place_id = p.place_id)
UNION ALL SELECT 'duplicates', count(*) - (SELECT count(*) FROM (SELECT DISTINCT name, address FROM places) d) FROM places""")
def dq_union(v):
    """All checks in one pass over places, then one row per check."""
    linked = v.place_categories.select("place_id").distinct().withColumn("linked", F.lit(True))
    far = ~within(F.col("lat"), F.col("lng"), (37.4, 37.7, 126.8, 127.2))
    one = v.places.join(linked, "place_id", "left").groupBy("name", "address").agg(
        F.count("*").alias("n"), count_where(far).alias("far"), count_where(F.col("linked").isNull()).alias("alone")
    )
    one = one.agg(
        F.sum("far").alias("far"),
        F.sum(F.when(~present(F.col("name")), F.col("n")).otherwise(0)).alias("no_name"),
        F.sum(F.when(~present(F.col("address")), F.col("n")).otherwise(0)).alias("no_address"),
        F.sum("alone").alias("alone"),
        F.sum(F.col("n") - 1).alias("twice"),
    )
    return one.selectExpr(
        "stack(5, 'invalid_seoul_coordinates', far, 'empty_names', no_name, 'empty_addresses', no_address,"
        " 'without_categories', alone, 'duplicates', twice) AS (check_name, issue_count)"
    )


@query("""SELECT CASE WHEN phone IS NULL OR phone = '' THEN 'none' WHEN phone LIKE '07-%' THEN 'broken' WHEN phone LIKE '02-%' THEN 'seoul'
  WHEN phone LIKE '%-%' THEN 'other' ELSE 'bare' END AS pattern, count(*) AS n FROM places GROUP BY 1""")
def phone_profile(v):
    phone = F.col("phone")
    kind = chain(
        [
            (F.coalesce(phone, F.lit("")) == "", F.lit("none")),
            (phone.startswith("07-"), F.lit("broken")),
            (phone.startswith("02-"), F.lit("seoul")),
            (phone.contains("-"), F.lit("other")),
        ],
        F.lit("bare"),
    )
    return v.places.groupBy(kind.alias("pattern")).agg(F.count("*").alias("n"))


def phone_sql(d: str, otherwise: str) -> str:
    """Oracle text of the canonical phone format; d is a bare number whose prefix is whole."""

    def cut(a: int, b: int) -> str:
        return f"substr({d}, 1, {a}) || '-' || substr({d}, {a + 1}, {b}) || '-' || substr({d}, {a + b + 1})"

    return f"""CASE WHEN length({d}) = 11 AND {d} LIKE '010%' THEN {cut(3, 4)}
  WHEN length({d}) = 11 AND ({d} LIKE '0507%' OR {d} LIKE '0508%' OR {d} LIKE '070%') THEN {cut(4, 4)}
  WHEN length({d}) = 10 AND {d} LIKE '02%' THEN {cut(2, 4)} WHEN length({d}) = 10 THEN {cut(3, 3)}
  WHEN length({d}) = 9 AND {d} LIKE '02%' THEN {cut(2, 3)} ELSE {otherwise} END"""


@query(rf"""WITH b AS (SELECT place_id, phone, regexp_replace(replace(phone, '-', ''), '^07(\d{{8}})$', '0507\1') AS d FROM places)
SELECT place_id, {phone_sql('d', 'phone')} AS phone,
  coalesce(length(regexp_replace(coalesce(phone, ''), '[^0-9]', '', 'g')) BETWEEN 9 AND 11, false) AS plausible FROM b""")
def phone_normalise(v):
    return v.places.select("place_id", format_phone(F.col("phone")).alias("phone"), plausible_phone(F.col("phone")).alias("plausible"))


@query("SELECT place_id, regexp_replace(phone, '^07-', '0507-') AS phone FROM places WHERE phone LIKE '07-%'")
def phone_repair(v):
    return v.places.where(F.col("phone").startswith("07-")).select("place_id", repair_phone(F.col("phone")).alias("phone"))


@query(r"""SELECT place_id, regexp_extract(address, '([가-힣]+시|[가-힣]+군|[가-힣]+구)', 1) AS sigungu, regexp_extract(address, '([가-힣]+로|[가-힣]+길)', 1) AS road,
  regexp_extract(address, '([0-9]+(-[0-9]+)?)', 1) AS building, '서울' AS sido, trim(regexp_replace(address, '\s+', ' ', 'g')) AS normalised FROM places""")
def address_components(v):
    a = F.col("address")
    return v.places.select(
        "place_id",
        address_part(a, "sigungu").alias("sigungu"),
        address_part(a, "road").alias("road"),
        address_part(a, "building_number").alias("building"),
        address_part(a, "sido").alias("sido"),
        normalise_address(a).alias("normalised"),
    )


def _below_sql(part: str) -> str:
    """Oracle text: a Korean number below ten thousand, its digits written 0 to 9."""
    units = " + ".join(
        f"CASE WHEN contains({part}, '{u}') THEN coalesce(TRY_CAST(nullif(regexp_extract({part}, '([0-9]*){u}', 1), '') AS BIGINT), 1) * {n} ELSE 0 END" for u, n in (("천", 1000), ("백", 100), ("십", 10))
    )
    return f"({units} + coalesce(TRY_CAST(nullif(regexp_extract({part}, '([0-9]+)$', 1), '') AS BIGINT), 0))"


def _matches_sql(stage: str, pattern: str, group: int, first: bool) -> str:
    """Oracle text: (id, stage, i, s) of the matches of a pattern in t.x."""
    found = f"regexp_extract_all(x, '{pattern}', {group})"
    if first:
        return f"SELECT id, '{stage}' AS stage, 0::BIGINT AS i, ({found})[1] AS s FROM t WHERE len({found}) > 0"
    return f"SELECT id, '{stage}' AS stage, unnest(range(len({found}))) AS i, unnest({found}) AS s FROM t"


_CANDIDATES = " UNION ALL ".join(
    [_matches_sql(f"r{i}{g}", p, g, True) for i, p in enumerate(RANGES) for g in (1, 2)]
    + [_matches_sql(f"t{name}{k}", rf"{w}\s*({AMOUNT})", 1, False) for name, words in TIMES.items() for k, w in enumerate(words)]
    + [_matches_sql(f"c{i}", p, 1, True) for i, p in enumerate(CONDITIONS)] + [_matches_sql(f"s{i}", p, 1, False) for i, p in enumerate(SINGLES)]
)
_TIME_OF = " ".join(f"WHEN stage LIKE 't{name}%' THEN '{name}'" for name in TIMES)


def _slot(stage: str) -> str:
    return f"max(v) FILTER (WHERE stage = '{stage}')"


#: Every candidate of a text as a row with its amount, then the first stage that has a price.
CLEAN_SQL = r"trim(regexp_replace(regexp_replace(trim(price_text), '(가격|요금|비용)\s*:', ' ', 'g'), '\s+', ' ', 'g'))"
STAGES_SQL = rf"""
m AS ({_CANDIDATES}),
n AS (SELECT *, regexp_extract(s, '([0-9]+)만([0-9]+)?천?원?', 1) AS m1, regexp_extract(s, '([0-9]+)만([0-9]+)?천?원?', 2) AS m2,
  translate(regexp_extract(s, '([일이삼사오육칠팔구십백천만억]+)원?', 1), '영일이삼사오육칠팔구', '0123456789') AS k, regexp_extract(replace(regexp_extract(s, '([0-9,]+)원?', 1), ',', ''), '([0-9]{{1,18}})', 1) AS d FROM m),
k AS (SELECT *, regexp_extract(k, '^(.*)억', 1) AS k1, regexp_replace(k, '^.*억', '') AS k2 FROM n), l AS (SELECT *, regexp_extract(k2, '^(.*)만', 1) AS k3, regexp_replace(k2, '^.*만', '') AS k4 FROM k),
a AS (SELECT id, stage, i, s, nullif(CASE WHEN m1 <> '' THEN CAST(m1 AS BIGINT) * 10000 + coalesce(TRY_CAST(nullif(m2, '') AS BIGINT), 0) * 1000
  WHEN k <> '' THEN CASE WHEN contains(k, '억') THEN CASE WHEN k1 = '' THEN 1 ELSE {_below_sql('k1')} END * 100000000 ELSE 0 END + CASE WHEN contains(k2, '만') THEN CASE WHEN k3 = '' THEN 1 ELSE {_below_sql('k3')} END * 10000 ELSE 0 END + {_below_sql('k4')}
  ELSE TRY_CAST(nullif(d, '') AS BIGINT) END, 0) AS v FROM l),
w AS (SELECT id, CASE {_TIME_OF} END AS name, arg_max(v, stage || lpad(CAST(i AS VARCHAR), 6, '0')) AS v FROM a WHERE stage LIKE 't%' AND v IS NOT NULL GROUP BY 1, 2),
times AS (SELECT id, min(v) AS low, max(v) AS high FROM w GROUP BY id),
g AS (SELECT id, {", ".join(f"{_slot(f'r{i}{j}')} AS r{i}{j}" for i in range(len(RANGES)) for j in (1, 2))}, {", ".join(f"{_slot(f'c{i}')} AS c{i}" for i in range(len(CONDITIONS)))},
  count(*) FILTER (WHERE stage LIKE 's%' AND v > 1000) AS many, min(v) FILTER (WHERE stage LIKE 's%' AND v > 1000) AS low, max(v) FILTER (WHERE stage LIKE 's%' AND v > 1000) AS high FROM a GROUP BY id),
b AS (SELECT t.*, g.* EXCLUDE (id), times.low AS tlow, times.high AS thigh, CAST(nullif(regexp_extract(x, '{BAND}', 1), '') AS BIGINT) AS band, CASE WHEN contains(x, '만') THEN 10000 ELSE 1000 END AS unit
  FROM t LEFT JOIN g USING (id) LEFT JOIN times USING (id)),
stage AS (SELECT *, CASE WHEN coalesce(x, '') = '' THEN 'unknown' WHEN regexp_matches(x, '{INQUIRY}') THEN 'inquiry' {" ".join(f"WHEN r{i}1 IS NOT NULL AND r{i}2 IS NOT NULL THEN 'r{i}'" for i in range(len(RANGES)))}
  WHEN band IS NOT NULL THEN 'band' WHEN tlow IS NOT NULL THEN 'time' {" ".join(f"WHEN c{i} IS NOT NULL THEN 'c{i}'" for i in range(len(CONDITIONS)))} WHEN many = 1 THEN 'one' WHEN many > 1 THEN 'many' ELSE 'unknown' END AS st FROM b),
parsed AS (SELECT id, CASE WHEN st IN ('unknown', 'inquiry') THEN st WHEN st LIKE 'r%' OR st IN ('band', 'many') THEN 'range' WHEN st = 'time' THEN 'time_based' WHEN st = 'one' THEN 'single' ELSE 'conditional' END AS price_type,
  CASE st {" ".join(f"WHEN 'r{i}' THEN r{i}1" for i in range(len(RANGES)))} WHEN 'band' THEN band * unit WHEN 'time' THEN tlow {" ".join(f"WHEN 'c{i}' THEN c{i}" for i in range(len(CONDITIONS)))} WHEN 'one' THEN low WHEN 'many' THEN low END AS min_price,
  CASE st {" ".join(f"WHEN 'r{i}' THEN r{i}2" for i in range(len(RANGES)))} WHEN 'band' THEN (band + 1) * unit - 1 WHEN 'time' THEN thigh {" ".join(f"WHEN 'c{i}' THEN c{i}" for i in range(len(CONDITIONS)))} WHEN 'one' THEN high WHEN 'many' THEN high END AS max_price,
  CASE WHEN st = 'unknown' THEN 0.0 WHEN st IN ('inquiry', 'one') OR st LIKE 'r%' THEN 0.9 WHEN st = 'time' THEN 0.85 WHEN st = 'many' THEN 0.7 ELSE 0.8 END::DOUBLE AS confidence FROM stage)"""
PRICE_SQL = f"t AS (SELECT id, {CLEAN_SQL} AS x FROM price_text)," + STAGES_SQL


@query(f"WITH {PRICE_SQL} SELECT id, price_type, CAST(min_price AS BIGINT) AS min_price, CAST(max_price AS BIGINT) AS max_price, confidence FROM parsed")
def price_parse(v):
    return v.price_text.select("id", F.inline(F.array(parse_price(F.col("price_text"))))).drop("condition")


@query(rf"""WITH t AS (SELECT p.id, CASE WHEN price_text <> '' THEN {CLEAN_SQL} || ' ' || raw_menu || ' 특선 ' || (p.id % 40) || ',500원 ' || name ELSE price_text END AS x FROM price_text p JOIN details d ON d.id = p.id),{STAGES_SQL}
SELECT id, price_type, CAST(min_price AS BIGINT) AS min_price, CAST(max_price AS BIGINT) AS max_price, confidence FROM parsed""")
def price_with_menus(v):
    """Prices of texts to which the first three menus are added."""
    special = F.concat(F.lit("특선 "), (F.col("id") % 40).cast("string"), F.lit(",500원"))
    rows = spread(v.price_text.join(v.details.select("id", "raw_menu", "name"), "id"), v.part.count())
    return rows.select("id", F.inline(F.array(parse_price(F.col("price_text"), F.array(F.col("raw_menu"), special, F.col("name"), F.lit("99,000원")))))).drop("condition")


def price_points(prices: DataFrame) -> DataFrame:
    """Lowest price of each row, and its highest where it differs."""
    both = F.array_distinct(F.filter(F.array("min_price", "max_price"), lambda p: p > 0))
    return prices.select(F.explode(both).alias("price"))


@query(f"""WITH {PRICE_SQL},
x AS (SELECT min_price AS price FROM parsed WHERE min_price > 0 UNION ALL SELECT max_price FROM parsed WHERE max_price > 0 AND max_price <> min_price), s AS (SELECT price, row_number() OVER (ORDER BY price) AS r, count(*) OVER () AS n FROM x)
SELECT count(*) AS points, min(price) AS low, max(price) AS high, max(price) FILTER (WHERE r = n // 2 + 1) AS median, round(avg(price), 6) AS mean,
  count(*) FILTER (WHERE price <= 10000) AS to_10k, count(*) FILTER (WHERE price > 10000 AND price <= 20000) AS to_20k,
  count(*) FILTER (WHERE price > 20000 AND price <= 30000) AS to_30k, count(*) FILTER (WHERE price > 30000) AS above FROM s""")
def price_distribution(v):
    """The upper median comes from running counts over ranges of prices."""
    points = price_points(v.price_text.select(F.inline(F.array(parse_price(F.col("price_text"))))))
    counts = written(points.groupBy("price").agg(F.count("*").alias("n")))
    p, n = F.col("price"), F.col("n")
    stats = counts.agg(
        F.sum(n).alias("points"), F.min(p).alias("low"), F.max(p).alias("high"), F.round(F.sum(p * n) / F.sum(n), 6).alias("mean"),
        F.sum(F.when(p <= 10000, n).otherwise(0)).alias("to_10k"), F.sum(F.when((p > 10000) & (p <= 20000), n).otherwise(0)).alias("to_20k"),
        F.sum(F.when((p > 20000) & (p <= 30000), n).otherwise(0)).alias("to_30k"), F.sum(F.when(p > 30000, n).otherwise(0)).alias("above"),
    )
    return stats.withColumn("median", F.lit(value_at(counts, "price", "n", lambda every: every // 2 + 1)).cast("long"))


def _first_of(patterns: tuple[str, ...], text: str) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({text}, '{p}', 1), '')" for p in patterns) + ")"


_BREAK = "coalesce(" + ", ".join(f"CASE WHEN regexp_matches(hours_text, '{p}') THEN regexp_extract(hours_text, '{p}', 1) || '-' || regexp_extract(hours_text, '{p}', 2) END" for p in H.BREAKS) + ")"


def _spans_sql(text: str) -> str:
    """Oracle text: ranges of a text as a list of structs of minutes."""
    ends = [f"regexp_extract_all({text}, '{H.SPAN}', {g})" for g in (1, 2)]
    minute = "CAST(split_part({0}, ':', 1) AS INT) * 60 + CAST(split_part({0}, ':', 2) AS INT)"
    return f"list_transform(list_zip({ends[0]}, {ends[1]}), lambda z: {{'a': {minute.format('z[1]')}, 'b': {minute.format('z[2]')}}})"


@query(f"""SELECT id, {_first_of(H.LAST_ORDERS, 'hours_text')} AS last_order, {_BREAK} AS break_time,
  CASE WHEN hours_text IS NOT NULL THEN array_to_string(list_transform({_spans_sql('hours_text')}, lambda r: r.a || '-' || r.b), ',') END AS ranges FROM hours_text""")
def hours_ranges(v):
    t = F.col("hours_text")
    shown = F.array_join(F.transform(H.ranges(t), lambda r: F.concat_ws("-", r["start"].cast("string"), r["end"].cast("string"))), ",")
    return v.hours_text.select("id", H.last_order(t).alias("last_order"), H.break_time(t).alias("break_time"), shown.alias("ranges"))


@query(rf"""WITH h AS (SELECT id, hours_text, {_spans_sql('hours_text')} AS spans, {_spans_sql(f"coalesce({_BREAK}, '')")} AS breaks,
  regexp_extract_all(hours_text, '(\d{{1,2}}):(\d{{2}})', 1) AS hs, regexp_extract_all(hours_text, '(\d{{1,2}}):(\d{{2}})', 2) AS ms FROM hours_text)
SELECT id, CASE WHEN hours_text IS NOT NULL THEN array_to_string(flatten(list_transform(list_zip(hs, ms), lambda z: list_concat(CASE WHEN CAST(z[1] AS INT) > 24 THEN ['hour ' || z[1]] ELSE [] END, CASE WHEN CAST(z[2] AS INT) > 59 THEN ['minute ' || z[2]] ELSE [] END))), ',') END AS format_issues,
  CASE WHEN hours_text IS NOT NULL THEN array_to_string(list_concat(list_transform(list_filter(spans, lambda r: r.a <> 0 AND r.b <> 0 AND r.a >= r.b AND r.b > 12), lambda r: 'late start ' || r.a || '-' || r.b),
    CASE WHEN len(spans) > 0 THEN list_transform(list_filter(breaks, lambda b: b.a <> 0 AND b.b <> 0 AND len(list_filter(spans, lambda r: r.a <> 0 AND r.b <> 0 AND r.a <= b.a AND b.a <= r.b)) = 0), lambda b: 'break outside ' || b.a || '-' || b.b) ELSE [] END), ',') END AS logic_issues FROM h""")
def hours_issues(v):
    t = F.col("hours_text")
    return v.hours_text.select(
        "id", F.array_join(H.format_issues(t), ",").alias("format_issues"), F.array_join(H.logic_issues(t, H.break_time(t)), ",").alias("logic_issues")
    )


_DATED = r"\d{1,2}월\s*\d{1,2}일\s*\(([월화수목금토일])\)"
_OPEN = r"영업시간\s*[:：]?\s*" + H.SPAN
_TODAY = r"오늘\s*\(([월화수목금토일])\)[^영]*?영업시간\s*[:：]?\s*" + H.SPAN


@query(rf"""WITH days AS (SELECT unnest(range(7)) AS o, unnest(['월', '화', '수', '목', '금', '토', '일']) AS d),
e AS (SELECT id, hours_text AS x, regexp_extract_all(hours_text, '{_DATED}', 1) AS dated, list_transform(list_zip(regexp_extract_all(hours_text, '{_OPEN}', 1), regexp_extract_all(hours_text, '{_OPEN}', 2)), lambda z: z[1] || '-' || z[2]) AS hs,
  CASE WHEN regexp_matches(hours_text, '{_TODAY}') THEN regexp_extract(hours_text, '{_TODAY}', 2) || '-' || regexp_extract(hours_text, '{_TODAY}', 3)
    WHEN regexp_matches(hours_text, '{H.SPAN}') THEN regexp_extract(hours_text, '{H.SPAN}', 1) || '-' || regexp_extract(hours_text, '{H.SPAN}', 2) END AS one FROM hours_text),
p AS (SELECT *, len(list_distinct(hs)) <= 1 AS same FROM e),
z AS (SELECT id, unnest(range(1, 1 + CASE WHEN same THEN len(dated) ELSE least(len(dated), len(hs)) END)) AS i, dated, hs, same FROM p WHERE len(dated) > 0 AND len(hs) > 0),
known AS (SELECT id, dated[i] AS d, arg_max(CASE WHEN same THEN hs[1] ELSE hs[i] END, i) AS h FROM z GROUP BY id, dated[i] UNION ALL
  SELECT id, days.d, one FROM p CROSS JOIN days WHERE NOT (len(dated) > 0 AND len(hs) > 0) AND one IS NOT NULL),
shut AS (SELECT id, d, min(i) AS o FROM (SELECT id, unnest(regexp_extract_all(x, '([월화수목금토일])요일\s*휴무', 1)) AS d, unnest(range(len(regexp_extract_all(x, '([월화수목금토일])요일\s*휴무', 1)))) AS i FROM e) q GROUP BY id, d),
{fill_sql('e')}
SELECT id, (SELECT string_agg(shown.x, ', ' ORDER BY o) FROM shown WHERE shown.id = e.id) || coalesce(' / 라스트오더: ' || {_first_of(H.LAST_ORDERS, 'e.x')}, '') AS open_hours FROM e""")
def hours_render(v):
    t = F.col("hours_text")
    known = v.dealt("hours_text").select("id", H.day_hours(t).alias("h"), H.closed_days(t).alias("c"), H.last_order(t).alias("l"))
    return known.select("id", let(H.fill_days(F.col("h"), F.col("c")), lambda week: H.render(week, F.col("c"), F.col("l"))).alias("open_hours"))


@query("""SELECT id, CAST(CASE WHEN id % 9 = 0 THEN NULL WHEN id % 9 = 1 THEN 0 ELSE 1 END AS BIGINT) AS n_items,
  CASE WHEN id % 9 > 1 THEN json_extract_string(menu_items, '$[0].name') END AS first_name,
  CASE WHEN id % 9 > 1 THEN CAST(json_extract_string(menu_items, '$[0].price_numeric') AS BIGINT) END AS first_price FROM menu_json""")
def menu_json_normalise(v):
    m = v.menu_json.select("id", menu_items(F.col("menu_items")).alias("m"))
    first = F.get("m", F.lit(0))
    return m.select("id", F.size("m").cast("long").alias("n_items"), first["name"].alias("first_name"), first["price_numeric"].cast("long").alias("first_price"))


def completeness(lat: Column, lng: Column, texts: dict[str, float]) -> Column:
    """Weighted share of filled fields: 2 for coordinates, the given weights for texts."""
    located = F.coalesce((lat != 0) & (lng != 0), F.lit(False))
    return F.when(located, 2.0).otherwise(0.0) + total([F.when(F.coalesce(F.col(c), F.lit("")) != "", w).otherwise(0.0) for c, w in texts.items()])


COMPLETENESS = {"name": 1.0, "address": 1.0, "phone": 0.5}


@query("""SELECT place_id, round(CASE WHEN lat <> 0 AND lng <> 0 THEN 2.0 ELSE 0 END + CASE WHEN coalesce(name, '') <> '' THEN 1 ELSE 0 END
  + CASE WHEN coalesce(address, '') <> '' THEN 1 ELSE 0 END + CASE WHEN coalesce(phone, '') <> '' THEN 0.5 ELSE 0 END, 6)::DOUBLE AS score FROM places""")
def completeness_score(v):
    return v.places.select("place_id", F.round(completeness(F.col("lat"), F.col("lng"), COMPLETENESS), 6).alias("score"))


@query("""SELECT place_id, nullif(trim(phone), '') AS phone, nullif(trim(address), '') AS address FROM places""")
def blank_cleanup(v):
    return v.places.select("place_id", blank_to_null(F.col("phone")).alias("phone"), blank_to_null(F.col("address")).alias("address"))


@query("""SELECT id, CASE WHEN contains(t, '고기') OR contains(t, '삼겹살') OR contains(t, '소고기') THEN '고기무한리필' WHEN contains(t, '초밥') OR contains(t, '회') THEN '초밥뷔페'
  WHEN contains(t, '뷔페') THEN '뷔페' WHEN contains(t, '셀프바') THEN '셀프바' ELSE '무한리필' END AS kind FROM (SELECT id, CASE id % 4 WHEN 0 THEN section WHEN 1 THEN raw_menu WHEN 2 THEN regexp_replace(section, '고기|초밥', '', 'g') ELSE name END AS t FROM details) x""")
def refill_kind(v):
    """Type of each text: sections, menus, sections without their first words, plain names."""
    k = F.col("id") % 4
    text = chain([(k == 0, F.col("section")), (k == 1, F.col("raw_menu")), (k == 2, F.regexp_replace("section", "고기|초밥", ""))], F.col("name"))
    return v.details.select("id", refill_type(text).alias("kind"))


@query("""SELECT CASE WHEN lower(error_message) LIKE '%no such element%' THEN 'selector_missing' WHEN lower(error_message) LIKE '%timeout%' THEN 'timeout'
  WHEN lower(error_message) LIKE '%forbidden%' THEN 'ip_blocked' WHEN lower(error_message) LIKE '%rate limit%' THEN 'rate_limit' ELSE 'unknown' END AS error_class,
  count(*) AS n, round(count(*) * 1.0 / sum(count(*)) OVER (), 6) AS share FROM failures GROUP BY 1""")
def failure_patterns(v):
    counts = v.failures.groupBy(error_class(F.col("error_message")).alias("error_class")).agg(F.count("*").alias("n"))
    every = v.failures.agg(F.count("*").alias("every"))
    return counts.crossJoin(F.broadcast(every)).select("error_class", "n", F.round(F.col("n") / F.col("every"), 6).alias("share"))


@query(rf"""WITH f AS (SELECT page_id, coalesce(nullif(regexp_extract(html, '(0\d{{1,2}}-\d{{3,4}}-\d{{4}})', 1), ''), nullif(regexp_extract(html, '(0\d{{9,10}})', 1), ''),
  nullif(regexp_extract(html, '(\d{{3}}-\d{{3,4}}-\d{{4}})', 1), '')) AS p FROM pages),
b AS (SELECT page_id, p, regexp_replace(regexp_replace(replace(p, '-', ''), '^07(\d{{8}})$', '0507\1'), '^08(\d{{8}})$', '0508\1') AS d FROM f WHERE p IS NOT NULL)
SELECT page_id, {phone_sql('d', 'p')} AS phone FROM b""")
def page_phones(v):
    """First phone number of each page that has one."""
    return v.pages.select("page_id", find_phone(F.col("html")).alias("phone")).where("phone IS NOT NULL")
