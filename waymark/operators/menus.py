"""Menus mined from texts by ordered patterns, problems of opening hours as issues, links by name, search on the ellipsoid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import hours as H
from waymark.functions.category import NO_CATEGORY, map_many
from waymark.functions.columns import let, present
from waymark.functions.geo import geodesic_box, geodesic_m, geodesic_sql
from waymark.operators.details import ALL_DAY_WORDS, MENU_LEAST, MENU_MOST, listed, mentions
from waymark.operators.migrate import PAIRS_MANY
from waymark.operators.search import CENTRE
from waymark.plans.durable import small_side
from waymark.plans.registry import query

#: Patterns of a name and its price in the order in which they are tried, and words that names must not hold.
PRICED = (
    r"([a-z]\s+[가-힣\s\w()]+?(?:무한리필|뷔페|셀프바)[가-힣\s\w()]*?(?:추천|할인)?)\s*\n?\s*(\d{1,3}(?:,\d{3})*)\s*원",
    r"([가-힣\s\w()]+?(?:평일|주말|공휴일|이전|이후|저녁|점심|오전|오후)[가-힣\s\w()]*?(?:추천|할인|무한리필|입장기준))\s*(\d{1,3}(?:,\d{3})*)\s*원",
    r"([가-힣\s\w()]+?(?:초등|미취학|성인|어린이|학생)[가-힣\s\w()]*?(?:추천|할인|무한리필))\s*(\d{1,3}(?:,\d{3})*)\s*원",
    r"([가-힣\s\w()]+?(?:무한리필|뷔페|셀프바)[가-힣\s\w()]*?(?:추천|할인)?)\s*(\d{1,3}(?:,\d{3})*)\s*원",
    r"([가-힣\s\w()]+?(?:추천|할인|무한리필|입장기준))\s*[:：]\s*(\d{1,3}(?:,\d{3})*)\s*원",
    r"([가-힣\s\w()]+?(?:추천|할인|무한리필|입장기준))\s*\n\s*(\d{1,3}(?:,\d{3})*)\s*원",
)
PRICED_TABLE = (
    r"([가-힣\s\w()]+?(?:추천|할인|무한리필|입장기준))\s+(\d{1,3}(?:,\d{3})*)\s*원",
    r"([가-힣\s\w()]+?(?:추천|할인|무한리필|입장기준))\s*-\s*(\d{1,3}(?:,\d{3})*)\s*원",
)
MENU = (
    r"(?:[a-z])\s+([가-힣\s\w()]+?(?:무한리필|뷔페|셀프바)[가-힣\s\w()]*?(?:추천|할인)?)\s*(\d{1,3}(?:,\d{3})*)\s*원",
    r"([가-힣\s\w()]+?(?:무한리필|뷔페|셀프바)[가-힣\s\w()]*?(?:추천|할인)?)\s+(\d{1,3}(?:,\d{3})*)\s*원",
    r"([가-힣\s\w()]*?(?:무한리필|뷔페|셀프바)[가-힣\s\w()]*?(?:추천|할인)?)\s*\n\s*(\d{1,3}(?:,\d{3})*)\s*원",
    r"([가-힣\s\w()]*?(?:평일|주말|점심|저녁|오전|오후)[가-힣\s\w()]*?(?:무한리필|뷔페|셀프바)[가-힣\s\w()]*?)\s*(\d{1,3}(?:,\d{3})*)\s*원",
    r"([가-힣\s\w()]*?(?:성인|어린이|초등|중등|고등|학생)[가-힣\s\w()]*?(?:무한리필|뷔페|셀프바)[가-힣\s\w()]*?)\s*(\d{1,3}(?:,\d{3})*)\s*원",
)
NAMED = r"[가-힣\s\w()]"
NOT_IN_NAMES = ("리뷰", "후기", "평점", "별점", "방문", "블로그")
LONGEST_PRICED, LONGEST_MENU = 50, 30


def pinned(pattern: str) -> str:
    """The pattern, tried only where a match can begin: behind the last match, or where no character of names stands before.

    Names begin with a lazy run of such characters. Whatever matches from inside a run matches from the place before, too,
    so a leftmost match begins nowhere else, and a run without a price is scanned once instead of from each of its characters.
    """
    return rf"(?:\G|(?<!{NAMED})){pattern}" if pattern.startswith(f"({NAMED}") else pattern


def _found(text: Column, patterns: tuple[str, ...], flags: str, offset: int = 0) -> list[Column]:
    """For each pattern its matches as an array of struct(stage, name, price), names without a leading single letter."""
    out = []
    for stage, pattern in enumerate(patterns, offset):
        names, prices = (F.regexp_extract_all(text, F.lit(flags + pinned(pattern)), F.lit(g)) for g in (1, 2))

        out.append(F.zip_with(names, prices, _item(stage)))
    return out


def _item(stage: int):
    def item(name: Column, price: Column) -> Column:
        clean = F.regexp_replace(F.regexp_replace(name, r"(?U)^\s+|\s+$", ""), r"(?U)^[a-z]\s+", "")
        return F.struct(F.lit(stage).alias("stage"), clean.alias("name"), F.replace(price, F.lit(","), F.lit("")).try_cast("long").alias("price"))

    return item


def _chosen(found: list[Column], longest: int, always: int) -> Column:
    """Items with a name of 3 to `longest` characters and a price in range, by price, then place. Of the stages from
    `always` on an item stays only if none before it has its name."""
    items = F.transform(F.concat(*found), lambda x, i: F.struct(x["name"].alias("name"), i.alias("place"), x["stage"].alias("stage"), x["price"].alias("price")))
    good = F.filter(items, lambda x: F.char_length(x["name"]).between(3, longest) & x["price"].between(MENU_LEAST, MENU_MOST))

    def kept(named: Column) -> Column:
        # sorted by name and place, the first of a name is the one whose neighbour has another
        marked = F.transform(named, lambda x, i: F.struct(
            x["price"].alias("price"), x["place"].alias("place"), x["name"].alias("name"), ((x["stage"] < always) | (i == 0) | (F.get(named, i - 1)["name"] != x["name"])).alias("stays")
        ))
        return F.transform(F.array_sort(F.filter(marked, lambda x: x["stays"])), lambda x: F.struct(x["name"].alias("name"), x["price"].alias("price")))

    return let(F.array_sort(good), kept)


def refill_prices(text: Column) -> Column:
    """Array of struct(name, price): priced items of a text by eight patterns, cheapest first. What the first six find all
    counts, repeats as well, but for names with words of reviews; the last two add only new names. Null gives null."""
    plain = [F.filter(f, lambda x: ~x["name"].rlike("|".join(NOT_IN_NAMES))) for f in _found(text, PRICED, "(?Uui)")]
    return _chosen(plain + _found(text, PRICED_TABLE, "(?U)", len(PRICED)), LONGEST_PRICED, len(PRICED))


def clean_menu(text: Column) -> Column:
    """Array of struct(name, price): items of a text by five patterns, each name once (as found first), cheapest first."""
    squeezed = [F.transform(f, lambda x: F.struct(x["stage"].alias("stage"), F.regexp_replace(x["name"], r"(?U)\s+", " ").alias("name"), x["price"].alias("price"))) for f in _found(text, MENU, "(?Uui)")]
    return _chosen(squeezed, LONGEST_MENU, 0)


def _menu_sql(patterns: tuple[str, ...], flags: str, offset: int, where: str = "true", squeeze: bool = False) -> str:
    """Oracle text: rows (id, stage, i, name, price) of the matches of patterns in m.t."""
    parts = []
    for stage, p in enumerate(patterns, offset):
        q = flags + p.replace(r"\w", r"\p{L}\p{N}_")
        name = r"regexp_replace(regexp_replace(unnest(regexp_extract_all(t, '" + q + r"', 1)), '^\s+|\s+$', '', 'g'), '^[a-z]\s+', '')"
        name = rf"regexp_replace({name}, '\s+', ' ', 'g')" if squeeze else name
        parts.append(f"SELECT id, {stage} AS stage, unnest(range(len(regexp_extract_all(t, '{q}', 1)))) AS i, {name} AS name, CAST(replace(unnest(regexp_extract_all(t, '{q}', 2)), ',', '') AS BIGINT) AS price FROM menu_texts")
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) u WHERE {where}"


def _listed_sql(every: str, longest: int, always: int) -> str:
    return f"""WITH e AS ({every}), g AS (SELECT *, row_number() OVER (PARTITION BY id, name ORDER BY stage, i) AS r FROM e WHERE length(name) BETWEEN 3 AND {longest} AND price BETWEEN {MENU_LEAST} AND {MENU_MOST})
SELECT m.id, coalesce((SELECT string_agg(name || '=' || price, '|' ORDER BY price, stage, i) FROM g WHERE g.id = m.id AND (stage < {always} OR r = 1)), '') AS items FROM menu_texts m"""


def _shown(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat_ws("=", x["name"], x["price"].cast("string"))), "|")


_PLAIN = f"NOT regexp_matches(name, '{'|'.join(NOT_IN_NAMES)}')"


@query(_listed_sql(_menu_sql(PRICED, "(?i)", 0, _PLAIN) + " UNION ALL " + _menu_sql(PRICED_TABLE, "", len(PRICED)), LONGEST_PRICED, len(PRICED)))
def refill_price_items(v):
    return v.dealt("menu_texts").select("id", F.coalesce(_shown(refill_prices(F.col("t"))), F.lit("")).alias("items"))


@query(_listed_sql(_menu_sql(MENU, "(?i)", 0, squeeze=True), LONGEST_MENU, 0))
def clean_menu_items(v):
    return v.dealt("menu_texts").select("id", F.coalesce(_shown(clean_menu(F.col("t"))), F.lit("")).alias("items"))


def hours_problems(rows: DataFrame, key: str = "id") -> DataFrame:
    """(key, issue_type, severity, description, auto_fixable), one row per problem of open_hours, break_time and last_order:
    numbers that are no time, ranges that end before they start, breaks outside, and a claim of being always open next to a
    break or a last order. Rows without hours have no problems."""
    text, pause = F.col("open_hours"), F.coalesce("break_time", F.lit(""))

    def issues(kind: str, severity: str, fixable: bool, descriptions: Column) -> Column:
        return F.transform(descriptions, lambda d: F.struct(F.lit(kind).alias("issue_type"), F.lit(severity).alias("severity"), d.alias("description"), F.lit(fixable).alias("auto_fixable")))

    always = mentions(text, ALL_DAY_WORDS) & (present(F.col("break_time")) | present(F.col("last_order")))
    conflict = F.when(always, F.array(F.lit("always open, with a break or a last order"))).otherwise(F.array().cast("array<string>"))
    every = F.concat(
        issues("invalid_time_format", "low", True, H.format_issues(text)), issues("business_hours_logic_error", "medium", False, H.logic_issues(text, pause)),
        issues("24hour_conflict", "medium", False, conflict),
    )
    return rows.where(present(text)).select(key, F.explode(every).alias("i")).select(key, "i.*")


_MINUTES = "CAST(split_part({0}, ':', 1) AS INT) * 60 + CAST(split_part({0}, ':', 2) AS INT)"


def _ranges_sql(text: str) -> str:
    a, b = (f"unnest(regexp_extract_all({text}, '{H.SPAN}', {g}))" for g in (1, 2))
    return f"SELECT id, a, b FROM (SELECT id, {_MINUTES.format('x')} AS a, {_MINUTES.format('y')} AS b FROM (SELECT id, {a} AS x, {b} AS y FROM h) p) q"


@query(rf"""WITH h AS (SELECT id, open_hours, coalesce(break_time, '') AS pause, last_order FROM hours_rows WHERE trim(open_hours) <> ''),
n AS (SELECT id, unnest(regexp_extract_all(open_hours, '(\d{{1,2}}):(\d{{2}})', 1)) AS hour, unnest(regexp_extract_all(open_hours, '(\d{{1,2}}):(\d{{2}})', 2)) AS minute FROM h), o AS ({_ranges_sql('open_hours')}), b AS ({_ranges_sql('pause')})
SELECT id, 'invalid_time_format' AS issue_type, 'low' AS severity, 'hour ' || hour AS description, true AS auto_fixable FROM n WHERE CAST(hour AS INT) > 24 UNION ALL SELECT id, 'invalid_time_format', 'low', 'minute ' || minute, true FROM n WHERE CAST(minute AS INT) > 59
UNION ALL SELECT id, 'business_hours_logic_error', 'medium', 'late start ' || a || '-' || b, false FROM o WHERE a <> 0 AND b <> 0 AND a >= b AND b > 12
UNION ALL SELECT id, 'business_hours_logic_error', 'medium', 'break outside ' || a || '-' || b, false FROM b WHERE a <> 0 AND b <> 0 AND id IN (SELECT id FROM o) AND NOT EXISTS (SELECT 1 FROM o WHERE o.id = b.id AND o.a <> 0 AND o.b <> 0 AND b.a BETWEEN o.a AND o.b)
UNION ALL SELECT id, '24hour_conflict', 'medium', 'always open, with a break or a last order', false FROM h WHERE len(list_filter({listed(ALL_DAY_WORDS)}, lambda w: contains(open_hours, w))) > 0 AND (trim(pause) <> '' OR trim(last_order) <> '')""")
def hours_problem_rows(v):
    return hours_problems(v.hours_rows)


def named_links(named: DataFrame, categories: DataFrame) -> DataFrame:
    """(place_id, category_id), once each, of rows (place_id, names): a link for every name that the categories have."""
    names = named.select("place_id", F.explode("names").alias("name")).distinct()
    return names.join(small_side(categories.select("name", F.col("id").alias("category_id"))), "name").select("place_id", "category_id").distinct()


@query(f"""WITH d(k, c) AS (VALUES {", ".join(f"('{k}', '{c}')" for k, c in PAIRS_MANY)}), r AS (SELECT place_id, lower(trim(replace(raw, '#', ''))) AS t FROM raw_categories),
m AS (SELECT place_id, c FROM r JOIN d ON contains(t, k) WHERE NOT regexp_matches(t, '{NO_CATEGORY}')), a AS (SELECT place_id, coalesce(c, '한식') AS c FROM r LEFT JOIN m USING (place_id))
SELECT DISTINCT place_id, id AS category_id FROM a JOIN categories ON name = c""")
def mapped_links(v):
    """Links of places with the categories that their raw words map to, by name."""
    return named_links(v.raw_categories.select("place_id", map_many(F.array("raw")).alias("names")), v.categories)


NEAR_M = 8_000.0


@query(f"""WITH RECURSIVE pts AS (SELECT place_id AS id, CAST({CENTRE[0]} AS DOUBLE) AS lat1, CAST({CENTRE[1]} AS DOUBLE) AS lng1, lat AS lat2, lng AS lng2 FROM places WHERE lat IS NOT NULL AND lng IS NOT NULL), {geodesic_sql('pts')}
SELECT id AS place_id, round(metres, 3) AS metres FROM geo WHERE metres <= {NEAR_M}""")
def nearby_geodesic(v):
    """Places within 8 km on the ellipsoid; a box that holds the circle is tested at the scan."""
    lat, lng = F.col("lat"), F.col("lng")
    near = v.places.where(geodesic_box(lat, lng, CENTRE, NEAR_M)).select("place_id", geodesic_m(F.lit(CENTRE[0]), F.lit(CENTRE[1]), lat, lng).alias("m"))
    return near.where(F.col("m") <= NEAR_M).select("place_id", F.round("m", 3).alias("metres"))
