"""Single fields of records: where a theme is mentioned, failed selectors, menus in scripts, cache figures, clean-up counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.category import KEYWORDS, NO_CATEGORY, map_many
from waymark.functions.columns import chain, extract, present
from waymark.operators.details import JS_LEAST, JS_MOST, RELEVANT_WORDS, listed, mentions
from waymark.operators.logs import BLOCK_WORDS, is_blocked
from waymark.operators.migrate import PAIRS_MANY
from waymark.plans.durable import written
from waymark.plans.registry import query

#: Answers of a host that blocks, and what a cache's hits are worth.
BLOCK_CODES = (403, 429, 503)
NETWORK_SHARE, EFFICIENT_RATE, LOW_RATE, GOOD_RATE = 0.8, 50, 30, 80


def relevance(search: Column, name: Column, categories: Column, description: Column) -> Column:
    """Where a word of the theme is found first: query, name, category, description; null where nowhere. Nulls hold none."""
    theme = "|".join(RELEVANT_WORDS)
    in_categories = F.exists(F.coalesce(categories, F.array().cast("array<string>")), lambda c: F.coalesce(c.rlike(theme), F.lit(False)))
    return chain([(mentions(search, RELEVANT_WORDS), F.lit("query")), (mentions(name, RELEVANT_WORDS), F.lit("name")), (in_categories, F.lit("category")), (mentions(description, RELEVANT_WORDS), F.lit("description"))])


_THEME = "|".join(RELEVANT_WORDS)


@query(f"""SELECT d.id, CASE WHEN regexp_matches(CASE WHEN d.id % 7 = 0 THEN '강남 무한리필' ELSE '강남 맛집' END, '{_THEME}') THEN 'query' WHEN regexp_matches(coalesce(raw_menu, ''), '{_THEME}') THEN 'name'
  WHEN regexp_matches(coalesce(r.raw, ''), '{_THEME}') THEN 'category' WHEN regexp_matches(coalesce(section, ''), '{_THEME}') THEN 'description' END AS found_in FROM details d LEFT JOIN raw_categories r ON r.place_id = CAST(d.id AS VARCHAR)""")
def relevance_source(v):
    """Which part of a record shows that it belongs to the theme."""
    raw = v.raw_categories.select("place_id", F.split("raw", " ").alias("categories"))
    rows = v.details.join(raw, F.col("place_id") == F.col("id").cast("string"), "left")
    asked = F.when(F.col("id") % 7 == 0, "강남 무한리필").otherwise("강남 맛집")
    return rows.select("id", relevance(asked, F.col("raw_menu"), F.col("categories"), F.col("section")).alias("found_in"))


def failed_selector(failures: DataFrame) -> DataFrame:
    """(selector, n, confidence): the selector that most messages name, its count, and its share of all failures; of equal
    counts the one first seen. No row if no message names one."""
    named = failures.select("ts", "event_id", extract(F.col("error_message"), r"selector:(\S+)").alias("selector"))
    every = failures.agg(F.count("*").alias("every"))
    counts = named.where("selector IS NOT NULL").groupBy("selector").agg(F.count("*").alias("n"), F.min(F.struct("ts", "event_id")).alias("first"))
    best = counts.orderBy(F.desc("n"), "first").limit(1)
    return best.crossJoin(F.broadcast(every)).select("selector", "n", F.round(F.col("n") / F.col("every"), 6).alias("confidence"))  # one row each


@query(r"""WITH n AS (SELECT regexp_extract(error_message, 'selector:(\S+)', 1) AS selector, ts, event_id FROM selector_failures)
SELECT selector, count(*) AS n, round(count(*) * 1.0 / (SELECT count(*) FROM selector_failures), 6)::DOUBLE AS confidence FROM n WHERE selector <> '' GROUP BY selector ORDER BY n DESC, min((ts, event_id)) LIMIT 1""")
def changed_selector(v):
    return failed_selector(v.selector_failures)


@query(r"""SELECT selector, array_to_string(regexp_extract_all(replace(selector, '.', ''), '[A-Z][a-z]*|[a-z]+'), ',') AS words, count(*) AS n
FROM (SELECT regexp_extract(error_message, 'selector:(\S+)', 1) AS selector FROM selector_failures) s WHERE contains(selector, '.') GROUP BY 1, 2""")
def failed_selector_words(v):
    """Words of the class selectors that failed, cut at capitals, and how often each selector did."""
    named = v.selector_failures.select(extract(F.col("error_message"), r"selector:(\S+)").alias("selector")).where(F.col("selector").contains("."))
    words = F.regexp_extract_all(F.replace("selector", F.lit("."), F.lit("")), F.lit("[A-Z][a-z]*|[a-z]+"), F.lit(0))
    return named.groupBy("selector").agg(F.count("*").alias("n")).select("selector", F.array_join(words, ",").alias("words"), "n")


SCRIPT_MENU = "array<struct<menu:struct<list:array<struct<menu:string,price:string,best:bigint>>>>>"


def script_menu(script: Column) -> Column:
    """Array of struct(price_numeric, place, name, price, recommended) of the menu that a script assigns to aData, cheapest
    first, prices from 5,000 to 100,000; the first number of a price counts. Null where there is no such menu."""
    data = F.from_json(extract(script, r"(?s)aData\s*=\s*(\[.*?\]);"), SCRIPT_MENU)
    items = F.get(data, F.lit(0))["menu"]["list"]

    def item(x: Column, i: Column) -> Column:
        price = F.trim(x["price"])
        amount = F.replace(extract(price, r"(\d{1,3}(?:,\d{3})*)"), F.lit(","), F.lit("")).try_cast("long")
        return F.struct(amount.alias("price_numeric"), i.alias("place"), F.trim(x["menu"]).alias("name"), price.alias("price"), F.coalesce(x["best"] == 1, F.lit(False)).alias("recommended"))

    good = F.filter(F.transform(items, item), lambda x: present(x["name"]) & present(x["price"]) & x["price_numeric"].between(JS_LEAST, JS_MOST))
    return F.array_sort(good)


@query(rf"""WITH j AS (SELECT id, regexp_extract(script, 'aData\s*=\s*(\[.*?\]);', 1, 's') AS t FROM script_menus), x AS (SELECT id, CAST(json_extract(CASE WHEN json_valid(t) THEN t END, '$[0].menu.list') AS JSON[]) AS l FROM j),
u AS (SELECT id, unnest(l) AS e, unnest(range(len(l))) AS place FROM x),
m AS (SELECT id, place, trim(e->>'$.menu') AS name, trim(e->>'$.price') AS price, coalesce(e->>'$.best', '0') = '1' AS recommended FROM u),
n AS (SELECT *, TRY_CAST(replace(regexp_extract(price, '(\d{{1,3}}(?:,\d{{3}})*)', 1), ',', '') AS BIGINT) AS amount FROM m WHERE name <> '' AND price <> '')
SELECT id, row_number() OVER (PARTITION BY id ORDER BY amount, place) - 1 AS rank, name, price, amount AS price_numeric, recommended FROM n WHERE amount BETWEEN {JS_LEAST} AND {JS_MOST}""")
def script_menu_items(v):
    found = v.script_menus.select("id", F.posexplode(script_menu(F.col("script"))).alias("rank", "x"))
    return found.select("id", F.col("rank").cast("long").alias("rank"), "x.name", "x.price", "x.price_numeric", "x.recommended")


@query(f"""WITH s AS (SELECT user_id, count(*) AS requests, count(*) FILTER (WHERE event_type = 'view') AS hits FROM events GROUP BY user_id), r AS (SELECT *, hits * 100.0::DOUBLE / requests AS rate FROM s)
SELECT user_id, requests, hits, requests - hits AS misses, round(rate, 6) AS hit_rate, round(rate, 6) AS network_saved, round(rate * {NETWORK_SHARE}::DOUBLE, 6) AS time_saved, CASE WHEN rate > {EFFICIENT_RATE} THEN 'Optimized' ELSE 'Needs Improvement' END AS efficiency,
  CASE WHEN rate < {LOW_RATE} THEN 'low' WHEN rate > {GOOD_RATE} THEN 'good' END AS advice FROM r""")
def cache_report(v):
    """Hit rate of each key's requests, and what is derived from it."""
    hits = F.count_if(F.col("event_type") == "view")
    rate = F.col("hits") * 100.0 / F.col("requests")
    counts = v.events.groupBy("user_id").agg(F.count("*").alias("requests"), hits.alias("hits"))
    return counts.select(
        "user_id", "requests", "hits", (F.col("requests") - F.col("hits")).alias("misses"), F.round(rate, 6).alias("hit_rate"), F.round(rate, 6).alias("network_saved"), F.round(rate * NETWORK_SHARE, 6).alias("time_saved"),
        F.when(rate > EFFICIENT_RATE, "Optimized").otherwise("Needs Improvement").alias("efficiency"), F.when(rate < LOW_RATE, "low").when(rate > GOOD_RATE, "good").alias("advice"),
    )


def blocked_answer(message: Column, code: Column) -> Column:
    """Whether an answer's message or code says that the host blocks."""
    return is_blocked(message) | F.coalesce(code.isin(*BLOCK_CODES), F.lit(False))


_BLOCKED = " OR ".join(f"contains(lower(error_message), '{w}')" for w in BLOCK_WORDS)


@query(f"""SELECT code, count(*) AS n, count(*) FILTER (WHERE {_BLOCKED} OR code IN (403, 429, 503)) AS blocked FROM selector_failures GROUP BY code""")
def blocked_by_code(v):
    return v.selector_failures.groupBy("code").agg(F.count("*").alias("n"), F.count_if(blocked_answer(F.col("error_message"), F.col("code"))).alias("blocked"))


def cleanup_counts(rows: DataFrame, texts: list[str], lists: list[str]) -> DataFrame:
    """(field, cleaned): how many blank texts and empty lists of each field a clean-up turns to null, in one pass."""
    counts = [F.count_if(F.col(c).isNotNull() & (F.trim(c) == "")).alias(c) for c in texts] + [F.count_if(F.size(c) == 0).alias(c) for c in lists]
    one = rows.agg(*counts)
    names = [*texts, *lists]
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("cleaned")) for c in names])).alias("x")).select("x.*")


@query("""WITH d AS (SELECT open_hours, break_time, raw_menu, CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN [] ELSE [name] END AS refill_items FROM details)
SELECT 'open_hours' AS field, count(*) FILTER (WHERE trim(open_hours) = '') AS cleaned FROM d UNION ALL SELECT 'break_time', count(*) FILTER (WHERE trim(break_time) = '') FROM d
UNION ALL SELECT 'raw_menu', count(*) FILTER (WHERE trim(raw_menu) = '') FROM d UNION ALL SELECT 'refill_items', count(*) FILTER (WHERE len(refill_items) = 0) FROM d""")
def cleanup_report(v):
    k = F.col("id") % 5
    rows = v.details.withColumn("refill_items", F.when(k == 0, F.lit(None)).when(k == 1, F.array().cast("array<string>")).otherwise(F.array("name")))
    return cleanup_counts(rows, ["open_hours", "break_time", "raw_menu"], ["refill_items"])


def merged_lists(rows: DataFrame, groups: DataFrame, fields: list[str]) -> DataFrame:
    """(seed, *fields): for each group the distinct values of its members' list fields, sorted; null where no member has a list.

    Values are made distinct before they are gathered, so copies do not add up.
    """
    members = groups.select("seed", F.col("member").alias("seq")).join(rows.select("seq", *fields), "seq")
    long = members.select("seed", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("every")) for f in fields])).alias("x"))
    values = long.select("seed", "x.field", F.explode("x.every").alias("value")).distinct()
    gathered = values.groupBy("seed").agg(*[F.array_sort(F.collect_list(F.when(F.col("field") == f, F.col("value")))).alias(f) for f in fields])
    seeds = groups.select("seed").distinct()
    return seeds.join(gathered, "seed", "left").select("seed", *[F.when(F.size(f) > 0, F.col(f)).alias(f) for f in fields])


@query(r"""WITH g AS (SELECT min(seq) OVER (PARTITION BY name, address) AS seed, seq, CAST(seq AS VARCHAR) AS place_id FROM places),
v AS (SELECT DISTINCT seed, unnest(string_split(raw, ' ')) AS x FROM g JOIN raw_categories USING (place_id) WHERE raw <> ''), i AS (SELECT DISTINCT seed, unnest(['https://i/' || seq % 40, 'https://j/' || seed]) AS x FROM g)
SELECT s.seed, (SELECT string_agg(x, '|' ORDER BY x) FROM v WHERE v.seed = s.seed) AS categories, (SELECT string_agg(x, '|' ORDER BY x) FROM i WHERE i.seed = s.seed) AS images FROM (SELECT DISTINCT seed FROM g) s""")
def golden_lists(v):
    """List fields of the places of one name and address, as one."""
    firsts = v.places.groupBy("name", "address").agg(F.min("seq").alias("seed"))
    rows = v.places.join(firsts, ["name", "address"]).join(v.raw_categories, "place_id")
    images = F.array(F.concat(F.lit("https://i/"), (F.col("seq") % 40).cast("string")), F.concat(F.lit("https://j/"), F.col("seed").cast("string")))
    rows = written(rows.select("seq", "seed", F.when(F.col("raw") != "", F.split("raw", " ")).alias("categories"), images.alias("images")))
    out = merged_lists(rows.drop("seed"), rows.select("seed", F.col("seq").alias("member")), ["categories", "images"])
    return out.select("seed", F.array_join("categories", "|").alias("categories"), F.array_join("images", "|").alias("images"))


def mined_categories(raw: Column, name: Column, menus: Column) -> Column:
    """Sorted standard categories by keywords in the raw words, in the name and in the first five menus; the default if none."""
    more = F.array_compact(F.concat(F.array(name), F.slice(F.coalesce(menus, F.array().cast("array<string>")), 1, 5)))
    pairs = F.array(*[F.struct(F.lit(k).alias("word"), F.lit(c).alias("category")) for c, ks in KEYWORDS.items() for k in ks])
    found = F.flatten(F.transform(more, lambda t: F.transform(F.filter(pairs, lambda e: F.contains(t, e["word"])), lambda e: e["category"])))
    own = F.when(F.size(raw) > 0, map_many(raw))
    none = F.array().cast("array<string>")
    # the default of the raw words stands only if nothing else is found
    clean = F.transform(raw, lambda t: F.lower(F.trim(F.replace(t, F.lit("#")))))
    hit = F.exists(clean, lambda t: t.isNotNull() & ~t.rlike(NO_CATEGORY) & F.exists(pairs, lambda e: F.contains(t, e["word"])))
    both = F.array_sort(F.array_distinct(F.concat(F.when(F.coalesce(hit, F.lit(False)), own).otherwise(none), found)))
    return F.when(F.coalesce(F.size(raw), F.lit(0)) <= 0, F.array(F.lit("한식"))).when(F.size(both) > 0, both).otherwise(F.array(F.lit("한식")))


@query(f"""WITH d(k, c) AS (VALUES {", ".join(f"('{k}', '{c}')" for k, c in PAIRS_MANY)}), r AS (SELECT r.place_id, lower(trim(replace(raw, '#', ''))) AS t, x.raw_menu AS n, x.section AS s FROM raw_categories r JOIN details x ON r.place_id = CAST(x.id AS VARCHAR)),
m AS (SELECT place_id, c FROM r JOIN d ON contains(t, k) WHERE t <> '' AND NOT regexp_matches(t, '{NO_CATEGORY}') UNION SELECT place_id, c FROM r JOIN d ON t <> '' AND (contains(n, k) OR contains(s, k)))
SELECT r.place_id, coalesce((SELECT string_agg(c, ',' ORDER BY c) FROM m WHERE m.place_id = r.place_id), '한식') AS categories FROM r""")
def category_map_mined(v):
    """Categories by raw words, names and menus."""
    rows = v.raw_categories.join(v.details.select(F.col("id").cast("string").alias("place_id"), "raw_menu", "section"), "place_id")
    raw = F.when(F.col("raw") != "", F.array("raw"))
    return rows.select("place_id", F.array_join(mined_categories(raw, F.col("raw_menu"), F.array("section")), ",").alias("categories"))


@query("SELECT DISTINCT name, address, phone, status, refill_type, nation_id, is_confirmed, src_rating FROM places WHERE seq % 2 = 0 OR seq % 3 = 0")
def distinct_places(v):
    """Rows that differ in one of eight columns."""
    columns = ["name", "address", "phone", "status", "refill_type", "nation_id", "is_confirmed", "src_rating"]
    rows = v.places.where("seq % 2 = 0").unionByName(v.places.where("seq % 3 = 0"))
    return rows.select(*columns).distinct()
