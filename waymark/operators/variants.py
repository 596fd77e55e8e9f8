"""Fields of crawled records as three migrations make them: descriptions, prices, images; and menus kept as entries.

Each variant has its own rule; `full`, `short` and `plain` name them. A field counts as there if it is not null and not
empty; blanks count as text, as they do in the results that have to be matched.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions.columns import extract
from waymark.plans.registry import query

#: Longest description, keywords and prices that are listed, images that are kept, and what an address of an image begins with.
LONGEST, FULL_KEYWORDS, SHORT_KEYWORDS, TOP_PRICES, MOST_IMAGES = 500, 5, 3, 3, 5
REMOTE = ("http://", "https://")
ANY_ADDRESS = ("data/", "data\\", "/", "http://", "https://", "//")
ENTRY = "array<struct<name:string,price:string,price_numeric:bigint,is_recommended:boolean,type:string,`order`:bigint,description:string,source:string>>"


def there(value: Column) -> Column:
    return F.when(value != "", value)


def _labelled(label: str, value: Column, behind: str = "") -> Column:
    return F.when(value != "", F.concat(F.lit(label), value, F.lit(behind)))


def _keywords(label: str, keywords: Column, most: int) -> Column:
    return F.when(F.size(keywords) > 0, F.concat(F.lit(label), F.array_join(F.slice(keywords, 1, most), ", ")))


def description(variant: str) -> Column:
    """The parts of a description joined by " | ", 500 characters at most; without parts: empty (full), null (short), a phrase
    with the name (plain)."""
    own, refill = there(F.col("description")), _labelled("", F.col("refill_type"), " 전문점")
    mood = _labelled("분위기: ", F.col("atmosphere"))
    if variant == "full":
        parts = [own, refill, _labelled("리필 조건: ", F.col("refill_conditions")), mood, there(F.col("review_summary")), _keywords("키워드: ", F.col("keywords"), FULL_KEYWORDS)]
    else:
        parts = [own, refill, mood, _keywords("특징: ", F.col("keywords"), SHORT_KEYWORDS)] if variant == "short" else [own, refill]
    text = F.left(F.concat_ws(" | ", *parts), F.lit(LONGEST))
    if variant == "full":
        return text
    return there(text) if variant == "short" else F.coalesce(there(text), F.concat(F.coalesce("name", F.lit("")), F.lit(" 무한리필 전문점")))


def price(variant: str) -> Column:
    """The price text: its own or the first detail (full); own, mean, range, or the first three details (short); own, mean, range (plain)."""
    details = F.filter("price_details", lambda d: d != "")
    if variant == "full":
        return F.coalesce(there(F.col("price")), F.get("price_details", F.lit(0)))
    first = F.trim(F.coalesce(*[there(F.col(c)) for c in ("price", "average_price", "price_range")]))
    return first if variant == "plain" else F.coalesce(first, F.when(F.size(details) > 0, F.array_join(F.slice(details, 1, TOP_PRICES), ", ")))


def images(variant: str) -> Column:
    """Addresses of images: the main one if it is any address (full); five remote ones of all fields, in order (short); the
    stored copy of the main one, or else it (plain)."""

    def begins(u: Column, starts: tuple[str, ...]) -> Column:
        out = F.lit(False)
        for start in starts:
            out = out | u.startswith(start)
        return F.coalesce(out, F.lit(False))

    if variant == "short":
        every = F.array_distinct(F.concat(F.array("main_image"), F.coalesce("image_urls", F.array().cast("array<string>"))))
        return F.slice(F.array_sort(F.filter(every, lambda u: begins(u, REMOTE))), 1, MOST_IMAGES)
    chosen = there(F.col("main_image")) if variant == "full" else F.coalesce(there(F.col("main_image_local")), there(F.col("main_image")))
    return F.filter(F.array(chosen), lambda u: begins(u, ANY_ADDRESS))


def refill_entries() -> Column:
    """Entries of eight fields of what can be refilled: the menu's items, else the listed items, else what the type names.

    The menu is a JSON text; one that is none or empty counts as missing. Items without a name are left out.
    """
    menu = F.from_json("menu_items", ENTRY)
    none = F.lit(None).cast("string")

    def entry(name: Column, recommended: bool, kind: str, text: Column) -> Column:
        return F.struct(
            name.alias("name"), F.lit("").alias("price"), F.lit(0).cast("bigint").alias("price_numeric"), F.lit(recommended).alias("is_recommended"), F.lit(kind).alias("type"),
            F.lit(0).cast("bigint").alias("order"), text.alias("description"), F.lit("crawler").alias("source"),
        )

    listed = F.transform(F.filter("refill_items", lambda i: F.trim(i) != ""), lambda i: entry(F.trim(i), False, "refill_item", F.lit("")))
    named = F.trim(extract(F.col("refill_type"), r"(.+?)\s*무한리필"))
    typed = F.when(named != "", F.array(entry(named, True, "refill_type", F.col("refill_type"))))

    def filled(m: Column) -> Column:
        return F.struct(
            m["name"].alias("name"), F.coalesce(m["price"], F.lit("")).alias("price"), F.coalesce(m["price_numeric"], F.lit(0)).alias("price_numeric"),
            F.coalesce(m["is_recommended"], F.lit(False)).alias("is_recommended"), F.coalesce(m["type"], F.lit("menu_item")).alias("type"), F.coalesce(m["order"], F.lit(0)).alias("order"),
            F.coalesce(m["description"], none).alias("description"), F.coalesce(m["source"], none).alias("source"),
        )

    some = F.coalesce(F.when(F.size(menu) > 0, menu), F.when(F.size(listed) > 0, listed), typed)
    return F.transform(F.filter(some, lambda m: m["name"] != ""), filled)


def _stores(v):
    lists = {c: F.when(F.col(c).isNotNull(), F.split(c, "\\|")) for c in ("keywords", "price_details", "image_urls", "refill_items")}
    return v.crawled_stores.withColumns(lists)


_REFILL = "CASE WHEN refill_type <> '' THEN refill_type || ' 전문점' END"
_MOOD = "CASE WHEN atmosphere <> '' THEN '분위기: ' || atmosphere END"


@query(f"""WITH s AS (SELECT *, string_split(keywords, '|') AS k FROM crawled_stores)
SELECT id, left(concat_ws(' | ', nullif(description, ''), {_REFILL}, CASE WHEN refill_conditions <> '' THEN '리필 조건: ' || refill_conditions END, {_MOOD}, nullif(review_summary, ''), '키워드: ' || array_to_string(k[1:5], ', ')), 500) AS full_text,
  nullif(left(concat_ws(' | ', nullif(description, ''), {_REFILL}, {_MOOD}, '특징: ' || array_to_string(k[1:3], ', ')), 500), '') AS short_text,
  coalesce(nullif(left(concat_ws(' | ', nullif(description, ''), {_REFILL}), 500), ''), name || ' 무한리필 전문점') AS plain_text FROM s""")
def descriptions(v):
    return _stores(v).select("id", description("full").alias("full_text"), description("short").alias("short_text"), description("plain").alias("plain_text"))


@query("""WITH s AS (SELECT *, string_split(price_details, '|') AS d FROM crawled_stores), f AS (SELECT *, trim(coalesce(nullif(price, ''), nullif(average_price, ''), nullif(price_range, ''))) AS first FROM s)
SELECT id, coalesce(nullif(price, ''), d[1]) AS full_price, coalesce(first, nullif(array_to_string(list_filter(d, lambda x: x <> '')[1:3], ', '), '')) AS short_price, first AS plain_price FROM f""")
def price_fallbacks(v):
    return _stores(v).select("id", price("full").alias("full_price"), price("short").alias("short_price"), price("plain").alias("plain_price"))


_ANY = "starts_with({0}, 'data/') OR starts_with({0}, 'data\\') OR starts_with({0}, '/') OR starts_with({0}, 'http://') OR starts_with({0}, 'https://')"


@query(f"""WITH s AS (SELECT *, coalesce(nullif(main_image_local, ''), nullif(main_image, '')) AS one, list_distinct(list_concat([main_image], coalesce(string_split(image_urls, '|'), []))) AS u FROM crawled_stores)
SELECT id, coalesce(CASE WHEN {_ANY.format('main_image')} THEN main_image END, '') AS full_images, array_to_string(list_sort(list_filter(u, lambda x: starts_with(x, 'http://') OR starts_with(x, 'https://')))[1:5], '|') AS short_images,
  coalesce(CASE WHEN {_ANY.format('one')} THEN one END, '') AS plain_images FROM s""")
def image_variants(v):
    return _stores(v).select("id", *[F.array_join(images(kind), "|").alias(f"{kind}_images") for kind in ("full", "short", "plain")])


@query(r"""WITH s AS (SELECT *, CASE WHEN json_valid(menu_items) THEN CAST(json_extract(menu_items, '$[*]') AS JSON[]) ELSE [] END AS m, coalesce(string_split(refill_items, '|'), []) AS r, trim(regexp_extract(refill_type, '(.+?)\s*무한리필', 1)) AS t FROM crawled_stores),
a AS (SELECT id, unnest(m) AS e, unnest(range(len(m))) AS i FROM s), f AS (SELECT id, unnest(list_filter(r, lambda x: trim(x) <> '')) AS e, unnest(range(len(list_filter(r, lambda x: trim(x) <> '')))) AS i FROM s WHERE len(m) = 0)
SELECT id, i, e->>'$.name' AS name, coalesce(e->>'$.price', '') AS price, CAST(coalesce(e->>'$.price_numeric', '0') AS BIGINT) AS price_numeric, coalesce(e->>'$.is_recommended', 'false') = 'true' AS is_recommended, coalesce(e->>'$.type', 'menu_item') AS type,
  CAST(coalesce(e->>'$.order', '0') AS BIGINT) AS "order", e->>'$.description' AS description, e->>'$.source' AS source FROM (SELECT id, row_number() OVER (PARTITION BY id ORDER BY i) - 1 AS i, e FROM a WHERE coalesce(e->>'$.name', '') <> '') x
UNION ALL SELECT id, i, trim(e), '', 0, false, 'refill_item', 0, '', 'crawler' FROM f
UNION ALL SELECT id, 0, t, '', 0, true, 'refill_type', 0, refill_type, 'crawler' FROM s WHERE len(m) = 0 AND id NOT IN (SELECT id FROM f) AND t <> ''""")
def refill_entry_rows(v):
    found = _stores(v).select("id", F.posexplode(refill_entries()).alias("i", "e"))
    return found.select("id", F.col("i").cast("long").alias("i"), "e.*")
