"""List and detail pages: every entry of a list, and nine extractors of a detail page that fail one by one.

Pages are parsed once (waymark.sources.html); all else are column expressions over a page's nodes, so a page never
leaves its task. Each extractor gives struct(value, error): an error says that the page has the part but that it can
not be read, and the others go on. Null pages give null nodes, nulls and no errors; empty pages no values and no errors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions import hours as H
from waymark.functions.columns import extract, let, present
from waymark.functions.geo import within
from waymark.functions.text import find_phone, plausible_phone, strip_ordinal
from waymark.operators.details import FOOD_WORDS, MENU_HEADERS, WON, KEPT_LINE_WORDS, MENU_LEAST, MENU_LINE, MENU_MOST, REVIEW_WORDS
from waymark.operators.details import _number_sql, COORDINATES, PAGE_BOX, listed, menu_name, mentions, mined_menu, script_pair, words_in
from waymark.operators.quality import phone_sql
from waymark.plans.registry import query
from waymark.sources import html as page

#: Words that decide what a part of a page is.
MENU_TITLE = "메뉴정보"
HOURS_WORDS = ("영업시간", "라스트 오더", "라스트오더", "휴무")
REVIEW_KEYWORDS = ("무한리필", "무제한", "셀프바", "리필가능", "무료리필") + FOOD_WORDS
THEME_WORDS = ("무한리필", "무제한", "셀프바", "뷔페")
ADDRESS_WORDS = ("서울", "특별시", "광역시", "시", "구", "동", "로", "길", "번지")
NO_ADDRESS_WORDS = ("맛집", "검색", "음식", "랭킹", "추천")
PROVINCES = ("서울특별시", "서울시", "서울", "경기도", "인천광역시")
STREET_WORDS = ("동", "로", "길")
MOST_PRICES, MOST_IMAGES, MOST_TEXTS, MOST_KEYWORDS, LEAST_TEXT = 10, 5, 3, 10, 10
#: What a list scan reads of each entry of a page's stored list.
POI = """struct<poi_section:struct<list:array<struct<v_rid:string,nm:string,branch:string,addr:string,road_addr:string,phone:string,distance:string,category:string,
lat:double,lng:double,score:double,user_score:double,review_cnt:bigint,image_list:array<string>,open_status:string,keyword:array<string>>>>>"""


def field(value: Column, error: Column) -> Column:
    return F.struct(value.alias("value"), error.alias("error"))


def failed(when: Column, message: str | Column) -> Column:
    return F.when(when, F.lit(message) if isinstance(message, str) else message)


def list_entries(json: Column, keyword: Column, rect: Column) -> Column:
    """The 19 fields of every entry of a stored list that has an id and a name; null for a text that is no list."""
    entries = F.from_json(json, POI)["poi_section"]["list"]

    def text(value: Column) -> Column:
        return F.coalesce(value, F.lit(""))

    def entry(e: Column) -> Column:
        none = F.array().cast("array<string>")
        parts = {
            "place_id": text(e["v_rid"]), "detail_url": F.concat(F.lit("/profile.php?rid="), text(e["v_rid"])), "name": text(e["nm"]), "branch": text(e["branch"]),
            "basic_address": text(e["addr"]), "road_address": text(e["road_addr"]), "phone_number": text(e["phone"]), "distance": text(e["distance"]),
            "category": text(e["category"]), "keyword": keyword, "rect_area": rect, "lat": e["lat"], "lng": e["lng"], "score": e["score"], "rating": e["user_score"],
            "review_count": F.coalesce(e["review_cnt"], F.lit(0)), "image_urls": F.coalesce(e["image_list"], none), "open_status": text(e["open_status"]),
            "raw_categories": F.coalesce(e["keyword"], none),
        }
        return F.struct(*[value.alias(name) for name, value in parts.items()])

    return F.transform(F.filter(entries, lambda e: present(e["v_rid"]) & present(e["nm"])), entry)


def blocks(nodes: Column) -> Column:
    """Entries of a list page that have an id and a name; a part of a block that can not be read is null."""

    def one(a: Column) -> Column:
        return let(page.select(nodes, "h2", a), lambda titles: parts(a, F.get(titles, F.lit(0))))

    def parts(a: Column, title: Column) -> Column:
        url = F.coalesce(page.attribute(a, "href"), F.lit(""))
        branch = F.get(page.select(nodes, "span.Info__Title__Place", title), F.lit(0))
        score = F.get(page.select(nodes, "p.Score span", a), F.lit(0))
        rating = F.get(page.select(nodes, "span.score-text", a), F.lit(0))
        lat, lng = (F.coalesce(*[F.nullif(page.attribute(a, f"data-{n}"), F.lit("")) for n in names]) for names in (("lat", "latitude"), ("lng", "longitude")))
        y, x = lat.try_cast("double"), lng.try_cast("double")
        categories = F.transform(page.select(nodes, "span.Category", a), lambda c: page.text_of(nodes, c))
        return F.struct(
            extract(url, "rid=([^&]*)").alias("place_id"), F.when(url.contains("rid="), url).otherwise("").alias("detail_url"),
            F.trim(strip_ordinal(page.text_of(nodes, title))).alias("name"), F.when(branch.isNotNull(), page.text_of(nodes, branch)).otherwise("").alias("branch"),
            F.when(x.isNotNull(), y).alias("lat"), F.when(y.isNotNull(), x).alias("lng"), page.text_of(nodes, score).try_cast("int").alias("score"),
            page.text_of(nodes, rating).try_cast("double").alias("rating"), F.filter(categories, lambda c: c != "").alias("categories"),
        )

    return F.filter(F.transform(page.select(nodes, "a.PoiBlock"), one), lambda b: present(b["place_id"]) & present(b["name"]))


def menu_field(nodes: Column) -> Column:
    """Name and price of the items of the list behind the menu's title: the priced ones by price, then the free ones."""
    titles = F.filter(nodes, lambda n: (n["tag"] == page.TEXT) & n["text"].contains(MENU_TITLE))
    paragraphs = F.filter(titles, lambda n: F.get(nodes, n["parent"])["tag"] == "p")
    title = F.get(nodes, F.coalesce(F.get(paragraphs, F.lit(0))["parent"], F.get(titles, F.lit(0))["parent"]))

    def items(ul: Column) -> Column:
        def one(li: Column, i: Column) -> Column:
            texts = F.transform(page.select(nodes, "p", li), lambda p: page.text_of(nodes, p))
            return F.struct(menu_name(F.get(texts, F.lit(0))).alias("name"), F.get(texts, F.lit(1)).alias("price"), i.alias("place"))

        found = F.filter(F.transform(page.children(nodes, ul, "li"), one), lambda x: x["name"].isNotNull() & (x["name"] != "") & (F.char_length(x["name"]) < 100) & x["price"].contains("원"))

        def priced(x: Column) -> Column:
            shown = F.regexp_extract(x["price"], r"([\d,]+)\s*원", 1)
            amount = F.when(shown == "", F.lit(0)).otherwise(F.replace(shown, F.lit(","), F.lit("")).try_cast("long"))
            return F.struct((amount == 0).alias("free"), amount.alias("amount"), x["place"].alias("place"), x["name"].alias("name"), x["price"].alias("price"))

        return F.transform(found, priced)

    def made(t: Column) -> Column:
        lists = F.filter(nodes, lambda n: (n["tag"] == "ul") & (n["parent"] == t["parent"]) & (n["pre"] > t["pre"]))
        return let(F.get(lists, F.lit(0)), lambda ul: let(items(ul), lambda every: shown(t, ul, every)))

    def shown(t: Column, ul: Column, every: Column) -> Column:
        good = F.array_sort(F.filter(every, lambda x: x["amount"].isNotNull()))
        value = F.transform(good, lambda x: F.struct(x["name"].alias("name"), x["price"].alias("price"), x["amount"].alias("price_numeric"), x["name"].contains("추천").alias("recommended"), (x["place"] + 1).alias("place")))
        lost = F.size(every) - F.size(good)
        error = F.coalesce(
            failed(t.isNotNull() & ul.isNull(), "menu: no list behind its title"),
            failed(lost > 0, F.concat(F.lit("menu: prices not read: "), lost.cast("string"))),
        )
        return field(value, error)

    return let(title, made)


def price_field(menu: Column) -> Column:
    """The first ten prices of the menu; none of a menu that could not be read is an error here, too."""
    prices = F.slice(F.transform(menu["value"], lambda x: x["price"]), 1, MOST_PRICES)
    return field(prices, failed((F.coalesce(F.size(prices), F.lit(0)) <= 0) & menu["error"].isNotNull(), "price: none in the menu"))


def hours_field(nodes: Column) -> Column:
    """Hours, closed days, break and last order of the first list item that speaks of hours."""
    texts = F.transform(page.select(nodes, "li"), lambda li: page.text_of(nodes, li, strip=False))

    def made(text: Column) -> Column:
        closed = H.closed_days(text)
        week = let(H.day_hours(text), lambda h: let(closed, lambda c: let(H.fill_days(h, c), lambda week: H.render(week, c, H.last_order(text)))))
        value = F.struct(week.alias("open_hours"), F.array_join(closed, ",").alias("closed"), H.break_time(text).alias("break_time"), H.last_order(text).alias("last_order"))
        issues = H.format_issues(text)
        return field(F.when(text.isNotNull(), value), failed(F.size(issues) > 0, F.concat(F.lit("hours: "), F.array_join(issues, ", "))))

    return let(F.get(F.filter(texts, lambda t: mentions(t, HOURS_WORDS)), F.lit(0)), made)


def image_field(nodes: Column) -> Column:
    """At most five distinct absolute addresses of images, in order."""
    every = F.array_compact(F.transform(page.select(nodes, "img"), lambda i: page.attribute(i, "src")))
    found = F.slice(F.array_sort(F.array_distinct(F.filter(every, lambda u: u.rlike("^https?://")))), 1, MOST_IMAGES)
    return field(found, failed((F.size(every) > 0) & (F.size(found) == 0), "images: no absolute address"))


def review_field(nodes: Column, text: Column) -> Column:
    """The first three descriptions of more than ten characters, and the known words of the page."""
    parts = F.transform(page.select(nodes, "*~desc|description|intro|summary"), lambda e: F.when(e["tag"].isin("div", "p"), page.text_of(nodes, e)))
    parts = F.array_compact(parts)
    long = F.filter(parts, lambda t: F.char_length(t) > LEAST_TEXT)
    value = F.struct(F.array_join(F.slice(long, 1, MOST_TEXTS), " ").alias("description"), F.slice(words_in(F.lower(text), REVIEW_KEYWORDS), 1, MOST_KEYWORDS).alias("keywords"))
    return field(value, failed((F.size(parts) > 0) & (F.size(long) == 0), "review: descriptions too short"))


def contact_field(nodes: Column, text: Column, own_host: str) -> Column:
    """The first phone number of the page's text and the first link that leads elsewhere."""
    links = F.transform(page.select(nodes, "a[href]"), lambda a: page.attribute(a, "href"))
    website = F.get(F.filter(links, lambda u: u.startswith("http") & ~u.contains(own_host)), F.lit(0))

    def made(phone: Column) -> Column:
        return field(F.struct(phone.alias("phone"), website.alias("website")), failed(~plausible_phone(phone), F.concat(F.lit("contact: no phone number: "), phone)))

    return let(find_phone(text), made)


def coordinate_field(script: Column) -> Column:
    """Coordinates that a script names, if they lie in the country."""

    def made(p: Column) -> Column:
        inside = within(p["lat"], p["lng"], PAGE_BOX)
        return field(F.when(inside, p), failed(~inside, "coordinates: outside the country"))

    return let(script_pair(script), made)


def address_of(parts: Column) -> Column:
    """One address of the parts in input order: province, then districts, then streets and quarters, then numbers; none twice.

    A part that the address holds already is not added; a number alone makes no address; without parts it is empty.
    """

    def has(part: Column, words: tuple[str, ...]) -> Column:
        return part.rlike("|".join(words))

    def add(rule) -> object:
        return lambda made, part: F.when(rule(part, made) & ~made.contains(part), F.when(made == "", part).otherwise(F.concat(made, F.lit(" "), part))).otherwise(made)

    made = F.coalesce(F.get(F.filter(parts, lambda p: has(p, PROVINCES)), F.lit(0)), F.lit(""))
    for rule in (
        lambda p, m: p.contains("구"),
        lambda p, m: has(p, STREET_WORDS),
        lambda p, m: p.rlike("[0-9]") & (m != ""),
    ):
        made = F.aggregate(parts, made, add(rule))
    return made


def address_field(nodes: Column) -> Column:
    """The address that the page's search links make up."""
    links = F.filter(page.select(nodes, "a[href]"), lambda a: page.attribute(a, "href").contains("/list.dc?query="))
    texts = F.transform(links, lambda a: page.text_of(nodes, a))
    parts = F.filter(texts, lambda t: t.rlike("|".join(ADDRESS_WORDS)) & ~t.rlike("|".join(NO_ADDRESS_WORDS)) & (F.char_length(t) > 1))
    value = let(F.array_distinct(parts), address_of)
    return field(F.nullif(value, F.lit("")), failed((F.size(links) > 0) & (value == ""), "address: no part among its links"))


def refill_field(text: Column) -> Column:
    """Whether the page is about the theme, and its priced items."""
    about = mentions(text, THEME_WORDS)
    items = F.transform(mined_menu(text), lambda x: F.struct(x["name"].alias("name"), x["price"].alias("price")))
    return field(F.struct(about.alias("confirmed"), items.alias("items")), failed(about & (F.size(items) == 0), "refill: no priced item"))


EXTRACTORS = ("menu", "price", "hours", "images", "review", "contact", "coordinates", "address", "refill")


def detail_fields(pages: DataFrame, html: str = "html", own_host: str = "own.example") -> DataFrame:
    """pages with one struct(value, error) per extractor and `errors`, the list of all errors, in place of the text."""
    parsed = page.with_nodes(pages, html)
    nodes = F.col("nodes")
    read = parsed.select("*", page.page_text(nodes).alias("page_text"), page.scripts(nodes).alias("page_scripts"))
    text = F.col("page_text")
    out = read.select(
        *[F.col(c) for c in parsed.columns if c != "nodes"], menu_field(nodes).alias("menu"), hours_field(nodes).alias("hours"), image_field(nodes).alias("images"),
        review_field(nodes, text).alias("review"), contact_field(nodes, text, own_host).alias("contact"), coordinate_field(F.col("page_scripts")).alias("coordinates"),
        address_field(nodes).alias("address"), refill_field(text).alias("refill"),
    )
    out = out.withColumn("price", price_field(F.col("menu")))
    return out.withColumn("errors", F.array_compact(F.array(*[F.col(f"{name}.error") for name in EXTRACTORS])))


@query(r"""SELECT page_id, unnest(range(1, len(u) + 1)) AS place, unnest(u) AS href, unnest(t) AS label FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS u,
  list_transform(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2), lambda x: trim(x)) AS t FROM pages) x""")
def page_entries(v):
    """All entries of every page's navigation."""
    pages = page.with_nodes(v.pages.select("page_id", "html"))
    found = pages.select("page_id", "nodes", F.posexplode(page.select(F.col("nodes"), "nav ul li a")).alias("i", "a"))
    return found.select("page_id", (F.col("i") + 1).cast("long").alias("place"), page.attribute(F.col("a"), "href").alias("href"), page.text_of(F.col("nodes"), F.col("a")).alias("label"))


# what a page holds between its article tags: texts are counted with the tags taken out
@query(r"""WITH p AS (SELECT page_id, regexp_replace(regexp_replace(html, '<script>.*?</script>|<style>.*?</style>', '<x></x>', 'gs'), '<!--.*?-->', '', 'gs') AS h FROM pages),
a AS (SELECT page_id, h, regexp_extract(h, '<article>(.*?)</article>', 1, 's') AS body FROM p)
SELECT page_id, CAST(len(regexp_extract_all(h, '<[a-zA-Z]')) AS BIGINT) AS elements, CAST(len(regexp_extract_all(body, '<p>')) AS BIGINT) AS paragraphs,
  regexp_extract(h, '<div class="ad">([^<]*)</div>', 1) AS ad, regexp_extract(h, '<html lang="([^"]*)"', 1) AS lang, CAST(length(regexp_replace(body, '<[^>]*>', '', 'g')) AS BIGINT) AS raw_chars FROM a""")
def page_outline(v):
    """Elements, paragraphs of the article, the advertisement, the language and the characters of the article."""
    nodes = F.col("nodes")
    pages = page.with_nodes(v.pages.select("page_id", "html"))
    return pages.select(
        "page_id", F.size(F.filter(nodes, lambda n: ~n["tag"].startswith("#"))).cast("long").alias("elements"), F.size(page.select(nodes, "article p")).cast("long").alias("paragraphs"),
        page.text_of(nodes, F.get(page.select(nodes, "div.ad"), F.lit(0)), strip=False).alias("ad"), page.attribute(F.get(page.select(nodes, "html"), F.lit(0)), "lang").alias("lang"),
        page.written_chars(nodes, F.get(page.select(nodes, "article"), F.lit(0))).alias("raw_chars"),
    )


ENTRY_FIELDS = ("place_id", "detail_url", "name", "branch", "basic_address", "road_address", "phone_number", "distance", "category", "keyword", "rect_area", "lat", "lng", "score", "rating", "review_count", "open_status")


@query("""WITH j AS (SELECT page_id, keyword, rect_area, unnest(CAST(json_extract(CASE WHEN json_valid(list_data) THEN list_data END, '$.poi_section.list[*]') AS JSON[])) AS e FROM list_json)
SELECT page_id, e->>'$.v_rid' AS place_id, '/profile.php?rid=' || (e->>'$.v_rid') AS detail_url, e->>'$.nm' AS name, coalesce(e->>'$.branch', '') AS branch, coalesce(e->>'$.addr', '') AS basic_address,
  coalesce(e->>'$.road_addr', '') AS road_address, coalesce(e->>'$.phone', '') AS phone_number, coalesce(e->>'$.distance', '') AS distance, coalesce(e->>'$.category', '') AS category, keyword, rect_area,
  CAST(e->>'$.lat' AS DOUBLE) AS lat, CAST(e->>'$.lng' AS DOUBLE) AS lng, CAST(e->>'$.score' AS DOUBLE) AS score, CAST(e->>'$.user_score' AS DOUBLE) AS rating, CAST(coalesce(e->>'$.review_cnt', '0') AS BIGINT) AS review_count,
  coalesce(e->>'$.open_status', '') AS open_status, array_to_string(coalesce(e->>'$.image_list[*]', []), '|') AS image_urls, array_to_string(coalesce(e->>'$.keyword[*]', []), '|') AS raw_categories
FROM j WHERE coalesce(e->>'$.v_rid', '') <> '' AND coalesce(e->>'$.nm', '') <> ''""")
def stored_entries(v):
    """All fields of every entry of the stored lists; a text that is no list has none."""
    found = v.list_json.select("page_id", F.explode(list_entries(F.col("list_data"), F.col("keyword"), F.col("rect_area"))).alias("e"))
    return found.select("page_id", *[F.col(f"e.{f}") for f in ENTRY_FIELDS], F.array_join("e.image_urls", "|").alias("image_urls"), F.array_join("e.raw_categories", "|").alias("raw_categories"))


@query(r"""WITH b AS (SELECT page_id, unnest(regexp_extract_all(html, '<a class="PoiBlock[^>]*>.*?</a>', 0, 's')) AS b, unnest(range(1, 1 + len(regexp_extract_all(html, '<a class="PoiBlock[^>]*>', 0)))) AS place FROM list_pages),
f AS (SELECT page_id, place, replace(regexp_extract(b, 'href="([^"]*)"', 1), '&amp;', '&') AS url, trim(regexp_replace(trim(regexp_replace(regexp_extract(b, '<h2>(.*?)</h2>', 1), '<[^>]*>', '', 'g')), '^\d+(\.\s*|\s+)', '')) AS name,
  trim(regexp_extract(b, 'Info__Title__Place">([^<]*)<', 1)) AS branch, TRY_CAST(regexp_extract(b, 'data-lat(?:itude)?="([^"]*)"', 1) AS DOUBLE) AS y, TRY_CAST(regexp_extract(b, 'data-l(?:ng|ongitude)="([^"]*)"', 1) AS DOUBLE) AS x,
  regexp_extract(b, 'class="Score"><span>([^<]*)', 1) AS s, TRY_CAST(regexp_extract(b, 'score-text">([^<]*)', 1) AS DOUBLE) AS rating,
  array_to_string(list_filter(list_transform(regexp_extract_all(b, 'class="Category">([^<]*)', 1), lambda c: trim(replace(c, '&amp;', '&'))), lambda c: c <> ''), '|') AS categories FROM b)
SELECT page_id, regexp_extract(url, 'rid=([^&]*)', 1) AS place_id, url AS detail_url, name, branch, CASE WHEN x IS NOT NULL THEN y END AS lat, CASE WHEN y IS NOT NULL THEN x END AS lng,
  CASE WHEN regexp_full_match(s, '\d+') THEN CAST(s AS INT) END AS score, rating, categories FROM f WHERE contains(url, 'rid=') AND name <> ''""")
def poi_blocks(v):
    """Entries of the list pages by their markup."""
    found = page.with_nodes(v.dealt("list_pages")).select("page_id", F.explode(blocks(F.col("nodes"))).alias("b"))
    return found.select("page_id", "b.place_id", "b.detail_url", "b.name", "b.branch", "b.lat", "b.lng", "b.score", "b.rating", F.array_join("b.categories", "|").alias("categories"))


_HEADERS = "|".join(MENU_HEADERS)
_LINKS = "regexp_extract_all(html, '<a href=\"/list[.]dc[?]query=[^\"]*\">([^<]*)</a>', 1)"
DETAILS_SQL = rf"""d AS (SELECT page_id, html, replace(regexp_replace(regexp_replace(html, '<script[^>]*>.*?</script>|<!--.*?-->', '', 'gs'), '<(?:[^>"]|"[^"]*")*>', '', 'g'), '&amp;', '&') AS t,
  array_to_string(regexp_extract_all(html, '<script[^>]*>(.*?)</script>', 1, 's'), chr(10)) AS script, regexp_extract(html, '<p>메뉴정보</p><ul>(.*?)</ul>', 1, 's') AS m,
  coalesce(list_filter(list_transform(regexp_extract_all(html, '<li>(.*?)</li>', 1, 's'), lambda x: replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&amp;', '&')), lambda x: regexp_matches(x, '{"|".join(HOURS_WORDS)}'))[1], '') AS h FROM detail_pages),
i AS (SELECT page_id, unnest(regexp_extract_all(m, '<li><p>([^<]*)</p><p>([^<]*)</p></li>', 1)) AS n, trim(unnest(regexp_extract_all(m, '<li><p>([^<]*)</p><p>([^<]*)</p></li>', 2))) AS price,
  unnest(range(len(regexp_extract_all(m, '<li><p>([^<]*)</p><p>([^<]*)</p></li>', 1)))) AS place FROM d),
g AS (SELECT page_id, place, price, trim(regexp_replace(regexp_replace(replace(n, '&amp;', '&'), '^.*({_HEADERS})', '', 's'), '\s+', ' ', 'g')) AS name, regexp_extract(price, '([0-9,]+)\s*원', 1) AS s FROM i WHERE contains(price, '원')),
k AS (SELECT *, CASE WHEN s = '' THEN 0 ELSE TRY_CAST(replace(s, ',', '') AS BIGINT) END AS amount FROM g WHERE name <> ''),
menu AS (SELECT page_id, string_agg(name || '=' || amount, '|' ORDER BY amount = 0, amount, place) AS menu, string_agg(price, '|' ORDER BY amount = 0, amount, place) FILTER (WHERE amount IS NOT NULL) AS prices, count(*) FILTER (WHERE amount IS NULL) AS lost FROM k GROUP BY page_id),
a AS (SELECT page_id, {_LINKS} AS links, list_filter({_LINKS}, lambda x: regexp_matches(x, '{"|".join(ADDRESS_WORDS)}') AND NOT regexp_matches(x, '{"|".join(NO_ADDRESS_WORDS)}') AND length(x) > 1) AS p FROM d),
a0 AS (SELECT page_id, links, list_filter(p, lambda x, j: list_position(p, x) = j) AS p, coalesce(list_filter(p, lambda x: regexp_matches(x, '{"|".join(PROVINCES)}'))[1], '') AS v FROM a),
a1 AS (SELECT *, list_reduce(list_prepend(v, p), lambda c, x: CASE WHEN contains(x, '구') AND NOT contains(c, x) THEN trim(c || ' ' || x) ELSE c END) AS w FROM a0),
a2 AS (SELECT *, list_reduce(list_prepend(w, p), lambda c, x: CASE WHEN regexp_matches(x, '동|로|길') AND NOT contains(c, x) THEN trim(c || ' ' || x) ELSE c END) AS y FROM a1),
a3 AS (SELECT page_id, len(links) AS links, list_reduce(list_prepend(y, p), lambda c, x: CASE WHEN c <> '' AND regexp_matches(x, '[0-9]') AND NOT contains(c, x) THEN c || ' ' || x ELSE c END) AS address FROM a2),
c AS (SELECT page_id, CASE {" ".join(f"WHEN {_number_sql(a)} IS NOT NULL AND {_number_sql(b)} IS NOT NULL THEN [{_number_sql(a)}, {_number_sql(b)}]" for a, b in COORDINATES)} END AS p FROM d),
f AS (SELECT page_id, coalesce(nullif(regexp_extract(t, '(0\d{{1,2}}-\d{{3,4}}-\d{{4}})', 1), ''), nullif(regexp_extract(t, '(0\d{{9,10}})', 1), ''), nullif(regexp_extract(t, '(\d{{3}}-\d{{3,4}}-\d{{4}})', 1), '')) AS p FROM d),
f1 AS (SELECT page_id, p, regexp_replace(regexp_replace(replace(p, '-', ''), '^07(\d{{8}})$', '0507\1'), '^08(\d{{8}})$', '0508\1') AS d FROM f),
f2 AS (SELECT page_id, {phone_sql('d', 'p')} AS phone FROM f1),
im AS (SELECT page_id, regexp_extract_all(html, '<img[^>]*? (?:alt="[^"]*" )?src="([^"]*)"', 1) AS u FROM (SELECT page_id, replace(html, '<img ', '<img  ') AS html FROM d) x),
rv AS (SELECT page_id, list_transform(regexp_extract_all(html, '<(?:p|div) class="(?:desc-intro|summary)">([^<]*)<', 1), lambda x: trim(x)) AS r FROM d),
l AS (SELECT page_id, array_to_string(list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x)), lambda x: length(x) >= 3 AND NOT regexp_matches(x, '{"|".join(REVIEW_WORDS)}') AND regexp_matches(x, '{WON}|{"|".join(KEPT_LINE_WORDS)}')), chr(10)) AS t FROM d),
q AS (SELECT page_id, unnest(regexp_extract_all(t, '{MENU_LINE}', 1)) AS name, unnest(regexp_extract_all(t, '{MENU_LINE}', 2)) AS price, unnest(range(len(regexp_extract_all(t, '{MENU_LINE}', 1)))) AS place FROM l),
q1 AS (SELECT page_id, trim(regexp_replace(name, ' +', ' ', 'g')) AS name, CAST(replace(price, ',', '') AS BIGINT) AS price, place FROM q),
q2 AS (SELECT *, row_number() OVER (PARTITION BY page_id, name ORDER BY place) AS r FROM q1 WHERE price BETWEEN {MENU_LEAST} AND {MENU_MOST} AND length(name) BETWEEN 3 AND 30),
refill AS (SELECT page_id, string_agg(name || '=' || price, '|' ORDER BY price, place) AS items FROM q2 WHERE r = 1 GROUP BY page_id)"""

_INSIDE = f"c.p[1] BETWEEN {PAGE_BOX[0]} AND {PAGE_BOX[1]} AND c.p[2] BETWEEN {PAGE_BOX[2]} AND {PAGE_BOX[3]}"
_STRICT = "list_filter(im.u, lambda u: regexp_matches(u, '^https?://'))"


@query(rf"""WITH {DETAILS_SQL}
SELECT d.page_id, menu.menu, coalesce(menu.prices, '') AS prices, nullif(regexp_extract(h, '라스트오더: (\d{{1,2}}:\d{{2}})', 1), '') AS last_order, replace(nullif(regexp_extract(h, '브레이크타임 (\d{{1,2}}:\d{{2}}~\d{{1,2}}:\d{{2}})', 1), ''), '~', '-') AS break_time,
  CASE WHEN h <> '' THEN array_to_string(regexp_extract_all(h, '([월화수목금토일])요일 휴무', 1), ',') END AS closed, array_to_string(list_sort(list_distinct({_STRICT}))[1:5], '|') AS images,
  array_to_string(list_filter(r, lambda x: length(x) > {LEAST_TEXT})[1:3], ' ') AS description, array_to_string(list_filter({listed(REVIEW_KEYWORDS)}, lambda w: contains(lower(d.t), w))[1:10], ',') AS keywords, f2.phone,
  list_filter(regexp_extract_all(html, '<a href="(http[^"]*)"', 1), lambda u: NOT contains(u, 'own.example'))[1] AS website, CASE WHEN {_INSIDE} THEN c.p[1] END AS lat, CASE WHEN {_INSIDE} THEN c.p[2] END AS lng,
  nullif(a3.address, '') AS address, len(list_filter({listed(THEME_WORDS)}, lambda w: contains(d.t, w))) > 0 AS confirmed, coalesce(refill.items, '') AS items,
  concat_ws('; ', CASE WHEN contains(html, '<p>메뉴정보</p><div>') THEN 'menu: no list behind its title' WHEN menu.lost > 0 THEN 'menu: prices not read: ' || menu.lost END, CASE WHEN menu.prices IS NULL AND (contains(html, '<p>메뉴정보</p><div>') OR menu.lost > 0) THEN 'price: none in the menu' END,
    CASE WHEN contains(h, '25:10 - 26:70') THEN 'hours: hour 25, hour 26, minute 70' END, CASE WHEN len(im.u) > 0 AND len({_STRICT}) = 0 THEN 'images: no absolute address' END,
    CASE WHEN len(r) > 0 AND len(list_filter(r, lambda x: length(x) > {LEAST_TEXT})) = 0 THEN 'review: descriptions too short' END,
    CASE WHEN NOT length(regexp_replace(f2.phone, '[^0-9]', '', 'g')) BETWEEN 9 AND 11 THEN 'contact: no phone number: ' || f2.phone END, CASE WHEN NOT ({_INSIDE}) THEN 'coordinates: outside the country' END,
    CASE WHEN a3.links > 0 AND a3.address = '' THEN 'address: no part among its links' END,
    CASE WHEN len(list_filter({listed(THEME_WORDS)}, lambda w: contains(d.t, w))) > 0 AND refill.items IS NULL THEN 'refill: no priced item' END) AS errors
FROM d LEFT JOIN menu USING (page_id) JOIN a3 USING (page_id) JOIN c USING (page_id) JOIN f2 USING (page_id) JOIN im USING (page_id) JOIN rv USING (page_id) LEFT JOIN refill USING (page_id)""")
def detail_records(v):
    """Nine extractors over every detail page, and what went wrong."""
    out = detail_fields(v.dealt("detail_pages"))
    value = {name: F.col(f"{name}.value") for name in EXTRACTORS}
    menu = F.transform(value["menu"], lambda x: F.concat_ws("=", x["name"], x["price_numeric"].cast("string")))
    items = F.transform(value["refill"]["items"], lambda x: F.concat_ws("=", x["name"], x["price"].cast("string")))
    return out.select(
        "page_id", F.nullif(F.array_join(menu, "|"), F.lit("")).alias("menu"), F.coalesce(F.array_join(value["price"], "|"), F.lit("")).alias("prices"), value["hours"]["last_order"].alias("last_order"),
        value["hours"]["break_time"].alias("break_time"), value["hours"]["closed"].alias("closed"), F.array_join(value["images"], "|").alias("images"), value["review"]["description"].alias("description"),
        F.array_join(value["review"]["keywords"], ",").alias("keywords"), value["contact"]["phone"].alias("phone"), value["contact"]["website"].alias("website"), value["coordinates"]["lat"].alias("lat"),
        value["coordinates"]["lng"].alias("lng"), value["address"].alias("address"), value["refill"]["confirmed"].alias("confirmed"), F.array_join(items, "|").alias("items"), F.array_join("errors", "; ").alias("errors"),
    )
