"""Addresses, phone numbers, names, categories, menus and URLs, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions.columns import blank_to_null, chain, extract, first_match, let

#: Parts that are dropped from addresses, and the pattern of each component.
ADDRESS_NOISE = (r"\([^)]*\)", r"[0-9]+층", r"[0-9]+호", "근처", "앞", "옆", "건물", "상가")
ADDRESS_PARTS = {
    "sido": "(서울|부산|대구|인천|광주|대전|울산|세종|경기|강원|충북|충남|전북|전남|경북|경남|제주)",
    "sigungu": "([가-힣]+시|[가-힣]+군|[가-힣]+구)",
    "dong": "([가-힣]+동|[가-힣]+읍|[가-힣]+면)",
    "road": "([가-힣]+로|[가-힣]+길)",
    "building_number": "([0-9]+(-[0-9]+)?)",
}
PHONES = (r"(0\d{1,2}-\d{3,4}-\d{4})", r"(0\d{9,10})", r"(\d{3}-\d{3,4}-\d{4})")


def normalise_address(address: Column) -> Column:
    out = F.trim(F.coalesce(address, F.lit("")))
    for pattern in ADDRESS_NOISE:
        out = F.regexp_replace(out, pattern, "")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def address_part(address: Column, part: str) -> Column:
    return extract(address, ADDRESS_PARTS[part])


def with_province(address: Column, neighbour: Column | None = None) -> Column:
    """The address with a province in front: its neighbours' if known, else the capital."""
    default = F.lit("서울") if neighbour is None else F.coalesce(address_part(neighbour, "sido"), F.lit("서울"))
    return F.when(address_part(address, "sido").isNotNull(), address).otherwise(F.concat_ws(" ", default, address))


def letters(text: Column) -> Column:
    """The distinct characters of a text."""
    return F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))


def set_jaccard(x: Column, y: Column) -> Column:
    """Shared members by all members of two arrays of distinct members; null if both are empty."""
    shared = F.size(F.array_intersect(x, y)).cast("double")
    return F.try_divide(shared, (F.size(x) + F.size(y)).cast("double") - shared)


def char_jaccard(a: Column, b: Column) -> Column:
    """Shared characters by all characters of two texts; null if both are empty."""
    return set_jaccard(letters(a), letters(b))


def match_name(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[^가-힣a-z0-9]", "")


def name_similarity(a: Column, b: Column) -> Column:
    """1 for equal cleaned names, 0 if a raw name is empty, else shared characters of the cleaned names."""
    empty = (F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == "")
    x, y = match_name(a), match_name(b)
    return F.when(empty, 0.0).when(x == y, 1.0).otherwise(F.coalesce(char_jaccard(x, y), F.lit(0.0)))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def format_phone(phone: Column) -> Column:
    """Hyphens by length and prefix; a prefix that lost its 05 gets it back; other numbers stay as they are."""
    return let(phone, _format_phone)


def _format_phone(phone: Column) -> Column:
    bare = F.replace(phone, F.lit("-"), F.lit(""))
    bare = F.regexp_replace(F.regexp_replace(bare, r"^07(\d{8})$", "0507$1"), r"^08(\d{8})$", "0508$1")
    return let(bare, lambda d: F.coalesce(_hyphens(d), phone))


def _hyphens(bare: Column) -> Column:
    n = F.length(bare)

    def cut(a: int, b: int) -> Column:
        return F.concat_ws("-", F.substring(bare, 1, a), F.substring(bare, a + 1, b), F.substring(bare, a + b + 1, 8))

    return chain(
        [
            ((n == 11) & bare.startswith("010"), cut(3, 4)),
            ((n == 11) & bare.rlike("^(0507|0508|070)"), cut(4, 4)),
            ((n == 10) & bare.startswith("02"), cut(2, 4)),
            (n == 10, cut(3, 3)),
            ((n == 9) & bare.startswith("02"), cut(2, 3)),
        ]
    )


def repair_phone(phone: Column) -> Column:
    return F.regexp_replace(phone, "^07-", "0507-")


def plausible_phone(phone: Column) -> Column:
    """9 to 11 digits, not all equal, no counting run."""
    d = digits(F.coalesce(phone, F.lit("")))
    return F.length(d).between(9, 11) & ~d.rlike(r"^(\d)\1*$") & ~d.contains("1234567890") & ~d.contains("0987654321")


def find_phone(text: Column) -> Column:
    return format_phone(first_match(text, list(PHONES)))


def query_parameter(url: Column, name: str) -> Column:
    return extract(url, rf"[?&]{name}=([^&#]*)")


def first_link(html: Column, own_host: str) -> Column:
    """First absolute link that leads elsewhere."""
    links = F.regexp_extract_all(html, F.lit('href="(https?://[^"]+)"'), 1)
    return F.try_element_at(F.filter(links, lambda u: ~u.contains(own_host)), F.lit(1))


def strip_ordinal(name: Column) -> Column:
    return F.regexp_replace(name, r"^\d+(\.\s*|\s+)", "")


def slug(name: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(name, "[가-힣]", ""), r"(?U)[^\w\s-]", "")
    return F.coalesce(blank_to_null(F.regexp_replace(F.regexp_replace(F.trim(bare), r"[\s-]+", "_"), "_+", "_")), F.lit("store"))


def cache_key(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), F.lit(":"), F.substring(F.sha2(key, 256), 1, 16))


def district_code(address: Column, codes: dict[str, str]) -> Column:
    return chain([(address.contains(name), F.lit(code)) for name, code in codes.items()], F.lit("others"))


MENU = "array<struct<name:string,price:string,price_numeric:int,is_recommended:boolean,type:string,description:string>>"


def menu_items(text: Column) -> Column:
    """Menu items of a JSON text with defaults filled; nameless items are dropped; null for no array."""
    items = F.filter(F.from_json(text, MENU), lambda m: F.coalesce(m["name"], F.lit("")) != "")
    return F.transform(
        items,
        lambda m: F.struct(
            m["name"].alias("name"),
            F.coalesce(m["price"], F.lit("")).alias("price"),
            F.coalesce(m["price_numeric"], F.lit(0)).alias("price_numeric"),
            F.coalesce(m["is_recommended"], F.lit(False)).alias("is_recommended"),
        ),
    )


def refill_type(text: Column) -> Column:
    """Type by the first group of words that the text holds."""
    return chain(
        [
            (text.rlike("고기|삼겹살|소고기"), F.lit("고기무한리필")),
            (text.rlike("초밥|회"), F.lit("초밥뷔페")),
            (text.contains("뷔페"), F.lit("뷔페")),
            (text.contains("셀프바"), F.lit("셀프바")),
        ],
        F.lit("무한리필"),
    )


def error_class(message: Column) -> Column:
    low = F.lower(message)
    return chain(
        [
            (low.contains("element not found") | low.contains("no such element"), F.lit("selector_missing")),
            (low.contains("timeout"), F.lit("timeout")),
            (low.contains("blocked") | low.contains("forbidden"), F.lit("ip_blocked")),
            (low.contains("rate limit"), F.lit("rate_limit")),
        ],
        F.lit("unknown"),
    )
