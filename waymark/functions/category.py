"""Raw category words to standard categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions.columns import let

#: Keywords of each standard category. A keyword inside a text maps it (many to many).
KEYWORDS = {
    "고기": (
        "삼겹살", "갈비", "소고기", "돼지고기", "닭고기", "양고기", "오리고기", "고기무한리필", "소고기무한리필", "삼겹살무한리필", "스테이크", "바베큐", "BBQ", "구이",
        "육류",
    ),
    "해산물": (
        "초밥", "사시미", "스시", "회", "해산물", "해산물무한리필", "수산물", "생선", "조개", "새우", "게", "오징어", "문어",
    ),
    "양식": (
        "파스타", "피자", "스테이크", "이탈리안", "서양음식", "양식", "브런치", "샐러드", "버거", "햄버거",
    ),
    "한식": (
        "한식", "한국음식", "김치", "된장", "고추장", "비빔밥", "냉면", "불고기", "떡볶이", "순대", "족발", "보쌈", "곱창", "막창", "찜닭", "치킨", "분식",
    ),
    "중식": (
        "중식", "중국음식", "차이니즈", "짜장면", "짬뽕", "탕수육", "마파두부", "깐풍기", "양장피",
    ),
    "일식": (
        "일식", "일본음식", "초밥뷔페", "돈까스", "우동", "라멘", "소바", "야키토리", "가라아게", "덴푸라", "규동",
    ),
    "디저트": (
        "디저트", "케이크", "아이스크림", "빵", "베이커리", "쿠키", "마카롱", "타르트", "푸딩", "젤라토", "와플", "팬케이크", "카페", "커피",
    ),
}
#: Texts that are no categories.
NO_CATEGORY = "맛집$|역$|구$|할인|이벤트|오픈|신규|인기|유명|맛있는|좋은"
#: Ordered dictionaries for the one-to-one mappings; the first key inside the text, or around it, decides.
EXACT = {
    "고기": (
        "고기무한리필", "소고기무한리필", "삼겹살무한리필", "삼겹살", "갈비", "소고기", "돼지고기", "닭고기", "스테이크", "바베큐", "BBQ", "구이", "육류",
    ),
    "해산물": (
        "해산물무한리필", "해산물", "초밥", "초밥뷔페", "회", "사시미", "스시", "수산물", "생선",
    ),
    "양식": (
        "양식", "서양음식", "이탈리안", "파스타", "피자", "버거", "햄버거", "브런치", "샐러드",
    ),
    "한식": (
        "한식", "한국음식", "족발", "보쌈", "곱창", "막창", "치킨", "찜닭", "분식", "떡볶이", "냉면", "불고기",
    ),
    "중식": (
        "중식", "중국음식", "차이니즈", "짜장면", "짬뽕", "탕수육",
    ),
    "일식": (
        "일식", "일본음식", "돈까스", "우동", "라멘", "소바",
    ),
    "디저트": (
        "디저트", "카페", "케이크", "아이스크림", "베이커리", "빵",
    ),
}
REFILL = (
    ("무한리필", "무한리필"),
    ("고기무한리필", "고기"),
    ("소고기무한리필", "고기"),
    ("삼겹살무한리필", "고기"),
    ("삼겹살", "고기"),
    ("갈비", "고기"),
    ("뷔페", "뷔페"),
    ("초밥뷔페", "일식"),
    ("해산물무한리필", "해산물"),
    ("한식", "한식"),
    ("일식", "일식"),
    ("중식", "중식"),
    ("양식", "양식"),
    ("피자", "피자"),
    ("치킨", "치킨"),
)
DEFAULT, REFILL_DEFAULT = "한식", "무한리필"


def _entries(pairs) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("word"), F.lit(c).alias("category")) for k, c in pairs])


def _or_default(found: Column, default: str) -> Column:
    return let(found, lambda f: F.when(F.size(f) > 0, F.array_sort(F.array_distinct(f))).otherwise(F.array(F.lit(default))))


def map_many(raw: Column) -> Column:
    """Sorted standard categories of an array of raw texts by keywords inside them; the default if there is none."""
    pairs = [(k, c) for c, ks in KEYWORDS.items() for k in ks]
    clean = F.transform(raw, lambda t: F.lower(F.trim(F.replace(t, F.lit("#")))))
    kept = F.filter(clean, lambda t: t.isNotNull() & ~t.rlike(NO_CATEGORY))
    found = F.flatten(F.transform(kept, lambda t: F.transform(F.filter(_entries(pairs), lambda e: F.contains(t, e["word"])), lambda e: e["category"])))
    return _or_default(found, DEFAULT)


def map_first(raw: Column, pairs: list[tuple[str, str]], default: str) -> Column:
    """Sorted categories of an array of raw texts: the equal key, else the first key inside or around the text."""
    entries = _entries(pairs)

    def one(t: Column) -> Column:
        same = F.filter(entries, lambda e: e["word"] == t)
        around = F.filter(entries, lambda e: F.contains(t, e["word"]) | F.contains(e["word"], t))
        return F.coalesce(F.try_element_at(same, F.lit(-1))["category"], F.try_element_at(around, F.lit(1))["category"])

    kept = F.filter(raw, lambda t: F.coalesce(t, F.lit("")) != "")
    return _or_default(F.filter(F.transform(kept, one), lambda c: c.isNotNull()), default)


def map_exact(raw: Column) -> Column:
    return map_first(raw, [(k, c) for c, ks in EXACT.items() for k in ks], DEFAULT)


def map_refill(raw: Column) -> Column:
    """As map_first, with the refill category wherever a text speaks of refills."""
    found = map_first(F.transform(raw, F.trim), list(REFILL), REFILL_DEFAULT)
    said = F.exists(raw, lambda t: F.coalesce(t.contains("무한") | t.contains("리필"), F.lit(False)))
    return F.when(said, F.array_sort(F.array_union(found, F.array(F.lit(REFILL_DEFAULT))))).otherwise(found)
