"""Descriptions, prices, images and menu entries of the three migrations: nulls, empties, limits."""

from pyspark.sql import functions as F

from waymark.operators.variants import description, images, price, refill_entries

TEXTS = "name string, description string, refill_type string, refill_conditions string, atmosphere string, review_summary string, keywords array<string>"


def test_descriptions(spark):
    rows = [("n", None, None, None, None, None, None), ("n", "", "", "", "", "", []), ("n", "d" * 600, "t", None, "m", None, list("abcdefg")), (None, None, "t", "c", None, "r", ["k"])]
    df = spark.createDataFrame(rows, TEXTS)
    got = [tuple(r) for r in df.select(description("full"), description("short"), description("plain")).collect()]
    assert got[0] == got[1] == ("", None, "n 무한리필 전문점")
    assert got[2] == ("d" * 500,) * 3
    assert got[3] == ("t 전문점 | 리필 조건: c | r | 키워드: k", "t 전문점 | 특징: k", "t 전문점")


def test_prices(spark):
    rows = [(" 1 ", "2", "3", ["4"]), ("", " 2 ", None, ["4"]), (None, None, "", ["", "5", "6", "", "7", "8"]), (None, "", None, []), (None, None, None, None)]
    df = spark.createDataFrame(rows, "price string, average_price string, price_range string, price_details array<string>")
    assert [tuple(r) for r in df.select(price("full"), price("short"), price("plain")).collect()] == [(" 1 ", "1", "1"), ("4", "2", "2"), ("", "5, 6, 7", None), (None, None, None), (None, None, None)]


def test_images(spark):
    rows = [("//a", None, ["http://b", "http://b", "x", None]), (None, "data\\y", None), ("ftp://z", "", []), ("https://m", "no", ["https://5", "https://4", "https://3", "https://2", "https://1"])]
    df = spark.createDataFrame(rows, "main_image string, main_image_local string, image_urls array<string>")
    got = [tuple(map(list, r)) for r in df.select(images("full"), images("short"), images("plain")).collect()]
    assert got == [(["//a"], ["http://b"], ["//a"]), ([], [], ["data\\y"]), ([], [], []), (["https://m"], [f"https://{i}" for i in range(1, 6)], [])]


def test_entries(spark):
    rows = [('[{"name":"a","order":2},{"price":"1"}]', ["x"], "고기 무한리필"), ("[]", [" x ", " "], "t"), ("broken", [], "소 고기  무한리필 점"), (None, None, " 무한리필"), (None, [" "], None)]
    df = spark.createDataFrame(rows, "menu_items string, refill_items array<string>, refill_type string")
    got = [r.e for r in df.select(refill_entries().alias("e")).collect()]
    assert [(e.name, e.type, e.order, e.description, e.source) for e in got[0]] == [("a", "menu_item", 2, None, None)]
    assert [(e.name, e.type, e.is_recommended, e.description) for e in got[1]] == [("x", "refill_item", False, "")]
    assert [(e.name, e.type, e.is_recommended, e.description) for e in got[2]] == [("소 고기", "refill_type", True, "소 고기  무한리필 점")]
    assert not got[3] and not got[4]
    assert df.limit(0).select(F.explode(refill_entries())).count() == 0
