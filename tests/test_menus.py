"""Mined menus against the same patterns in another engine, problems of hours, links by name, full-text ranks."""

import math
import random
import re
import time

from pyspark.sql import functions as F

from waymark.operators.menus import MENU, NOT_IN_NAMES, PRICED, PRICED_TABLE, clean_menu, hours_problems, named_links, refill_prices
from waymark.operators.search import fulltext
from waymark.queries import QUERIES


def by_loop_prices(text):
    out = []
    for pattern in PRICED:
        for name, price in re.findall(pattern, text, re.IGNORECASE):
            name, price = re.sub(r"^[a-z]\s+", "", name.strip()), int(price.replace(",", ""))
            if 3 <= len(name) <= 50 and not any(w in name for w in NOT_IN_NAMES) and 5000 <= price <= 50000:
                out.append((name, price))
    for pattern in PRICED_TABLE:
        for name, price in re.findall(pattern, text):
            name, price = re.sub(r"^[a-z]\s+", "", name.strip()), int(price.replace(",", ""))
            if 3 <= len(name) <= 50 and name not in [n for n, _ in out] and 5000 <= price <= 50000:
                out.append((name, price))
    return sorted(out, key=lambda x: x[1])


def by_loop_menu(text):
    out = []
    for pattern in MENU:
        for name, price in re.findall(pattern, text, re.IGNORECASE):
            name, price = re.sub(r"\s+", " ", re.sub(r"^[a-z]\s+", "", name.strip())), int(price.replace(",", ""))
            if 3 <= len(name) <= 30 and 5000 <= price <= 50000 and name not in [n for n, _ in out]:
                out.append((name, price))
    return sorted(out, key=lambda x: x[1])


def test_mined_menus(spark):
    rng = random.Random(1)
    words = ["a", "b ", "돼지모듬", "무한리필", "뷔페", "셀프바", "추천", "할인", "평일", "점심", "성인", "초등", "입장기준", "후기", "(2인)", "세트", "Set", "15시"]
    texts = []
    for _ in range(250):
        text = ""
        for _ in range(rng.randint(0, 8)):
            text += " ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) + rng.choice([" ", "\n", ": ", " - ", "  "])
            text += rng.choice(["", f"{rng.randint(1, 60)},{rng.randint(0, 9)}00원", f"{rng.randint(1, 60)},000 원", "9원", "시가"]) + rng.choice(["\n", " ", ", "])
        texts.append(text)
    df = spark.createDataFrame(list(enumerate([*texts, "", "원"])), "id int, t string")
    some = 0
    for r in df.select("id", "t", refill_prices(F.col("t")).alias("p"), clean_menu(F.col("t")).alias("m")).collect():
        assert [tuple(x) for x in r.p] == by_loop_prices(r.t), r.t
        assert [tuple(x) for x in r.m] == by_loop_menu(r.t), r.t
        some += len(r.p)
    assert some > 100
    assert spark.range(1).select(refill_prices(F.lit(None).cast("string")).alias("p")).first().p is None


def test_long_runs_without_a_price_are_scanned_once(spark):
    text = "무한리필 뷔페 추천 " * 500
    df = spark.createDataFrame([(text + "\n, 성인 초밥 뷔페 12,000원",)], "t string")
    began = time.monotonic()
    got = df.select(clean_menu(F.col("t")).alias("m"), refill_prices(F.col("t")).alias("p")).first()
    assert time.monotonic() - began < 30
    assert [tuple(x) for x in got.m] == [("성인 초밥 뷔페", 12000)] and [tuple(x) for x in got.p] == [("성인 초밥 뷔페", 12000)]


def test_menu_texts_are_dealt_to_many_tasks(spark):
    for name in ("clean_menu_items", "refill_price_items"):
        assert "RoundRobinPartitioning" in QUERIES[name](spark, "/root/testdata/sf0.1")._jdf.queryExecution().executedPlan().toString(), name


def test_problems_of_hours(spark):
    rows = [
        (1, "24시간 영업", "", "21:00"), (2, "24시간", " ", None), (3, "25:10 - 26:70", None, None), (4, "22:00 - 11:00", "15:00 - 16:00", None), (5, "11:00 - 22:00", "23:00 ~ 23:30", ""), (6, None, "1:00 - 2:00", "x"), (7, "연중무휴", None, None),
    ]
    got = {}
    for r in hours_problems(spark.createDataFrame(rows, "id int, open_hours string, break_time string, last_order string")).collect():
        got.setdefault(r.id, []).append((r.issue_type, r.description))
    assert {k: sorted(x[0] for x in v) for k, v in got.items()} == {
        1: ["24hour_conflict"], 3: ["invalid_time_format"] * 3, 4: ["business_hours_logic_error"] * 2, 5: ["business_hours_logic_error"],
    }
    assert hours_problems(spark.createDataFrame(rows, "id int, open_hours string, break_time string, last_order string").limit(0)).count() == 0


def test_links_by_name(spark):
    named = spark.createDataFrame([("a", ["x", "y", "x"]), ("b", ["z", None]), ("c", []), ("d", None)], "place_id string, names array<string>")
    categories = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id long, name string")
    assert sorted(map(tuple, named_links(named, categories).collect())) == [("a", 1), ("a", 2)]


def test_full_text_counts_whole_words(spark):
    texts = ["The cat and the dog", "theory and andes the", "and", None, "", "THE-and the_and éthe and", "the. and"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: (r.n_words, r["rank"]) for r in fulltext(df, ["the", "and"]).collect()}
    want = {}
    for i, t in enumerate(texts):
        words = [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
        a, b = words.count("the"), words.count("and")
        if a and b:
            want[i] = (len(words), round((a + b) / (1 + math.log(max(1, len(words)))), 6))
    assert got == want
    assert [r.doc_id for r in fulltext(df, ["the", "and"], most=2).collect()] == sorted(want, key=lambda i: (-want[i][1], i))[:2]
