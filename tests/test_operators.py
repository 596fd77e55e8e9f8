"""Goldens, brute force and properties for the place operators."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waymark.functions import hours as H
from waymark.functions.geo import haversine_m
from waymark.functions.price import parse_price
from waymark.functions.text import format_phone, name_similarity, plausible_phone, slug, strip_ordinal
from waymark.operators import entity
from waymark.operators.entity import duplicate_groups, duplicate_pairs, golden_records, member_pairs, similar_classes
from waymark.operators.lifecycle import upsert
from waymark.operators.logs import adaptive_delays, delay_after
from waymark.plans.durable import components, first_seeds, forget, free_name, written
from waymark.sources.tables import append_distinct, insert_statements, read, write_by_month, write_json_lines
from waymark.streaming import windows


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


PRICES = {
    "1만원": ("single", 10000, 10000, 0.9),
    "10,000원~15,000원": ("range", 10000, 15000, 0.9),
    "런치 8천원, 디너 1만2천원": ("time_based", 1000, 12000, 0.85),
    "1인 12000원 (2인 이상)": ("conditional", 12000, 12000, 0.8),
    "무한리필 19900원": ("range", 19900, 19900, 0.7),
    "가격 문의": ("inquiry", None, None, 0.9),
    "2만원대": ("range", 20000, 29999, 0.8),
    "평일 1만8천원, 주말 2만2천원": ("time_based", 18000, 22000, 0.85),
    "소고기 2만원, 돼지고기 1만5천원": ("range", 15000, 20000, 0.7),
    "": ("unknown", None, None, 0.0),
    None: ("unknown", None, None, 0.0),
}


def test_price_goldens(spark):
    df = spark.createDataFrame([(t,) for t in PRICES], "t string").select("t", F.inline(F.array(parse_price(F.col("t")))))
    assert {r.t: (r.price_type, r.min_price, r.max_price, r.confidence) for r in df.collect()} == PRICES


def test_text_goldens(spark):
    df = spark.createDataFrame([("07-1234-5678",), ("0212345678",), ("01012345678",), ("021234567",), ("031-123-4567",), ("123",)], "p string")
    got = [r[0] for r in df.select(format_phone(F.col("p"))).collect()]
    assert got == ["07-1234-5678", "02-1234-5678", "010-1234-5678", "02-123-4567", "031-123-4567", "123"]
    assert [one(spark, plausible_phone(F.lit(p))) for p in ("02-1234-5678", "1111111111", "1234567890", "12")] == [True, False, False, False]
    assert one(spark, strip_ordinal(F.lit("12. Name"))) == "Name" and one(spark, slug(F.lit("가게 My Shop!"))) == "My_Shop"
    assert one(spark, name_similarity(F.lit("Store 1"), F.lit("store1"))) == 1.0 and one(spark, name_similarity(F.lit(""), F.lit(""))) == 0.0


def test_hours_goldens(spark):
    assert one(spark, H.standardise(F.lit("오후 3시 30분~오전 9시"))) == "15:30 - 9:00"
    assert one(spark, H.last_order(F.lit("L.O: 21:30"))) == "21:30"
    text = F.lit("7월 4일(금) 7월 5일(토) 영업시간: 11:00 - 23:00")
    assert one(spark, H.day_hours(text)) == {"금": "11:00-23:00", "토": "11:00-23:00"}
    assert one(spark, H.logic_issues(F.lit("11:00-22:00"), F.lit("23:00~23:30"))) == ["break outside 1380-1410"]


@settings(max_examples=15, deadline=None)
@given(st.floats(33, 39), st.floats(124, 132), st.floats(33, 39), st.floats(124, 132))
def test_haversine(spark, a, b, c, d):
    got = one(spark, haversine_m(F.lit(a), F.lit(b), F.lit(c), F.lit(d)))
    x = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    assert got == pytest.approx(2 * 6371000 * math.asin(math.sqrt(x)), abs=1e-3)


def greedy(n, pairs):
    adjacent = {frozenset(p) for p in pairs}
    seed = {}
    for i in range(n):
        if i not in seed:
            for j in range(i + 1, n):
                if j not in seed and frozenset((i, j)) in adjacent:
                    seed[j] = i
                    seed[i] = i
    return seed


def test_greedy_groups_against_the_loop(spark):
    rng = random.Random(1)
    for _ in range(4):
        n = 40
        pairs = sorted({tuple(sorted(rng.sample(range(n), 2))) for _ in range(rng.choice([10, 30, 60]))})
        got = {r.member: r.seed for r in first_seeds(spark.createDataFrame(pairs, "i long, j long")).collect()}
        want = greedy(n, pairs)
        assert {m: s for m, s in got.items() if m != s or m in want.values()} == want
    assert first_seeds(spark.createDataFrame([], "i long, j long")).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 101: 100}


def test_written_tables_can_be_deleted(spark):
    table = written(spark.range(5))
    assert table.count() == 5
    forget(table)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(table.written_to).count()


def test_free_names(spark):
    df = spark.createDataFrame([(1, 2)], "id int, ID__ int")
    assert free_name(df, "id") == "id_" and free_name(df, "id_") == "id_" and free_name(df, "id__") == "id___"


def place(seq, name, lat, lng, phone):
    return (seq, str(seq), name, "addr" if seq % 2 else "", lat, lng, phone)


SCHEMA = "seq long, place_id string, name string, address string, lat double, lng double, phone string"


def test_blocking_misses_no_pair(spark):
    rng = random.Random(2)
    rows = [
        place(i, rng.choice(["Store A", "Store B", "Storé A", "", None]), 37.5 + rng.random() * 0.01, 127 + rng.random() * 0.01, rng.choice(["02-1234-5678", "0212345678", "12", None, f"010{i:08d}"]))
        for i in range(60)
    ] + [place(60, "Store A", None, None, None), place(61, "Store A", 0.0, 0.0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.i, r.j) for r in duplicate_pairs(df).collect()}
    both = df.alias("l").join(df.alias("r"), F.col("l.seq") < F.col("r.seq"))
    far = haversine_m(F.col("l.lat"), F.col("l.lng"), F.col("r.lat"), F.col("r.lng"))
    real = (F.col("l.lat") != 0) & (F.col("r.lat") != 0)
    alike = name_similarity(F.col("l.name"), F.col("r.name"))
    digits = [F.regexp_replace(F.col(f"{s}.phone"), "[^0-9]", "") for s in "lr"]
    rule = (F.length(digits[0]) >= 8) & (digits[0] == digits[1]) | real & ((alike > 0.9) & (far < 50) | (alike > 0.85) & (far < 200))
    assert got == {(r[0], r[1]) for r in both.where(rule).select("l.seq", "r.seq").collect()}


def test_golden_records(spark):
    rows = [place(0, "A", None, None, None), place(1, "A", 37.5, 127.0, ""), place(2, "", 37.6, 127.1, "02-1")]
    groups = spark.createDataFrame([(0, 0), (1, 0), (2, 0)], "member long, seed long")
    r = golden_records(spark.createDataFrame(rows, SCHEMA), groups).first()
    assert (r.place_id, r.name, r.address, r.lat, r.phone, r.merged) == ("1", "A", "addr", 37.5, "02-1", 3)


def test_upsert_is_ordered_and_idempotent(spark):
    target = spark.createDataFrame([("a", "x", "open"), ("b", "y", "open")], "k string, v string, s string")
    batch = spark.createDataFrame([("a", 1, "n1", "closed"), ("a", 2, None, None), ("c", 1, "n", "open")], "k string, o long, v string, s string")
    once = upsert(target, batch, "k", "o", ["v"], ["s"])
    want = [("a", "n1", None), ("b", "y", "open"), ("c", "n", "open")]
    assert sorted(map(tuple, once.collect())) == want and sorted(map(tuple, upsert(once, batch, "k", "o", ["v"], ["s"]).collect())) == want


def test_adaptive_delay(spark):
    rng = random.Random(3)
    log = [(i, rng.randrange(5), rng.random() < 0.8) for i in range(400)]
    df = spark.createDataFrame(log, "o long, k long, ok boolean")
    got = {r.k: (r.delay, r.n) for r in adaptive_delays(df, "k", ["o"], F.col("ok")).collect()}
    for k in range(5):
        mine = [ok for _, x, ok in log if x == k]
        assert got[k] == (delay_after(mine)[0], len(mine))


def test_sources_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a'b", ["x", "y"]), (2, None, None)], "id long, name string, tags array<string>")
    assert [r[0] for r in insert_statements(df, "t").collect()] == [
        "INSERT INTO t (id, name, tags) VALUES (1, 'a''b', ARRAY['x', 'y']) ON CONFLICT DO NOTHING;",
        "INSERT INTO t (id, name, tags) VALUES (2, NULL, NULL) ON CONFLICT DO NOTHING;",
    ]
    for _ in range(2):
        append_distinct(df.union(df), f"{tmp_path}/t", "id")
        write_json_lines(df, f"{tmp_path}/j")
    assert read(spark, f"{tmp_path}/t").count() == 2
    assert read(spark, f"{tmp_path}/j", "json", "id long, name string").where("id = 1").count() == 2
    stamped = df.withColumn("ts", F.lit("2024-03-05").cast("timestamp"))
    write_by_month(stamped, f"{tmp_path}/m", "ts")
    assert read(spark, f"{tmp_path}/m").where("month = 3").count() == 2


def test_streams(spark, tmp_path):
    events = [(i, f"2024-01-01 0{i % 9}:{i % 60:02d}:00", i % 4, "error" if i % 3 == 0 else "click") for i in range(200)]
    df = spark.createDataFrame(events, "event_id long, ts string, user_id long, event_type string").withColumn("ts", F.to_timestamp("ts"))
    df.repartition(4).write.parquet(f"{tmp_path}/e")
    stream = windows.read_events(spark, f"{tmp_path}/e", 1)
    windows.run_available(windows.fresh_only(stream, "user_id"), f"{tmp_path}/o", f"{tmp_path}/c")
    assert read(spark, f"{tmp_path}/o").select("user_id").distinct().count() == 4 == read(spark, f"{tmp_path}/o").count()
    windows.run_available(windows.sessions(stream, "user_id"), f"{tmp_path}/s", f"{tmp_path}/sc")
    failures = stream.withColumn("error_message", F.lit("No such element"))
    windows.run_available(windows.failure_patterns(failures), f"{tmp_path}/p", f"{tmp_path}/pc")
    assert read(spark, f"{tmp_path}/p").where("NOT changed").count() == 0


def test_folded_states_equal_the_loop(spark):
    from waymark.operators.logs import folded, health_after

    start = (100, 0, True, 0.0)
    rows = [(None if k == 4 else k, i, (i * 7 + k) % 4 == 0, float(i * 900 + (5000 if i % 11 == 0 else 0))) for k in range(5) for i in range(60)]
    log = spark.createDataFrame(rows, "host long, i long, ok boolean, at double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        schema = "score long, failures long, active boolean, last double"
        got = folded(log, "host", ["i"], [F.col("ok"), F.col("at")], start, health_after, schema).collect()
        assert folded(log.limit(0), "host", ["i"], [F.col("ok"), F.col("at")], start, health_after, schema).collect() == []
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for host, i, ok, at in rows:
        want.setdefault(host, []).append((ok, at))
    assert len(got) == len(want)
    for r in got:
        state = health_after(start, *map(list, zip(*want[r.host])))
        assert (r.score, r.failures, r.active, r.last, r.n) == (*state, 60)


def test_health_of_a_host():
    from waymark.operators.logs import health_after

    off = health_after((100, 0, True, 0.0), [False] * 3, [1.0, 2.0, 3.0])
    assert off == (70, 3, False, 3.0)
    assert health_after(off, [True], [3603.0]) == (75, 2, False, 3603.0)
    assert health_after(off, [False], [3604.0]) == (60, 1, True, 3604.0)


def test_estimated_locations_ties_and_missing_parts(spark):
    from waymark.operators.addresses import estimate_locations

    rows = [
        (1, "서울 강남구 가나로 12", 37.1, 127.1), (2, "서울 강남구 가나로 12", 37.2, 127.2), (3, "서울 강남구 가나로 99", 37.3, 127.3),
        (4, "서울 강남구 가나로 12", None, None), (5, "부산", None, None), (6, "부산", 35.1, 129.1), (7, None, None, None),
        (8, "서울 다라동 5", 37.8, 127.8), (9, "가나로 다라동 5", None, None), (10, "마바로 1", None, 127.0),
    ]
    got = {r.seq: r for r in estimate_locations(spark.createDataFrame(rows, "seq long, address string, lat double, lng double")).collect()}
    assert (got[4].from_seq, got[4].lat, got[4].lng, got[4].source, got[4].confidence) == (1, 37.1, 127.1, "estimated", 0.6)
    assert got[9].from_seq == 8
    assert [got[i].source for i in (1, 5, 6, 7, 10)] == ["given", "none", "given", "none", "none"]
    assert got[5].lat is None and got[10].lng is None and got[1].from_seq is None


def test_pairs_and_groups_of_copies_are_made_from_classes(spark, monkeypatch):
    monkeypatch.setattr(entity, "MEMBERS", 4)
    rng = random.Random(5)
    spots = [(37.5 + 0.0004 * (i % 3), 127.0, n) for i in range(3) for n in ("abcdefg", "abcdefgh", "xyz", "")] + [(None, None, "abcdefg"), (0.0, 127.0, "xyz")]
    rows = []
    for seq in range(160):
        lat, lng, name = rng.choice(spots)
        rows.append((seq, str(seq), name, "a", lat, lng, rng.choice([None, "", "12", "02-1111-1111", "0211111111", f"02-2222-000{rng.randint(0, 9)}"])))
    df = spark.createDataFrame(rows, "seq long, place_id string, name string, address string, lat double, lng double, phone string")

    def near(a, b):
        if not (a[4] and b[4] and a[2] and b[2]):
            return False
        x, y, metres = set(a[2]), set(b[2]), 6371000 * math.radians(abs(a[4] - b[4]))
        alike = len(x & y) / len(x | y)
        return (alike > 0.9 and metres < 50) or (alike > 0.85 and metres < 200)

    def phone(r):
        return "".join(c for c in r[6] or "" if c.isdigit())

    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and (near(a, b) or (len(phone(a)) >= 8 and phone(a) == phone(b)))}
    got = [tuple(r) for r in duplicate_pairs(df).collect()]
    assert len(got) == len(want) and set(got) == want
    pairs = spark.createDataFrame(sorted(want), "i long, j long")
    assert sorted(map(tuple, duplicate_groups(df).collect())) == sorted(map(tuple, first_seeds(pairs).collect()))
    assert duplicate_groups(df.limit(0)).count() == 0 and duplicate_pairs(df.limit(0)).count() == 0


def test_a_crowd_of_copies_is_one_class(spark):
    df = spark.range(3000).select(F.col("id").alias("seq"), F.lit("same name").alias("name"), F.lit("same road").alias("address"), F.lit(None).cast("string").alias("phone"))
    members, links = similar_classes(df, 0.9)
    assert links.count() == 1 and members.count() == 3000
    pairs = member_pairs(members, links)
    assert pairs.count() == 3000 * 2999 // 2 and pairs.distinct().count() == 3000 * 2999 // 2 and pairs.where("i >= j OR cosine < 0.9").count() == 0


def test_a_task_holds_the_pairs_of_one_row_only(spark):
    members = spark.createDataFrame([(i % 50, 1 + i // 40) for i in range(80)], "seq long, group long")
    links = spark.createDataFrame([(1, 1), (1, 2)], "a long, b long")
    pairs = member_pairs(members, links)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    # two explodes in one step hold all that both make of a row
    assert plan.index("Generate explode") < plan.index("Coalesce") < plan.index("Generate posexplode")
    one, two = ([i % 50 for i in range(a, a + 40)] for a in (0, 40))
    want = [(x, y) for x in one for y in one if x < y] + [(min(x, y), max(x, y)) for x in one for y in two if x != y]
    assert sorted(map(tuple, pairs.collect())) == sorted(want)


def test_cosines_are_rounded_before_pairs_are_made(spark):
    from waymark.queries import QUERIES

    pairs = QUERIES["tfidf_similar_pairs"](spark, "/root/testdata/sf0.001")
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert pairs.columns == ["i", "j", "cosine"]
    assert plan.count("round(") == 1 and plan.index("Generate explode") < plan.index("round(")
