"""Neighbours by words, likest addresses, positions in steps, distances on the ellipsoid."""


import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.functions.geo import geodesic, geodesic_box, geodesic_m
from waymark.operators.addresses import geocode, likest_sets, sharing_two_words


def test_words_equal_brute_force(spark):
    rng = random.Random(1)
    words = ["a", "b", "c", "d", "e", "common", "all"]
    rows = []
    for i in range(160):
        address = None if i % 40 == 0 else " ".join(["all"] + [rng.choice(words) for _ in range(rng.randint(0, 4))])
        rows.append((i, address, None if rng.random() < 0.4 else 1.0))
    df = spark.createDataFrame(rows, "seq long, address string, lat double")
    for most in (3, 10):
        got = {}
        for r in sharing_two_words(df, most).collect():
            got.setdefault(r.seq, []).append((r.other, r.n))
        for i, address, lat in rows:
            if lat is None and address is not None:
                shared = [(j, len(set(address.split(" ")) & set(b.split(" ")))) for j, b, y in rows if y is not None and b is not None]
                assert sorted(got.get(i, [])) == [x for x in shared if x[1] >= 2][:most]
            else:
                assert i not in got
    assert sharing_two_words(df.limit(0)).count() == 0


def distinct_addresses(n):
    return [(i, f"서울 강남구 테헤란로 {i}", None if i % 2 else 37.5, None if i % 2 else 127.0) for i in range(n)]


def test_double_the_addresses_about_double_the_time(spark):
    took = []
    for n in (500, 4_000, 8_000):
        df = spark.createDataFrame(distinct_addresses(n), "seq long, address string, lat double, lng double")
        start = time.perf_counter()
        assert sharing_two_words(df).count() == n // 2 * 10
        took.append(time.perf_counter() - start)
    assert took[2] < 3 * took[1] + 2, took


def test_likest_sets_equal_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"

    def some():
        return "".join(sorted(rng.sample(letters, rng.randint(1, 14))))

    for thresholds in ((0.9, 0.75, 0.6), (0.8,), ()):
        monkeypatch.setattr("waymark.operators.addresses.THRESHOLDS", thresholds)
        monkeypatch.setattr("waymark.operators.addresses.BLOCK", 7)
        known = [(rng.choice("pq"), some()) for _ in range(120)]
        known = [(p, c, i) for i, (p, c) in enumerate(dict.fromkeys(known))]
        lost = [(rng.choice("pqr"), some()) for _ in range(60)] + [(p, "".join(sorted(set(c[:-1] + rng.choice(letters))))) for p, c, _ in known[:60]] + [known[5][:2]]
        left = spark.createDataFrame([(p, list(c)) for p, c in lost], "part string, chars array<string>")
        right = spark.createDataFrame([(p, list(c), (i, i / 7, 1.0)) for p, c, i in known], "part string, theirs array<string>, best struct<seq:long,lat:double,lng:double>")
        got = {(r.part, "".join(r.chars)): (r.best.seq, round(r.alike, 9)) for r in likest_sets(left, right).collect()}
        for p, c in lost:
            options = [(-len(set(c) & set(k)) / len(set(c) | set(k)), i) for q, k, i in known if q == p]
            want = min(options, default=None)
            assert got.get((p, c)) == (want and (want[1], round(-want[0], 9))), (p, c)


def test_steps_of_the_cascade(spark):
    rows = [
        (1, "서울 강남구 테헤란로 1", 37.5, 127.03), (2, "강남구 테헤란로 1 (지하)", None, None), (3, "서울 강남구 테헤란로 12", None, None), (4, "부산 해운대로 5", 37.5, 127.0), (5, None, None, None),
        (6, None, 37.51, 127.01), (7, "서울 없는길 3", 0.0, 0.0), (8, " ", None, 127.0),
    ]
    df = spark.createDataFrame(rows, "seq long, address string, lat double, lng double")
    got = {r.seq: (r.source, r.lat, r.confidence) for r in geocode(df).collect()}
    assert got == {
        1: ("given", 37.5, 1.0), 2: ("lookup", 37.5, 0.9), 3: ("estimated", 37.5, 0.6), 4: ("none", None, 0.0), 5: ("none", None, 0.0), 6: ("given", 37.51, 1.0), 7: ("none", None, 0.0), 8: ("none", None, 0.0),
    }
    table = spark.createDataFrame([("서울 없는길 3", 37.6, 127.0), ("서울 강남구 테헤란로 12", 10.0, 10.0)], "address string, lat double, lng double")
    got = {r.seq: (r.source, r.lat) for r in geocode(df, table).collect()}
    assert got[7] == ("lookup", 37.6) and got[3] == ("estimated", 37.5)  # what is looked up must be plausible
    assert geocode(df.limit(0)).count() == 0


@pytest.mark.parametrize("line", [
    # published lines: Flinders Peak to Buninyong; a degree of the equator; a quarter of a meridian; Wellington to Salamanca
    (-37.951033416666666, 144.42486788888888, -37.65282113888889, 143.92649552777777, 54_972.271),
    (0.0, 0.0, 0.0, 1.0, 111_319.491),
    (0.0, 0.0, 90.0, 0.0, 10_001_965.729),
    (-41.32, 174.81, 40.96, -5.50, 19_959_679.267),
])
def test_published_lines_within_a_millimetre(line):
    *points, metres = line
    assert abs(geodesic(*points) - metres) < 0.001
    assert abs(geodesic(points[2], points[3], points[0], points[1]) - metres) < 0.001


def test_ellipsoid_edges(spark):
    assert geodesic(10, 20, 10, 20) == 0 and np.isnan(geodesic(0, 0, 0.5, 179.7)) and np.isnan(geodesic(91, 0, 0, 0)) and np.isnan(geodesic(None, 0, 0, 0))
    assert abs(geodesic(0, 179.5, 0, -179.5) - 111_319.491) < 0.001
    assert geodesic([], [], [], []).shape == (0,)
    df = spark.createDataFrame([(37.5, 127.0), (None, 1.0), (37.5, None)], "lat double, lng double")
    got = [r.m for r in df.select(geodesic_m(F.col("lat"), F.col("lng"), F.lit(37.5), F.lit(127.0)).alias("m")).collect()]
    assert got == [0.0, None, None]


def test_the_box_holds_the_circle(spark):
    rng = np.random.default_rng(1)
    for lat, lng, metres in ((37.5, 127.0, 3_000.0), (0.0, 0.0, 500_000.0), (70.0, 20.0, 900_000.0), (-89.5, 10.0, 100_000.0), (10.0, 179.9, 50_000.0)):
        reach = metres / 100_000
        points = np.stack([np.clip(lat + rng.uniform(-reach, reach, 4000), -90, 90), (lng + rng.uniform(-1, 1, 4000) * reach / max(0.05, np.cos(np.radians(lat))) + 180) % 360 - 180], axis=1)
        near = geodesic(points[:, 0], points[:, 1], lat, lng) <= metres
        df = spark.createDataFrame([(float(a), float(b), bool(n)) for (a, b), n in zip(points, near, strict=True)], "lat double, lng double, near boolean")
        assert near.sum() > 100
        assert df.where("near").where(~geodesic_box(F.col("lat"), F.col("lng"), (lat, lng), metres)).count() == 0


def test_equal_parts_only(spark):
    known = spark.createDataFrame([("x", ["a"], (1, 1.0, 1.0))], "part string, theirs array<string>, best struct<seq:long,lat:double,lng:double>")
    lost = spark.createDataFrame([("y", ["a"])], "part string, chars array<string>")
    assert likest_sets(lost, known).count() == 0
    assert likest_sets(lost.limit(0), known).count() == 0 and likest_sets(lost, known.limit(0)).count() == 0

