"""Status evidence and its log, reports of several levels, rejected records, the enhancing run, Korean numerals."""

import json
import random

from pyspark.sql import functions as F

from waymark.functions.price import pure_korean
from waymark.operators.bundles import levels, quality_gate, quality_report, read_letters, stats_bundle, to_retry
from waymark.operators.enhance import enhance
from waymark.operators.status_log import append_batch, changed_fields, checked, closure_signs, status_changes, updated
from waymark.plans.durable import value_at
from waymark.sources.tables import write_json_lines

PLACES = "place_id string, name string, status string, phone string, website string, site_status int, site_text string"
ACTIVITY = "place_id string, score double, recent long, days_since long"


def test_evidence_decides(spark):
    places = spark.createDataFrame([
        ("dead", "n", "open", "02-000", "http://x", 200, "폐업 안내"), ("site", "n", "open", "02-123-4567", "http://x", 404, ""), ("pause", "n", "open", None, "http://x", 200, "리모델링 공사중 준비중"),
        ("fine", "n", "open", "02-123-4567", "http://x", 200, "정상"), ("none", "n", "closed", "", None, None, None), ("final", "n", "closed", "02-000", "http://x", 200, "폐업"),
    ], PLACES)
    activity = spark.createDataFrame([("fine", 0.9, 5, 3), ("dead", 0.0, 0, 190), ("site", 0.9, 3, 2)], ACTIVITY)
    got = {r.place_id: r for r in checked(places, activity).collect()}
    assert (got["dead"].new_status, got["dead"].confidence, got["dead"].needs_review) == ("closed", 0.8, True)
    assert got["dead"].evidence == ["전화번호 연결 불가", "웹사이트 폐업 징후: 키워드 발견: 폐업", "190일간 리뷰 없음", "최근 30일 리뷰 없음"]
    assert (got["site"].new_status, got["site"].confidence) == ("open", 0.5)
    assert (got["pause"].new_status, got["pause"].confidence) == ("suspended", 0.8)
    assert (got["fine"].new_status, got["fine"].evidence[-1]) == ("open", "리뷰 활동 있음 (점수: 0.90)")
    assert got["none"].evidence == ["최근 30일 리뷰 없음"] and got["none"].confidence == 0.4
    log = status_changes(checked(places, activity), F.lit("now"))
    assert len(log.columns) == 8 and sorted(r.place_id for r in log.collect()) == ["dead", "pause"]  # closed is final
    assert checked(places.limit(0), activity).count() == 0
    signs = spark.createDataFrame([("준비중",), ("준비중 오픈",), (None,)], "t string").select(closure_signs(F.col("t")).alias("s")).collect()
    assert [r.s for r in signs] == [["준비중 상태"], [], []]


def test_a_batch_is_logged_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, what string")
    path = f"{tmp_path}/log"
    assert append_batch(rows, path, 1) and not append_batch(rows.limit(0), path, 1) and append_batch(rows.limit(1), path, 2)
    assert spark.read.parquet(path).groupBy("batch").count().orderBy("batch").collect() == [(1, 2), (2, 1)]
    # a batch whose writer did not finish is written anew
    (tmp_path / "log" / "batch=2" / "_SUCCESS").unlink()
    assert append_batch(rows, path, 2) and spark.read.parquet(path).where("batch = 2").count() == 2


def test_changed_fields_and_update(spark):
    schema = "id long, a string, b double"
    old = spark.createDataFrame([(1, "x", 1.0), (2, None, 2.0), (3, "z", None), (4, "same", 4.0), (None, "n", 1.0)], schema)
    new = spark.createDataFrame([(1, "y", 1.0), (2, None, 2.5), (3, "z", 3.0), (4, "same", 4.0), (5, "new", 0.0), (None, "m", 1.0)], schema)
    got = sorted(map(tuple, changed_fields(old, new, "id", ["a", "b"]).collect()))
    assert got == [(1, "a", "x", "y"), (2, "b", "2.0", "2.5"), (3, "b", None, "3.0")]
    out = {r.id: (r.a, r.b) for r in updated(old.where("id IS NOT NULL"), new.where("id in (1, 2)").select("id", "a"), "id", ["a"]).collect()}
    assert out == {1: ("y", 1.0), 2: (None, 2.0), 3: ("z", None), 4: ("same", 4.0)}


def test_levels_in_one_pass(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice(["x", "y"]), rng.randint(0, 9)) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, s string, n long")
    out = levels(df, [[], ["k"], ["s"], ["k", "s"]], n=F.count("*"), total=F.sum("n"))
    got = {(r.level, r.k, r.s): (r.n, r.total) for r in out.collect()}
    for level, key in ((0, lambda r: (None, None)), (1, lambda r: (r[0], None)), (2, lambda r: (None, r[1])), (3, lambda r: (r[0], r[1]))):
        groups = {}
        for r in rows:
            groups.setdefault(key(r), []).append(r[2])
        assert {k[1:]: v for k, v in got.items() if k[0] == level} == {k: (len(v), sum(v)) for k, v in groups.items()}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Scan") == 1 and plan.count("Expand") == 1


def test_reports(spark):
    issues = spark.createDataFrame([("a", "low", True), ("a", "critical", False), ("b", "low", False), (None, "high", True)], "issue_type string, severity string, auto_fixed boolean")
    places = spark.range(4)
    report = json.loads(quality_report(issues, places).first().report)
    assert report["issues_found"] == 4 and report["critical_issues"] == 1 and report["auto_fixed"] == 2 and report["total_stores"] == 4
    assert report["by_type"] == {"a": 2, "b": 1, "none": 1} and report["by_type_and_severity"]["a/critical"] == 1 and report["quality_score"] == 60.0
    empty = json.loads(quality_report(issues.limit(0), places).first().report)
    assert empty["quality_score"] == 100.0 and empty["by_type"] == {} and empty["issues_found"] == 0
    places = spark.createDataFrame([("서울 강남구", "m", True, "1", 2.0), (None, "", False, "", None)], "address string, refill_type string, is_confirmed boolean, phone string, src_rating double")
    sessions = spark.createDataFrame([(i, f"2024-01-01 00:00:{i:02d}", "completed", i) for i in range(15)], "id long, at string, status string, found long").withColumn("created_at", F.expr("CAST(at AS timestamp_ntz)"))
    bundle = json.loads(stats_bundle(places, sessions).first().bundle)
    assert bundle["basic"] == {"total_stores": 2, "confirmed": 1, "with_phone": 1, "avg_rating": 2.0} and bundle["refill_types"] == {"m": 1} and bundle["regions"] == {"강남": 1, "기타": 1}
    assert [s["id"] for s in bundle["recent_sessions"]] == list(range(14, 4, -1))


def test_letters_round_trip_with_damaged_lines(spark, tmp_path):
    results = spark.createDataFrame([(1, "r", 80, None), (2, "r", 29, " "), (3, "s", 90, "타임아웃 3"), (4, "s", None, None), (5, "t", 10, "네트워크 오류"), (6, None, 5, "저장 실패")], "id long, region string, score long, failure string")
    gated = {r.id: r.reason for r in quality_gate(results).collect()}
    assert gated == {1: None, 2: "낮은 품질 점수: 29%", 3: "타임아웃 3", 4: "낮은 품질 점수: 0%", 5: "네트워크 오류", 6: "저장 실패"}
    letters = quality_gate(results).where("reason IS NOT NULL").select("id", "region", "reason", F.when(F.col("id") == 5, 3).otherwise(F.lit(None)).cast("int").alias("attempts"))
    path = f"{tmp_path}/letters"
    write_json_lines(letters, path)
    broken = ['{"id": 9, "reason": "타임', "", "not json", '{"id": "text", "reason": "타임아웃"}']
    spark.createDataFrame([(b,) for b in broken], "value string").coalesce(1).write.mode("append").text(path)
    read = read_letters(spark, path).cache()
    assert {r.id: r.reason for r in read.where("damaged IS NULL").collect()} == {i: r for i, r in gated.items() if r}
    assert sorted(r.damaged for r in read.where("damaged IS NOT NULL").collect()) == sorted(b for b in broken if b)
    assert [tuple(r) for r in to_retry(read).collect()] == [(3, "s", "타임아웃 3", 1)]  # 5 was tried three times, others are not worth it
    assert [r.attempts for r in to_retry(to_retry(read).withColumn("damaged", F.lit(None).cast("string"))).collect()] == [2]


def test_counters_of_the_run_equal_a_recount(spark):
    places = spark.createDataFrame([
        (1, "p1", "가게", "서울 강남구 테헤란로 1", "02-123-4567", 37.5, 127.03), (2, "p2", "가게 둘", "서울 강남구 테헤란로 1", "02-123-4567", None, None), (3, "p3", "셋", "서울 강남구 테헤란로 1 2층", None, None, None),
        (4, "p4", "넷", None, None, None, None), (5, "p5", None, "서울 마포구 없는길 1", "", None, None),
    ], "seq long, place_id string, name string, address string, phone string, lat double, lng double")
    prices = spark.createDataFrame([(1, "1만원"), (2, ""), (4, "문의 바람")], "seq long, price_text string")
    raw = spark.createDataFrame([(1, ["삼겹살"]), (3, ["초밥"]), (4, [])], "seq long, raw array<string>")
    out, counters = enhance(places, prices, raw)
    rows = {r.place_id: r for r in out.collect()}
    assert counters == {"total": 5, "located": 3, "priced": 2, "mapped": 2, "final": 4, "removed": 1}
    assert sorted(rows) == ["p1", "p3", "p4", "p5"] and rows["p1"].merged == 2 and rows["p3"].source == "lookup" and rows["p4"].lat is None
    assert rows["p1"].price.min_price == 10000 and list(rows["p3"].categories) == ["해산물"]


def numeral(n):
    def below(x):
        out = ""
        for unit, size in (("천", 1000), ("백", 100), ("십", 10)):
            d, x = divmod(x, size)
            out += ("" if d == 1 else "일이삼사오육칠팔구"[d - 1]) + unit if d else ""
        return out + ("일이삼사오육칠팔구"[x - 1] if x else "")

    big, rest = divmod(n, 10**8)
    ten, rest = divmod(rest, 10**4)
    return (below(big) + "억" if big else "") + (below(ten) + "만" if ten else "") + below(rest)


def test_korean_numerals(spark):
    rng = random.Random(2)
    numbers = [1, 10, 11, 100, 101, 1000, 9999, 10_000, 12_000, 20_015, 100_000, 10**8, 123_456_789] + [rng.randint(1, 10 ** rng.randint(1, 12) - 1) for _ in range(300)]
    df = spark.createDataFrame([(n, numeral(n)) for n in numbers], "n long, t string")
    for r in df.select("n", "t", pure_korean(F.col("t")).alias("got")).collect():
        assert r.got == r.n, r
    assert [r.g for r in spark.createDataFrame([("일이삼",), ("만",), (None,)], "t string").select(pure_korean(F.col("t")).alias("g")).collect()] == [123, 10_000, None]


def test_value_at_a_rank(spark):
    rng = random.Random(3)
    values = [rng.randint(0, 30) for _ in range(101)]
    counts = spark.createDataFrame([(v,) for v in values], "v long").groupBy("v").count()
    for rank in (1, 50, 51, 101):
        assert value_at(counts, "v", "count", lambda n, rank=rank: rank) == sorted(values)[rank - 1]
    assert value_at(counts, "v", "count", lambda n: n + 1) is None and value_at(counts.limit(0), "v", "count", lambda n: 1) is None
