"""Readers, sinks and catalog helpers; address texts with the noise that the views lack."""

import glob

from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.functions.text import char_jaccard, normalise_address, with_province
from waymark.sources.tables import append_distinct, columns_of, insert_statements, missing_tables, read, retryable, sql_literal, sql_query, write_by_month, write_csv, write_json_lines


def test_read_and_write_each_kind(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a,b", 1.5), (2, None, None), (3, 'q"', -1.0)], "id long, name string, n double")
    write_csv(rows, f"{tmp_path}/csv")
    write_json_lines(rows, f"{tmp_path}/json")
    rows.write.orc(f"{tmp_path}/orc")
    for kind in ("csv", "json", "orc"):
        back = read(spark, f"{tmp_path}/{kind}", kind, schema="id long, name string, n double")
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect())), kind
    write_json_lines(rows.limit(1), f"{tmp_path}/json")
    assert read(spark, f"{tmp_path}/json", "json", schema="id long").count() == 4
    write_json_lines(rows.limit(0), f"{tmp_path}/json", append=False)
    assert read(spark, f"{tmp_path}/json", "json", schema="id long").count() == 0
    assert read(spark, f"{tmp_path}/csv", "csv").columns == ["id", "name", "n"]


def test_queries_with_tables_and_parameters(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "y'")], "id long, name string")
    out = sql_query(spark, "SELECT id FROM {t} WHERE name = :name", {"t": rows}, name="y'")
    assert [r.id for r in out.collect()] == [2]


def test_catalog(spark):
    spark.createDataFrame([(1, "x")], "id long, name string").createOrReplaceTempView("known_here")
    found = columns_of(spark).where(F.col("table") == "known_here").collect()
    assert [(r.column, r.type) for r in found] == [("id", "bigint"), ("name", "string")]
    assert missing_tables(spark, ["known_here", "other", "another"]) == ["another", "other"]
    spark.catalog.dropTempView("known_here")


def test_months_prune_files(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2024-01-31"), (2, "2024-02-01"), (3, "2023-02-01")], "id long, d string").withColumn("ts", F.expr("CAST(d AS timestamp)"))
    write_by_month(rows, f"{tmp_path}/m", "ts")
    assert len(glob.glob(f"{tmp_path}/m/year=*/month=*")) == 3
    back = spark.read.parquet(f"{tmp_path}/m").where("year = 2024 AND month = 2")
    assert [r.id for r in back.collect()] == [2] and "PartitionFilters: [isnotnull(year" in back._jdf.queryExecution().executedPlan().toString()


def test_append_each_key_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "id long, name string")
    append_distinct(rows, f"{tmp_path}/t", "id")
    append_distinct(rows.where("id = 2").unionByName(spark.createDataFrame([(3, "d")], "id long, name string")), f"{tmp_path}/t", "id")
    assert sorted((r.id or 0) for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [0, 1, 2, 3]


def test_literals_and_statements(spark):
    rows = spark.createDataFrame([(1, "it's", ["a'b", "c"]), (None, None, None)], "id long, name string, tags array<string>")
    got = [r.value for r in insert_statements(rows, "t").collect()]
    assert got[0] == "INSERT INTO t (id, name, tags) VALUES (1, 'it''s', ARRAY['a''b', 'c']) ON CONFLICT DO NOTHING;"
    assert got[1].endswith("VALUES (NULL, NULL, NULL) ON CONFLICT DO NOTHING;")
    assert rows.select(sql_literal(F.col("id"), T.LongType())).first()[0] == "1"


def test_retry_words(spark):
    rows = spark.createDataFrame([("Timeout 3",), ("disk full",), (None,)], "r string")
    assert [bool(r[0]) for r in rows.select(retryable(F.col("r"))).collect()] == [True, False, False]


def test_addresses_with_noise(spark):
    texts = ["  서울 강남구  테헤란로 12 (역삼동) 3층 301호 근처 ", "강남구 상가 앞", "부산 해운대구", None, "", "경기 성남시 옆 건물"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    clean = normalise_address(F.col("t"))
    assert [r[0] for r in df.select(clean).collect()] == ["서울 강남구 테헤란로 12", "강남구", "부산 해운대구", "", "", "경기 성남시"]
    assert [r[0] for r in df.select(with_province(clean)).collect()][:3] == ["서울 강남구 테헤란로 12", "서울 강남구", "부산 해운대구"]
    near = spark.createDataFrame([("구로 1", "대구 2"), ("구로 1", "x"), ("구로 1", None)], "a string, b string")
    assert [r[0] for r in near.select(with_province(F.col("a"), F.col("b"))).collect()] == ["대구 구로 1", "서울 구로 1", "서울 구로 1"]
    assert [r[0] for r in spark.createDataFrame([("ab", "bc"), ("", ""), ("a", "a")], "a string, b string").select(F.round(char_jaccard(F.col("a"), F.col("b")), 3)).collect()] == [0.333, None, 1.0]

