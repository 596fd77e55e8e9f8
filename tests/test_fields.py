"""Single fields: nulls, ties and empties."""

from pyspark.sql import functions as F

from waymark.operators.fields import blocked_answer, cleanup_counts, failed_selector, merged_lists, mined_categories, relevance, script_menu


def test_where_a_theme_is_found_first(spark):
    rows = [("무한리필", "뷔페", [], ""), (None, "고기 뷔페", ["리필"], "x"), ("q", None, [None, "자유이용권"], "리필"), ("q", "n", None, "무제한"), (None, None, None, None), ("q", "n", ["c"], "d")]
    df = spark.createDataFrame(rows, "q string, n string, c array<string>, d string")
    assert [r.f for r in df.select(relevance(F.col("q"), F.col("n"), F.col("c"), F.col("d")).alias("f")).collect()] == ["query", "name", "category", "description", None, None]


def test_the_selector_that_failed_most(spark):
    rows = [(1, "2024-01-01", "selector:.b x"), (2, "2024-01-01", "selector:.a"), (3, "2024-01-02", "no selector:.a"), (4, "2024-01-03", "selector:.b"), (5, "2024-01-03", None), (6, "2024-01-03", "selector:")]
    df = spark.createDataFrame(rows, "event_id long, d string, error_message string").withColumn("ts", F.expr("CAST(d AS timestamp)"))
    assert [tuple(r) for r in failed_selector(df).collect()] == [(".b", 2, 0.333333)]  # as often as .a, and seen first
    assert failed_selector(df.where("event_id > 4")).count() == 0 and failed_selector(df.limit(0)).count() == 0


def test_menus_in_scripts(spark):
    good = 'x; aData = [{"menu":{"list":[{"menu":"b","price":"9,000원"},{"menu":" a ","price":"5,000~6,000원","best":1},{"menu":"c","price":"100,001원"},{"menu":"","price":"7,000"},{"price":"7,000"}]}}];'
    df = spark.createDataFrame([(good,), ("aData = [];",), ("aData = [{nope];",), (None,), ("",)], "s string")
    got = [r.m for r in df.select(script_menu(F.col("s")).alias("m")).collect()]
    assert [(x.name, x.price_numeric, x.recommended) for x in got[0]] == [("a", 5000, True), ("b", 9000, False)]
    assert not any(got[1:])


def test_blocks_and_clean_up(spark):
    df = spark.createDataFrame([("captcha", 200), ("x", 429), ("x", None), (None, 503), (None, None)], "m string, c int")
    assert [r.b for r in df.select(blocked_answer(F.col("m"), F.col("c")).alias("b")).collect()] == [True, True, False, True, False]
    df = spark.createDataFrame([(" ", []), ("", [1]), (None, None), ("x", [])], "t string, l array<int>")
    assert sorted(map(tuple, cleanup_counts(df, ["t"], ["l"]).collect())) == [("l", 2), ("t", 2)]
    assert sorted(map(tuple, cleanup_counts(df.limit(0), ["t"], ["l"]).collect())) == [("l", 0), ("t", 0)]


def test_lists_of_a_group(spark):
    rows = spark.createDataFrame([(1, ["b", "a"], None), (2, ["a", None], ["x"]), (3, [], None), (4, ["z"], ["z"])], "seq long, f array<string>, g array<string>")
    groups = spark.createDataFrame([(1, 1), (1, 2), (3, 3), (4, 4), (4, 4)], "seed long, member long")
    got = {r.seed: (r.f, r.g) for r in merged_lists(rows, groups, ["f", "g"]).collect()}
    assert got == {1: (["a", "b"], ["x"]), 3: (None, None), 4: (["z"], ["z"])}


def test_categories_from_names_and_menus(spark):
    rows = [(["맛집"], "피자집", None), (["삼겹살"], None, ["초밥"]), ([], "피자", ["초밥"]), (None, "피자", None), (["x"], "y", ["1", "2", "3", "4", "5", "초밥"]), (["우동"], "", [])]
    df = spark.createDataFrame(rows, "r array<string>, n string, m array<string>")
    got = [r.c for r in df.select(mined_categories(F.col("r"), F.col("n"), F.col("m")).alias("c")).collect()]
    assert got == [["양식"], ["고기", "해산물"], ["한식"], ["한식"], ["한식"], ["일식"]]
