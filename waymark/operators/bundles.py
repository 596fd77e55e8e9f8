"""Reports of several levels from one pass (grouping sets), nested into one JSON document, and rejected records kept as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.functions.columns import chain, present
from waymark.operators.quality import WEIGHTS
from waymark.plans.durable import shared_dir
from waymark.plans.registry import query
from waymark.sources.tables import write_json_lines

#: Least score of a record that is kept, and words in reasons that are worth another try.
LEAST_SCORE = 30
RETRY_WORDS = ("타임아웃", "네트워크", "연결")
#: Tries after which a record is given up, sessions that a bundle lists, and the regions of addresses in the order in which they decide.
MOST_TRIES, RECENT = 3, 10
REGIONS = (("강남", ("강남",)), ("홍대/마포", ("홍대", "마포")), ("강북", ("강북",)), ("기타 서울", ("서울",)))


def levels(rows: DataFrame, sets: list[list[str]], **measures: Column) -> DataFrame:
    """One row per group of every set of columns, in one pass: the columns (null where a set lacks them), `level` (the set's
    place in the list) and the measures. A group of null values is told apart from a column that the set lacks."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    masks = [sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s) for s in sets]
    grouped = rows.groupingSets([[F.col(c) for c in s] for s in sets], *columns)
    out = grouped.agg(F.grouping_id(*columns).alias("mask_"), *[m.alias(n) for n, m in measures.items()])
    return out.withColumn("level", chain([(F.col("mask_") == m, F.lit(i)) for i, m in enumerate(masks)])).drop("mask_")


def counted_map(level: int, key: Column, value: Column) -> Column:
    """An aggregate: the groups of a level as a map in the order of their keys; a null key is named "none"."""
    entries = F.collect_list(F.when(F.col("level") == level, F.struct(F.coalesce(key, F.lit("none")).alias("k"), value.alias("v"))))
    return F.map_from_entries(F.array_sort(entries))


def of_level(level: int, value: Column) -> Column:
    """An aggregate: the value of the one row of a level; null where there are no rows at all."""
    return F.max(F.when(F.col("level") == level, value))


def count_of_level(level: int, value: Column) -> Column:
    """As of_level, for counts: 0 where there are no rows at all."""
    return F.coalesce(of_level(level, value), F.lit(0))


def quality_report(issues: DataFrame, places: DataFrame) -> DataFrame:
    """One row, one JSON document: places, issues, critical ones, fixed ones, score, and issues by type, by severity and by both.

    Issues are read once. The score is that of all issues (100 without places, 0 at least). A report of no issues is 100
    with empty maps.
    """
    weight = chain([(F.col("severity") == s, w) for s, w in WEIGHTS.items()], 1)
    found = levels(
        issues, [[], ["issue_type"], ["severity"], ["issue_type", "severity"]], n=F.count("*"), critical=F.count_if(F.col("severity") == "critical"), fixed=F.count_if("auto_fixed"), lost=F.sum(weight)
    )
    nested = counted_map(3, F.concat_ws("/", F.coalesce("issue_type", F.lit("none")), F.coalesce("severity", F.lit("none"))), F.col("n"))
    one = found.agg(
        count_of_level(0, F.col("n")).alias("issues_found"), count_of_level(0, F.col("critical")).alias("critical_issues"), count_of_level(0, F.col("fixed")).alias("auto_fixed"),
        count_of_level(0, F.col("lost")).alias("lost"), counted_map(1, F.col("issue_type"), F.col("n")).alias("by_type"), counted_map(2, F.col("severity"), F.col("n")).alias("by_severity"),
        nested.alias("by_type_and_severity"),
    )
    both = one.crossJoin(places.agg(F.count("*").alias("total_stores")))  # one row each
    score = F.when(F.col("total_stores") == 0, 100.0).otherwise(F.round(F.greatest(F.lit(0.0), 100 - F.col("lost") / (F.col("total_stores") * 15) * 100), 1))
    parts = ["total_stores", "issues_found", "critical_issues", "auto_fixed"]
    return both.select(F.to_json(F.struct(*parts, score.alias("quality_score"), "by_type", "by_severity", "by_type_and_severity")).alias("report"))


def _map_sql(key: str, rows: str) -> str:
    return f"""(SELECT '{{' || coalesce(string_agg('"' || k || '":' || n, ',' ORDER BY k), '') || '}}' FROM (SELECT {key} AS k, count(*) AS n FROM {rows} GROUP BY 1) x)"""


@query(f"""WITH w AS (SELECT CASE severity WHEN 'low' THEN 1 WHEN 'medium' THEN 3 WHEN 'high' THEN 7 ELSE 15 END AS w, severity, auto_fixed FROM quality_issues), n AS (SELECT count(*) AS n FROM places)
SELECT '{{"total_stores":' || (SELECT n FROM n) || ',"issues_found":' || count(*) || ',"critical_issues":' || count(*) FILTER (WHERE severity = 'critical') || ',"auto_fixed":' || count(*) FILTER (WHERE auto_fixed)
  || ',"quality_score":' || round(greatest(0.0, 100 - sum(w) / ((SELECT n FROM n) * 15.0) * 100), 1)::DOUBLE || ',"by_type":' || {_map_sql('issue_type', 'quality_issues')} || ',"by_severity":' || {_map_sql('severity', 'quality_issues')}
  || ',"by_type_and_severity":' || {_map_sql("issue_type || '/' || severity", 'quality_issues')} || '}}' AS report FROM w""")
def quality_report_json(v):
    return quality_report(v.quality_issues, v.places)


def region_of(address: Column) -> Column:
    hits = [(F.coalesce(address.rlike("|".join(words)), F.lit(False)), F.lit(name)) for name, words in REGIONS]
    return chain(hits, F.lit("기타"))


def stats_bundle(places: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row, one JSON document: totals, places by refill type and by region (one pass over places), the ten latest sessions."""
    found = levels(
        places.withColumn("region", region_of(F.col("address"))), [[], ["refill_type"], ["region"]], n=F.count("*"), confirmed=F.count_if("is_confirmed"),
        phones=F.count_if(present(F.col("phone"))), rating=F.round(F.avg("src_rating"), 4),
    )
    basic = F.struct(count_of_level(0, F.col("n")).alias("total_stores"), count_of_level(0, F.col("confirmed")).alias("confirmed"), count_of_level(0, F.col("phones")).alias("with_phone"), of_level(0, F.col("rating")).alias("avg_rating"))
    named = F.when(F.coalesce("refill_type", F.lit("")) != "", F.col("refill_type"))
    one = found.where((F.col("level") != 1) | named.isNotNull()).agg(basic.alias("basic"), counted_map(1, named, F.col("n")).alias("refill_types"), counted_map(2, F.col("region"), F.col("n")).alias("regions"))
    latest = sessions.orderBy(F.desc("created_at"), F.desc("id")).limit(RECENT)
    recent = latest.agg(F.array_sort(F.collect_list(F.struct((-F.unix_micros(F.col("created_at").cast("timestamp"))).alias("at"), (-F.col("id")).alias("less"), "id", "status", "found"))).alias("r"))
    listed = recent.select(F.transform("r", lambda x: F.struct(x["id"].alias("id"), x["status"].alias("status"), x["found"].alias("found"))).alias("recent_sessions"))
    return one.crossJoin(listed).select(F.to_json(F.struct("basic", "refill_types", "regions", "recent_sessions")).alias("bundle"))  # one row each


@query(f"""WITH p AS (SELECT *, CASE WHEN contains(address, '강남') THEN '강남' WHEN contains(address, '홍대') OR contains(address, '마포') THEN '홍대/마포' WHEN contains(address, '강북') THEN '강북' WHEN contains(address, '서울') THEN '기타 서울' ELSE '기타' END AS region FROM places),
r AS (SELECT * FROM crawl_log ORDER BY created_at DESC, id DESC LIMIT {RECENT})
SELECT '{{"basic":{{"total_stores":' || count(*) || ',"confirmed":' || count(*) FILTER (WHERE is_confirmed) || ',"with_phone":' || count(*) FILTER (WHERE trim(phone) <> '') || ',"avg_rating":' || round(avg(src_rating), 4)::DOUBLE
  || '}},"refill_types":' || {_map_sql('refill_type', "places WHERE refill_type <> ''")} || ',"regions":' || {_map_sql('region', 'p')} || ',"recent_sessions":['
  || (SELECT string_agg('{{"id":' || id || ',"status":"' || status || '","found":' || found || '}}', ',' ORDER BY created_at DESC, id DESC) FROM r) || ']}}' AS bundle FROM p""")
def stats_bundle_json(v):
    return stats_bundle(v.places, v.crawl_log)


LETTER = "id long, region string, reason string, attempts int"


def quality_gate(results: DataFrame) -> DataFrame:
    """results (score, failure) with reason: the failure, else that the score is under 30; null for a record that is kept.

    A missing score counts as 0, a blank failure as none.
    """
    score = F.coalesce("score", F.lit(0))
    low = F.when(score < LEAST_SCORE, F.concat(F.lit("낮은 품질 점수: "), score.cast("string"), F.lit("%")))
    return results.withColumn("reason", F.coalesce(F.when(present(F.col("failure")), F.col("failure")), low))


def read_letters(spark: SparkSession, path: str, schema: str = LETTER) -> DataFrame:
    """Rejected records of a folder of JSON lines; `damaged` holds the text of a line that is no such record, else null."""
    fields = T.StructType.fromDDL(schema)
    known = T.StructType([*fields.fields, T.StructField("damaged", T.StringType())])
    return spark.read.schema(known).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "damaged").json(path)


def to_retry(letters: DataFrame) -> DataFrame:
    """Readable letters whose reason is worth another try and that were not tried too often, their count raised."""
    worth = F.coalesce(F.col("reason").rlike("|".join(RETRY_WORDS)), F.lit(False))
    again = letters.where(F.col("damaged").isNull() & worth & (F.coalesce("attempts", F.lit(0)) < MOST_TRIES))
    return again.withColumn("attempts", F.coalesce("attempts", F.lit(0)) + 1).drop("damaged")


@query(f"""WITH g AS (SELECT id, region, coalesce(failure, CASE WHEN score < {LEAST_SCORE} THEN '낮은 품질 점수: ' || score || '%' END) AS reason, id % 5 AS attempts FROM crawl_results)
SELECT id, region, reason, CAST(attempts + 1 AS INT) AS attempts FROM g WHERE reason IS NOT NULL AND id % 13 <> 0 AND attempts < {MOST_TRIES} AND regexp_matches(reason, '{"|".join(RETRY_WORDS)}')""")
def retried_letters(v):
    """Rejected records written as JSON, some of them damaged on the way, read back and chosen for another try."""
    rejected = quality_gate(v.crawl_results).where("reason IS NOT NULL")
    letters = rejected.select("id", "region", "reason", (F.col("id") % 5).cast("int").alias("attempts"))
    path = f"{shared_dir(v.spark)}/letters-{id(v)}-{v.spark.sparkContext.applicationId}"
    write_json_lines(letters.where("id % 13 <> 0"), path, append=False)
    half = letters.where("id % 13 = 0").select(F.to_json(F.struct("*")).alias("value"))
    half.select(F.expr("substring(value, 1, length(value) div 2)").alias("value")).write.mode("append").text(path)
    return to_retry(read_letters(v.spark, path))


@query(f"""WITH g AS (SELECT region, coalesce(failure, CASE WHEN score < {LEAST_SCORE} THEN '낮은 품질 점수' END) AS reason FROM crawl_results)
SELECT region, count(*) FILTER (WHERE reason IS NULL) AS kept, count(*) FILTER (WHERE reason = '낮은 품질 점수') AS low, count(*) FILTER (WHERE reason <> '낮은 품질 점수') AS failed FROM g GROUP BY region""")
def gate_counts(v):
    """Records of each region that pass the gate, and why others do not."""
    reason = F.col("reason")
    low = reason.startswith("낮은 품질 점수")
    return quality_gate(v.crawl_results).groupBy("region").agg(F.count_if(reason.isNull()).alias("kept"), F.count_if(low).alias("low"), F.count_if(~low).alias("failed"))
