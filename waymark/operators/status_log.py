"""Evidence on whether a place is open, decisions on it, and a log of changes that a rerun does not lengthen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.columns import chain, present, total
from waymark.functions.hours import standardise
from waymark.functions.text import plausible_phone, repair_phone
from waymark.operators.details import CLOSURE_WORDS, listed, words_in
from waymark.operators.lifecycle import AS_OF, SCORE_SQL, TRANSITIONS, legal_changes, review_activity
from waymark.plans.durable import exists, shared_dir, written
from waymark.plans.registry import query

#: Texts of the evidence, the parts of evidence that speak for closing and for a pause, and how much each kind counts.
PHONE_DEAD, PHONE_FINE = "전화번호 연결 불가", "전화번호 연결 가능"
SITE_DEAD, SITE_SIGNS, SITE_FINE = "웹사이트 접근 불가", "웹사이트 폐업 징후", "웹사이트 정상 접근"
NO_RECENT, ACTIVE = "최근 30일 리뷰 없음", "리뷰 활동 있음"
CLOSING_SIGNS = ("전화번호 연결 불가", "웹사이트 접근 불가", "폐업 징후", "90일간 리뷰 없음")
PAUSE_SIGNS = ("준비중", "공사", "리모델링", "30일간 리뷰 없음")
CONFIDENCE = {PHONE_DEAD: 0.7, PHONE_FINE: 0.1, SITE_DEAD: 0.5, SITE_SIGNS: 0.8, SITE_FINE: 0.1, "inactive": 0.4, ACTIVE: 0.1}


def closure_signs(content: Column) -> Column:
    """What a page's text holds of closure: known words, and two composite signs."""
    found = F.transform(words_in(content, CLOSURE_WORDS), lambda w: F.concat(F.lit("키워드 발견: "), w))
    signs = F.array(
        F.when(content.contains("준비중") & ~content.contains("오픈"), "준비중 상태"),
        F.when(content.contains("공사중") | content.contains("리모델링"), "공사/리모델링 중"),
    )
    return F.array_compact(F.concat(found, signs))


def checked(places: DataFrame, activity: DataFrame) -> DataFrame:
    """places (place_id, name, status, phone, website, site_status, site_text) with evidence, confidence, new_status, needs_review.

    site_status is the answer's code: 0 (or none) and 404 mean that the site could not be reached. A place without phone or
    website has no evidence of that kind; one without reviews counts as inactive. The surest evidence gives the
    confidence. Two signs of closing close a place, one, or two of a pause, suspend it, if the confidence allows it.
    """
    joined = places.join(activity, "place_id", "left")
    reachable = plausible_phone(F.col("phone"))
    phone = F.when(present(F.col("phone")), F.when(reachable, F.lit(PHONE_FINE)).otherwise(PHONE_DEAD))
    dead = F.coalesce(F.col("site_status"), F.lit(0)).isin(0, 404)
    signs = closure_signs(F.coalesce("site_text", F.lit("")))
    told = F.concat(F.lit(f"{SITE_SIGNS}: "), F.array_join(signs, ", "))
    site = F.when(present(F.col("website")), F.when(dead, F.lit(SITE_DEAD)).when(F.size(signs) > 0, told).otherwise(SITE_FINE))
    active = F.coalesce(F.col("score") > 0.3, F.lit(False))
    silent = F.array(
        F.when(F.col("days_since") > 30, F.concat(F.col("days_since").cast("string"), F.lit("일간 리뷰 없음"))), F.when(F.coalesce("recent", F.lit(0)) == 0, NO_RECENT)
    )
    reviews = F.when(active, F.array(F.concat(F.lit(f"{ACTIVE} (점수: "), F.format_string("%.2f", "score"), F.lit(")")))).otherwise(silent)
    sure = [F.when(phone.startswith(t), c).when(site.startswith(t), c) for t, c in CONFIDENCE.items()]
    sure += [F.when(phone == PHONE_DEAD, CONFIDENCE[PHONE_DEAD]), F.when(active, CONFIDENCE[ACTIVE]).otherwise(CONFIDENCE["inactive"])]
    out = joined.select(places["*"], F.array_compact(F.concat(F.array(phone, site), reviews)).alias("evidence"), F.array_max(F.array(*sure)).alias("confidence"))

    def told_of(part: str) -> Column:
        return F.exists("evidence", lambda e: e.contains(part))

    def signs_of(parts: tuple[str, ...]) -> Column:
        return total([told_of(part).cast("int") for part in parts])

    strong, pause, sure_of = signs_of(CLOSING_SIGNS), signs_of(PAUSE_SIGNS), F.col("confidence")
    decided = chain([((sure_of > 0.7) & (strong >= 2), F.lit("closed")), ((sure_of > 0.5) & ((strong >= 1) | (pause >= 2)), F.lit("suspended"))], F.col("status"))
    out = out.withColumn("new_status", decided)
    return out.withColumn("needs_review", (F.col("confidence") > 0.6) & (F.col("new_status") != F.col("status")))


def status_changes(checks: DataFrame, at: Column, check_type: str = "comprehensive") -> DataFrame:
    """The eight columns of the change log for checks that change a status as the transition table allows."""
    changed = legal_changes(checks.where(F.col("new_status") != F.col("status")))
    return changed.select(
        "place_id", "name", F.col("status").alias("old_status"), "new_status", F.lit(check_type).alias("check_type"), "confidence", F.to_json("evidence").alias("evidence"), at.alias("changed_at")
    )


def changed_fields(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, old_value, new_value), values as text, of every field in which a row of `new` differs from the row of
    `old` with its key. Null and null are the same; rows that only one side has are no changes; a null key matches none."""
    pairs = [F.struct(F.lit(f).alias("field"), F.col(f"o.{f}").cast("string").alias("old_value"), F.col(f"n.{f}").cast("string").alias("new_value")) for f in fields]
    both = old.select(key, *fields).alias("o").join(new.select(key, *fields).alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"))
    found = F.filter(F.array(*pairs), lambda p: ~p["old_value"].eqNullSafe(p["new_value"]))
    return both.select(F.col(f"o.{key}").alias(key), F.explode(found).alias("p")).select(key, "p.*")


def updated(target: DataFrame, fresh: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """target, all rows and columns, with the fields of the rows of `fresh` (at most one a key) in place of its own."""
    new = fresh.select(F.col(key).alias("key_"), F.struct(*fields).alias("new_"))
    joined = target.join(new, F.col(key) == F.col("key_"), "left")
    return joined.select(*[F.when(F.col("new_").isNotNull(), F.col(f"new_.{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in target.columns])


def append_batch(rows: DataFrame, path: str, batch: int) -> bool:
    """Append the rows to the log at path as batch number `batch`, once: a batch that was written whole is left as it is.

    Each batch is a folder of its own that is replaced until its writer has finished, so a rerun after a failure repeats
    nothing and loses nothing. Says whether it wrote.
    """
    at = f"{path.rstrip('/')}/batch={int(batch)}"
    if exists(rows.sparkSession, f"{at}/_SUCCESS"):
        return False
    rows.write.mode("overwrite").parquet(at)
    return True


CHECKED_SQL = f"""a AS ({SCORE_SQL}), j AS (SELECT p.*, score, recent, days_since, regexp_replace(coalesce(phone, ''), '[^0-9]', '', 'g') AS d FROM checked_places p LEFT JOIN a USING (place_id)),
s AS (SELECT *, list_concat(list_transform(list_filter({listed(CLOSURE_WORDS)}, lambda w: contains(coalesce(site_text, ''), w)), lambda w: '키워드 발견: ' || w),
  CASE WHEN contains(site_text, '준비중') AND NOT contains(site_text, '오픈') THEN ['준비중 상태'] ELSE [] END, CASE WHEN contains(site_text, '공사중') OR contains(site_text, '리모델링') THEN ['공사/리모델링 중'] ELSE [] END) AS signs,
  length(d) BETWEEN 9 AND 11 AND length(replace(d, left(d, 1), '')) > 0 AND d NOT LIKE '%1234567890%' AND d NOT LIKE '%0987654321%' AS fine FROM j),
p AS (SELECT *, CASE WHEN trim(phone) <> '' THEN CASE WHEN fine THEN '{PHONE_FINE}' ELSE '{PHONE_DEAD}' END END AS e1,
  CASE WHEN trim(website) <> '' THEN CASE WHEN coalesce(site_status, 0) IN (0, 404) THEN '{SITE_DEAD}' WHEN len(signs) > 0 THEN '{SITE_SIGNS}: ' || array_to_string(signs, ', ') ELSE '{SITE_FINE}' END END AS e2,
  coalesce(score > 0.3, false) AS active FROM s),
v AS (SELECT *, list_filter(list_concat([e1, e2], CASE WHEN active THEN [printf('{ACTIVE} (점수: %.2f)', score)] ELSE
  [CASE WHEN days_since > 30 THEN days_since || '일간 리뷰 없음' END, CASE WHEN coalesce(recent, 0) = 0 THEN '{NO_RECENT}' END] END), lambda x: x IS NOT NULL) AS evidence,
  greatest(CASE e1 WHEN '{PHONE_DEAD}' THEN 0.7 WHEN '{PHONE_FINE}' THEN 0.1 END, CASE WHEN e2 = '{SITE_DEAD}' THEN 0.5 WHEN e2 LIKE '{SITE_SIGNS}%' THEN 0.8 WHEN e2 = '{SITE_FINE}' THEN 0.1 END, CASE WHEN active THEN 0.1 ELSE 0.4 END)::DOUBLE AS confidence FROM p),
w AS (SELECT *, len(list_filter({listed(CLOSING_SIGNS)}, lambda g: len(list_filter(evidence, lambda e: contains(e, g))) > 0)) AS strong, len(list_filter({listed(PAUSE_SIGNS)}, lambda g: len(list_filter(evidence, lambda e: contains(e, g))) > 0)) AS pause FROM v),
x AS (SELECT *, CASE WHEN confidence > 0.7 AND strong >= 2 THEN 'closed' WHEN confidence > 0.5 AND (strong >= 1 OR pause >= 2) THEN 'suspended' ELSE status END AS new_status FROM w)"""


@query(f"WITH {CHECKED_SQL} SELECT place_id, array_to_string(evidence, '|') AS evidence, round(confidence, 6) AS confidence, new_status, confidence > 0.6 AND new_status <> status AS needs_review FROM x")
def status_evidence(v):
    """Evidence by phone, website and reviews, and what follows from it."""
    out = checked(v.checked_places, review_activity(v.reviews))
    return out.select("place_id", F.array_join("evidence", "|").alias("evidence"), F.round("confidence", 6).alias("confidence"), "new_status", "needs_review")


_LEGAL = " OR ".join(f"(status = '{a}' AND new_status = '{b}')" for a, bs in TRANSITIONS.items() for b in bs)


@query(f"""WITH {CHECKED_SQL} SELECT place_id, name, status AS old_status, new_status, 'comprehensive' AS check_type, confidence, to_json(evidence)::VARCHAR AS evidence, '{AS_OF}' AS changed_at FROM x WHERE {_LEGAL}""")
def status_change_log(v):
    """The change log after a batch that is run twice."""
    path = f"{shared_dir(v.spark)}/status-log-{id(v)}-{v.spark.sparkContext.applicationId}"
    changes = status_changes(checked(v.checked_places, review_activity(v.reviews)), F.lit(AS_OF))
    append_batch(changes, path, 1)
    append_batch(changes, path, 1)
    return v.spark.read.schema(changes.schema).parquet(path).drop("batch")


@query(f"WITH {CHECKED_SQL} SELECT place_id, status, new_status FROM x WHERE {_LEGAL}")
def status_transitions(v):
    """Changes that the transition table allows; closed is final."""
    checks = checked(v.checked_places, review_activity(v.reviews))
    return legal_changes(checks.where(F.col("new_status") != F.col("status"))).select("place_id", "status", "new_status")


def _standard_sql(text: str) -> str:
    out = rf"regexp_replace({text}, '오전\s*(\d{{1,2}})', '\1', 'g')"
    for h in range(24, -1, -1):
        out = rf"regexp_replace({out}, '오후\s*0?{h}($|\D)', '{h + 12}\1', 'g')"
    out = rf"regexp_replace({out}, '(\d{{1,2}})\s*시\s*(\d{{1,2}})\s*분', '\1:\2', 'g')"
    out = rf"regexp_replace({out}, '(\d{{1,2}})\s*시', '\1:00', 'g')"
    return rf"trim(regexp_replace(regexp_replace({out}, '\s*~\s*', ' - ', 'g'), '\s*-\s*', ' - ', 'g'))"


def fixed_hours(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text) of the rows whose hours change when their times are written in the standard way."""
    return rows.withColumn("new_", standardise(F.col(text))).where(F.col("new_") != F.col(text)).select(key, F.col("new_").alias(text))


@query(f"""SELECT id, 'lines' AS field, lines AS old_value, {_standard_sql('lines')} AS new_value FROM hours_lines WHERE {_standard_sql('lines')} <> lines""")
def fixed_hours_log(v):
    """Hours that an automatic fix rewrites: only what changes."""
    return changed_fields(v.hours_lines, fixed_hours(v.hours_lines, "id", "lines"), "id", ["lines"])


@query("SELECT place_id, name, status, regexp_replace(phone, '^07-', '0507-') AS phone FROM places")
def phones_updated(v):
    """All places, the broken phone numbers repaired by key."""
    places = v.places.select("place_id", "name", "status", "phone")
    fresh = places.where(F.col("phone").startswith("07-")).select("place_id", repair_phone(F.col("phone")).alias("phone"))
    return updated(places, written(fresh), "place_id", ["phone"])
