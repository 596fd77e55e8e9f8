"""Opening hours of texts that name one weekday a line."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.functions import hours as H
from waymark.functions.columns import let
from waymark.plans.registry import query


def _first(group: int) -> str:
    """Oracle text: the group of the first form of hours that a line x has."""
    return "coalesce(" + ", ".join(f"nullif(regexp_extract(x, '{p}', {group}), '')" for p in H.LINE_HOURS) + ")"


def fill_sql(source: str) -> str:
    """Oracle text: gaps of known(id, d, h) filled but for the days of shut(id, d, o), up to shown(id, o, x); source has every id."""
    return f"""counted AS (SELECT id, d IN ('토', '일') AS weekend, h, count(*) AS n FROM known GROUP BY ALL),
common AS (SELECT id, weekend, arg_max(h, n * 1.0 + 0.0) AS h FROM (SELECT *, row_number() OVER (PARTITION BY id, weekend ORDER BY n DESC, h DESC) AS r FROM counted) x
  WHERE r = 1 AND n >= CASE WHEN weekend THEN 1 ELSE 2 END GROUP BY id, weekend),
free AS (SELECT h.id, days.o, days.d FROM {source} h CROSS JOIN days WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.id = h.id AND k.d = days.d)
  AND NOT EXISTS (SELECT 1 FROM shut WHERE shut.id = h.id AND shut.d = days.d)),
filled AS (SELECT id, d, h FROM known UNION ALL SELECT free.id, free.d, common.h FROM free JOIN common ON common.id = free.id AND common.weekend = (free.d IN ('토', '일'))),
lone AS (SELECT id, min(h) AS h FROM filled GROUP BY id HAVING count(*) = 1),
every AS (SELECT * FROM filled UNION ALL SELECT free.id, free.d, lone.h FROM free JOIN lone USING (id) WHERE NOT EXISTS (SELECT 1 FROM filled g WHERE g.id = free.id AND g.d = free.d)),
shown AS (SELECT e.id, o, e.d || ': ' || h AS x FROM every e JOIN days USING (d) UNION ALL
  SELECT shut.id, days.o, shut.d || ': 휴무' FROM shut JOIN days USING (d) WHERE shut.id IN (SELECT id FROM every) AND NOT EXISTS (SELECT 1 FROM every e WHERE e.id = shut.id AND e.d = shut.d))"""


# each line's weekday is the last one named up to it; the last hours of a weekday win
LINES_SQL = f"""days AS (SELECT unnest(range(7)) AS o, unnest(['월', '화', '수', '목', '금', '토', '일']) AS d),
l AS (SELECT id, unnest(range(len(string_split(lines, chr(10))))) AS i, unnest(string_split(lines, chr(10))) AS x FROM hours_lines),
n AS (SELECT *, (SELECT arg_min(d, o) FROM days WHERE contains(x, d)) AS named, {_first(1)} AS a, {_first(2)} AS b FROM l),
c AS (SELECT *, last_value(named IGNORE NULLS) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS day FROM n),
t AS (SELECT id, i, x, day, CASE WHEN contains(a, ':') THEN a ELSE lpad(a, 2, '0') || ':00' END AS a, CASE WHEN contains(b, ':') THEN b ELSE lpad(b, 2, '0') || ':00' END AS b
  FROM c WHERE a IS NOT NULL AND day IS NOT NULL),
s AS (SELECT id, i, day, a || '-' || CASE WHEN contains(x, '오전') AND contains(x, '오후') THEN
  printf('%02d', CAST(split_part(b, ':', 1) AS INT) + CASE WHEN CAST(split_part(b, ':', 1) AS INT) = 12 THEN 0 ELSE 12 END) || ':' || split_part(b, ':', 2) ELSE b END AS h FROM t),
known AS (SELECT id, day AS d, arg_max(h, i) AS h FROM s GROUP BY id, day),
f AS (SELECT id, i, 1 AS p, unnest(regexp_extract_all(x, '{H.LINE_CLOSED[0]}', 1)) AS d, 0 AS k FROM l UNION ALL
  SELECT id, i, 2, unnest(regexp_extract_all(x, '{H.LINE_CLOSED[1]}', 1)), 0 FROM l UNION ALL SELECT id, i, 3, unnest(regexp_extract_all(x, '{H.LINE_CLOSED[2]}', 1)), 0 FROM l UNION ALL
  SELECT id, i, 4, unnest(regexp_extract_all(x, '{H.LINE_CLOSED[3]}', 1)), 0 FROM l),
shut AS (SELECT id, d, min(i * 10 + p) AS o FROM f GROUP BY id, d),
{fill_sql("hours_lines")}"""


@query(f"""WITH {LINES_SQL}
SELECT id, (SELECT string_agg(k.d || ': ' || k.h, ', ' ORDER BY days.o) FROM known k JOIN days USING (d) WHERE k.id = hours_lines.id) AS found,
  CASE WHEN lines IS NOT NULL THEN coalesce((SELECT string_agg(d, ',' ORDER BY shut.o) FROM shut WHERE shut.id = hours_lines.id), '') END AS closed,
  (SELECT string_agg(x, ', ' ORDER BY o) FROM shown WHERE shown.id = hours_lines.id) AS open_hours FROM hours_lines""")
def line_hours(v):
    """Hours of each weekday as the lines give them, closed days, and the week with its gaps filled."""
    known = v.dealt("hours_lines").select("id", H.line_days(F.col("lines")).alias("k")).select("id", "k.hours", F.col("k.closed").alias("shut"))
    none = F.array().cast("array<string>")
    last = F.lit(None).cast("string")
    return known.select(
        "id",
        H.render(F.col("hours"), none, last).alias("found"),
        F.array_join("shut", ",").alias("closed"),
        let(H.fill_days(F.col("hours"), F.col("shut")), lambda week: H.render(week, F.col("shut"), last)).alias("open_hours"),
    )
