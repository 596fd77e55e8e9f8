"""Extraction from raw pages: lists, titles, links and embedded data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waymark.functions.columns import extract
from waymark.functions.text import first_link, strip_ordinal
from waymark.plans.registry import query

def unescape_html(text: Column) -> Column:
    for written, raw in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(written), F.lit(raw))
    return text


@query(r"""SELECT page_id, count(*) AS links, count(DISTINCT u) AS distinct_links FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS u FROM pages) x GROUP BY page_id""")
def page_links(v):
    links = F.regexp_extract_all("html", F.lit('href="([^"]+)"'), 1)
    return v.pages.select("page_id", F.explode(links).alias("u")).groupBy("page_id").agg(F.count("*").alias("links"), F.countDistinct("u").alias("distinct_links"))


@query(r"""SELECT page_id, replace(replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS title FROM pages""")
def page_first_title(v):
    return v.pages.select("page_id", unescape_html(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))


@query(r"""SELECT page_id, CAST(nullif(regexp_extract(html, 'track\((\d+)\)', 1), '') AS BIGINT) AS script_id FROM pages""")
def page_script_ids(v):
    return v.pages.select("page_id", extract(F.col("html"), r"track\((\d+)\)").cast("long").alias("script_id"))


@query(r"""SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, count(*) AS pages, count(*) FILTER (WHERE url LIKE 'https:%') AS secure FROM pages GROUP BY 1""")
def page_hosts(v):
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    return v.pages.groupBy(host.alias("host")).agg(F.count("*").alias("pages"), F.count_if(F.col("url").startswith("https:")).alias("secure"))


@query(r"""SELECT page_id, list_filter(regexp_extract_all(html, 'href="(https?://[^"]+)"', 1), lambda u: NOT contains(u, 'own.example'))[1] AS website FROM pages""")
def page_websites(v):
    return v.pages.select("page_id", first_link(F.col("html"), "own.example").alias("website"))


@query(r"""SELECT page_id, CAST(len(regexp_extract_all(html, '<li>')) AS BIGINT) AS entries, strip AS first_entry FROM
(SELECT page_id, html, regexp_replace(regexp_extract(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1), '^\d+(\.\s*|\s+)', '') AS strip FROM pages) x""")
def page_list_entries(v):
    first = strip_ordinal(F.regexp_extract("html", '<li><a href="[^"]*">([^<]*)</a></li>', 1))
    return v.pages.select("page_id", F.size(F.regexp_extract_all("html", F.lit("<li>"), 0)).cast("long").alias("entries"), first.alias("first_entry"))
