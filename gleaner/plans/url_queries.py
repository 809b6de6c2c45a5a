"""URL functions over every page url and link."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import urls as U
from gleaner.functions.markup import extract_links
from gleaner.plans.inputs import pages
from gleaner.plans.registry import query
from gleaner.sources.tables import table

HOST = "regexp_extract(url, '^https?://([^/]*)', 1)"
# Query entries of a url: drops nothing but blank values, last one wins, key order.
PAIRS = """q AS (SELECT page_id, url, split_part(url, '?', 1) AS path,
    list_filter(string_split(substr(url, length(split_part(url, '?', 1)) + 2), '&'), lambda p: regexp_matches(p, '=.')) AS pairs FROM u)"""


def _pages(spark, folder):
    return table(spark, folder, "pages")


@query(
    "shrink_url",
    f"""WITH u AS (SELECT page_id, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'z=1&blank=&z=a b' AS url FROM pages), {PAIRS}
    , k AS (SELECT page_id, path, list_sort(list_filter(pairs, lambda p: p <> 'z=1' AND NOT starts_with(p, 'ref='))) AS pairs FROM q)
    SELECT page_id, path || CASE WHEN len(pairs) = 0 THEN '' ELSE '?' || replace(array_to_string(pairs, '&'), ' ', '+') END AS url FROM k""",
)
def shrink_url(spark, folder):
    url = F.concat("url", F.when(F.contains("url", F.lit("?")), "&").otherwise("?"), F.lit("z=1&blank=&z=a%20b"))
    return _pages(spark, folder).select("page_id", U.shrink_url(url, ["ref"]).alias("url"))


@query(
    "add_get_params",
    """WITH u AS (SELECT page_id, split_part(url, '#', 1) AS front,
           CASE WHEN contains(url, '#') THEN '#' || split_part(url, '#', 2) ELSE '' END AS fragment FROM pages),
       q AS (SELECT page_id, fragment, split_part(front, '?', 1) AS path,
           list_filter(string_split(substr(front, length(split_part(front, '?', 1)) + 2), '&'), lambda p: regexp_matches(p, '=.') AND NOT starts_with(p, 'page=')) AS pairs FROM u)
       SELECT page_id, path || '?' || array_to_string(list_sort(list_concat(pairs, ['page=9', 'q=a+%26+b'])), '&') || fragment AS url FROM q""",
)
def add_get_params(spark, folder):
    return _pages(spark, folder).select("page_id", U.add_get_params(F.col("url"), {"page": "9", "q": "a & b"}).alias("url"))


@query(
    "url_join",
    """WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)
       SELECT page_id, regexp_extract(url, '^(https?://[^/]*)', 1) || replace(href, '&amp;', '&') AS rooted,
              regexp_extract(url, '^(https?://[^/]*)', 1) || regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '^https?://[^/]*(/.*/)', 1) || 'next' || replace(href, '&amp;', '&') AS relative,
              regexp_extract(url, '^(https?://[^/]*)', 1) || replace(href, '&amp;', '&') AS climbed
       FROM l""",
)
def url_join(spark, folder):
    links = pages(spark, folder).select("page_id", "url", F.explode(extract_links(F.col("html"))).alias("href"))
    base, href = F.col("url"), F.col("href")
    return links.select(
        "page_id",
        U.url_join(base, href).alias("rooted"),
        U.url_join(base, F.concat(F.lit("next"), href)).alias("relative"),
        U.url_join(base, F.concat(F.lit("../../../a/./.."), href)).alias("climbed"),
    )


@query("is_absolute", "SELECT page_id, true AS page_url, false AS page_path FROM pages")
def is_absolute(spark, folder):
    path = F.regexp_replace("url", "^https?://[^/]*", "")
    return _pages(spark, folder).select(
        "page_id", U.is_absolute(F.col("url")).alias("page_url"), U.is_absolute(path).alias("page_path")
    )


@query("url_host", f"SELECT page_id, regexp_replace({HOST}, '^www\\.', '') AS host FROM pages")
def url_host(spark, folder):
    return _pages(spark, folder).select("page_id", U.url_host(F.col("url")).alias("host"))


@query("normalize_feed_url", "SELECT page_id, replace(replace(url, 'http://', 'https://'), '//www.', '//') AS url FROM pages")
def normalize_feed_url(spark, folder):
    return _pages(spark, folder).select("page_id", U.normalize_feed_url(F.col("url")).alias("url"))


@query("url_length_filter", "SELECT page_id, url FROM pages WHERE length(url) <= 40")
def url_length_filter(spark, folder):
    return _pages(spark, folder).filter(U.url_length_filter(F.col("url"), 40)).select("page_id", "url")


@query("append_fragment", "SELECT page_id, url || '#jobs' AS url FROM pages")
def append_fragment(spark, folder):
    return _pages(spark, folder).select("page_id", U.append_fragment(F.col("url"), "#jobs").alias("url"))
