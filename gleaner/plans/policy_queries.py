"""Robots, offsite, feed and list-page decisions over the given pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions.markup import extract_links
from gleaner.functions.urls import netloc
from gleaner.operators import policy as P
from gleaner.operators import robots as J
from gleaner.operators.elements import TREE_FIELDS, parse_pages
from gleaner.operators.selectors import Page
from gleaner.plans.inputs import pages
from gleaner.plans.page_queries import LINKS_SQL, TITLE_SQL
from gleaner.plans.registry import query
from gleaner.sources.tables import table

HOST_SQL = "regexp_extract(url, '^https?://([^/?#]*)', 1)"
TAIL_SQL = "regexp_extract(url, '^https?://[^/?#]*(.*)$', 1)"
LANG_SQL = "regexp_extract(url, '^https?://[^/]*/([a-z]+)', 1)"
# Every host forbids the language of its first page, and has a group of its own for one agent.
HOSTS_SQL = f"hosts AS (SELECT {HOST_SQL} AS host, min({LANG_SQL}) AS lang FROM pages GROUP BY 1)"

ROBOTS_TEXT = (
    "# robots\nUser-agent: *\nDisallow: /%s/  # first\nAllow: /%s/1\nNoise: x\nDisallow: /*.html$\nDisallow:\n\n"
    "User-agent: FooBot\r\n# still the same group\r\nUseragent: BarBot\r\nAllow: /en/%%31\r\nDisallow: /en/\r\n"
    "Crawl-delay: 2.5\r\nSitemap: https://%s/sitemap.xml\r\nUser-agent: Nobody\n\nDisallow: /lost"
)


def _robots(spark, folder):
    host = netloc(F.col("url"))
    lang = F.regexp_extract("url", "^https?://[^/]*/([a-z]+)", 1)
    hosts = table(spark, folder, "pages").groupBy(host.alias("host")).agg(F.min(lang).alias("lang"))
    return hosts.select("host", F.format_string(ROBOTS_TEXT, "lang", "lang", "host").alias("body"))


def _requests(spark, folder):
    return table(spark, folder, "pages").select("page_id", "url")


@query(
    "robots_rules",
    f"""WITH {HOSTS_SQL}
    SELECT host, CAST(2 AS INTEGER) AS group_no, '*' AS agent, CAST(i AS INTEGER) AS ord, k AS kind, replace(p, 'LANG', lang) AS path, CAST(NULL AS DOUBLE) AS crawl_delay
    FROM hosts, (VALUES (0, 'disallow', '/LANG/'), (1, 'allow', '/LANG/1'), (2, 'disallow', '/*.html$'), (3, 'disallow', '')) r(i, k, p)
    UNION ALL SELECT host, 1, a, i, k, p, 2.5 FROM hosts, (VALUES ('FooBot'), ('BarBot')) b(a), (VALUES (0, 'allow', '/en/1'), (1, 'disallow', '/en/')) r(i, k, p)""",
)
def robots_rules(spark, folder):
    return J.robots_rules(J.robots_groups(_robots(spark, folder)))


@query(
    "robots_decide",
    f"""WITH {HOSTS_SQL}, r AS (SELECT page_id, {TAIL_SQL} AS tail, lang FROM pages JOIN hosts ON host = {HOST_SQL})
        SELECT page_id, NOT (starts_with(tail, '/' || lang || '/') OR regexp_matches(tail, '^/.*\\.html$')) AS other,
               NOT starts_with(tail, '/en/') OR starts_with(tail, '/en/1') AS foobot FROM r""",
)
def robots_decide(spark, folder):
    groups = J.robots_groups(_robots(spark, folder))
    agents = {"other": "Other/2.0 (x)", "foobot": "Mozilla FOOBOT/1.0"}
    return J.decide_for_agents(_requests(spark, folder), groups, agents).select("page_id", *agents)


@query(
    "robots_decide_strict",
    f"""WITH {HOSTS_SQL} SELECT page_id, NOT starts_with({TAIL_SQL}, '/' || lang || '/') AS allowed FROM pages JOIN hosts ON host = {HOST_SQL}""",
)
def robots_decide_strict(spark, folder):
    groups = J.robots_groups(_robots(spark, folder))
    return J.robots_decide(_requests(spark, folder), groups, "Other", strict=True).select("page_id", "allowed")


@query("robots_decide_relaxed", "SELECT page_id, true AS other, NOT starts_with(path, '/en/') OR starts_with(path, '/en/1') AS foobot"
       " FROM (SELECT page_id, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS path FROM pages)")
def robots_decide_relaxed(spark, folder):
    # The empty disallow rule of the default group allows all, and allow rules go first.
    groups = J.robots_groups(_robots(spark, folder), relaxed=True)
    agents = {"other": "Other", "foobot": "FooBot/1.0"}
    return J.decide_relaxed_for_agents(_requests(spark, folder), groups, agents).select("page_id", *agents)


STATUS_SQL = "CASE WHEN contains(url, 'blog') THEN 403 WHEN contains(url, 'www') THEN 404 WHEN contains(url, '//m.') THEN 503 ELSE 200 END"


@query(
    "robots_by_status",
    f"""SELECT page_id, CASE {STATUS_SQL} WHEN 403 THEN 'deny' WHEN 404 THEN 'allow' WHEN 503 THEN 'error' END AS strict,
               CASE WHEN {STATUS_SQL} >= 400 THEN 'allow' END AS relaxed FROM pages""",
)
def robots_by_status(spark, folder):
    status = F.expr(STATUS_SQL)
    return _requests(spark, folder).select(
        "page_id", J.robots_by_status(status).alias("strict"), J.robots_by_status(status, strict=False).alias("relaxed")
    )


@query(
    "crawl_delay",
    f"""SELECT page_id, CAST(2.5 AS DOUBLE) AS crawl_delay FROM pages""",
)
def crawl_delay(spark, folder):
    decided = J.robots_decide(_requests(spark, folder), J.robots_groups(_robots(spark, folder)), "barbot")
    return decided.select("page_id", "crawl_delay")


@query(
    "apply_robots_status",
    f"""WITH {HOSTS_SQL}, d AS (SELECT page_id, NOT starts_with({TAIL_SQL}, '/' || lang || '/') AS allowed,
           CASE WHEN contains({HOST_SQL}, 'blog') THEN 403 WHEN contains({HOST_SQL}, 'www') THEN 404 WHEN starts_with({HOST_SQL}, 'm.') THEN 503 ELSE 200 END AS status
           FROM pages JOIN hosts ON host = {HOST_SQL})
        SELECT page_id, CASE status WHEN 403 THEN false WHEN 404 THEN true WHEN 503 THEN NULL ELSE allowed END AS strict,
               CASE WHEN status >= 400 THEN true ELSE allowed END AS relaxed FROM d""",
)
def apply_robots_status(spark, folder):
    robots = _robots(spark, folder)
    host = F.col("host")
    status = F.when(host.contains("blog"), 403).when(host.contains("www"), 404).when(host.startswith("m."), 503).otherwise(200)
    fetches = robots.select("host", status.alias("status"))
    decided = J.robots_decide(_requests(spark, folder), J.robots_groups(robots), "Other", strict=True)
    strict = J.apply_robots_status(decided.withColumn("rules", F.col("allowed")), fetches).withColumnRenamed("allowed", "strict")
    relaxed = J.apply_robots_status(strict.withColumnRenamed("rules", "allowed"), fetches, strict=False)
    return relaxed.select("page_id", "strict", F.col("allowed").alias("relaxed"))


REFETCHED_SQL = f"""fetches AS (SELECT {HOST_SQL} AS host, page_id AS nth, CASE page_id % 5 WHEN 0 THEN 404 WHEN 1 THEN 403 WHEN 2 THEN 503 ELSE 200 END AS status,
           '/' || {LANG_SQL} || CASE WHEN page_id % 2 = 0 THEN '/*' || page_id % 10 || '$' ELSE '/' || page_id % 10 END AS path FROM pages),
        last AS (SELECT host, max(nth) AS nth, max_by(status, nth) AS status, max_by(path, nth) AS path FROM fetches GROUP BY host)"""


@query(
    "robots_refetched",
    f"""WITH {REFETCHED_SQL}, d AS (SELECT page_id, status, CASE WHEN path LIKE '%$' THEN starts_with(tail, replace(split_part(path, '*', 1), '$', '')) AND ends_with(tail, replace(split_part(path, '*', 2), '$', ''))
             AND length(tail) >= length(path) - 2 ELSE starts_with(tail, path) END AS hit, EXTRACT(YEAR FROM TIMESTAMP '2016-01-01 00:00:00' + to_days(CAST(nth AS INTEGER)) + INTERVAL 7 DAY) > 2016 AS late
           FROM (SELECT page_id, {TAIL_SQL} AS tail, {HOST_SQL} AS host FROM pages) JOIN last USING (host))
        SELECT page_id, CASE WHEN status = 403 THEN false WHEN status = 404 THEN true WHEN status = 503 THEN NULL ELSE NOT hit END AS allowed, late FROM d""",
)
def robots_refetched(spark, folder):
    """Every page was also a fetch of its host's robots text; of all fetches of a host, the last one decides."""
    lang = F.regexp_extract("url", "^https?://[^/]*/([a-z]+)", 1)
    last = (F.col("page_id") % 10).cast("string")
    path = F.concat(F.lit("/"), lang, F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/*"), last, F.lit("$"))).otherwise(F.concat(F.lit("/"), last)))
    status = F.get(F.array(*map(F.lit, (404, 403, 503, 200, 200))), (F.col("page_id") % 5).cast("int"))
    fetches = table(spark, folder, "pages").select(
        netloc(F.col("url")).alias("host"),
        F.col("page_id").alias("nth"),
        status.alias("status"),
        F.format_string("User-agent: *\nDisallow: %s\n", path).alias("body"),
    )
    decided = J.robots_decide(_requests(spark, folder), J.robots_groups(fetches, fetched="nth"), "Other")
    decided = J.apply_robots_status(decided, fetches, fetched="nth")
    times = fetches.groupBy("host").agg(F.max("nth").alias("nth"))
    fetched = F.timestamp_add("DAY", F.col("nth").cast("int"), F.lit("2016-01-01 00:00:00").cast("timestamp"))
    late = F.year(J.robots_expiry(F.lit(None).cast("string"), fetched)) > 2016
    return decided.join(times, "host").select("page_id", "allowed", late.alias("late"))


@query("sitemaps", f"WITH {HOSTS_SQL} SELECT host, 'https://' || host || '/sitemap.xml' AS sitemap FROM hosts")
def sitemaps(spark, folder):
    return J.sitemaps(_robots(spark, folder)).select("host", "sitemap")


@query(
    "robots_expiry",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 3 DAY ELSE o_orderdate + INTERVAL 7 DAY END <= TIMESTAMP '1999-01-01 00:00:00' AS expired FROM orders""",
)
def robots_expiry(spark, folder):
    fetched = F.col("o_orderdate").cast("timestamp")
    header = F.date_format(fetched + F.expr("INTERVAL 3 DAYS"), "EEE, dd MMM yyyy HH:mm:ss")
    expires = F.when(F.col("o_orderstatus") == "F", F.concat(header, F.lit(" GMT"))).when(F.col("o_orderstatus") == "O", "soon")
    now = F.lit("1999-01-01 00:00:00").cast("timestamp")
    return table(spark, folder, "orders").select("o_orderkey", J.is_expired(expires, fetched, now).alias("expired"))


ALLOWED_SQL = f"""req AS (SELECT page_id, url, {HOST_SQL} AS host, {LANG_SQL} AS site_id FROM pages),
    allowed AS (SELECT DISTINCT site_id, regexp_replace(host, '^(m|blog)\\.', '') AS domain FROM req WHERE starts_with(url, 'https') AND site_id <> 'es'),
    flagged AS (SELECT page_id, host, NOT EXISTS (SELECT 1 FROM allowed a WHERE a.site_id = r.site_id)
        OR EXISTS (SELECT 1 FROM allowed a WHERE a.site_id = r.site_id AND (r.host = a.domain OR ends_with(r.host, '.' || a.domain)))
        OR contains(url, 'casino') AS follow FROM req r)"""


def _flagged(spark, folder):
    site = F.regexp_extract("url", "^https?://[^/]*/([a-z]+)", 1)
    requests = _requests(spark, folder).withColumn("site_id", site)
    domain = F.regexp_replace(netloc(F.col("url")), r"^(m|blog)\.", "")
    allowed = requests.filter("startswith(url, 'https') AND site_id <> 'es'").select("site_id", domain.alias("domain"))
    return P.offsite_flag(requests, allowed, dont_filter=F.contains("url", F.lit("casino")))


@query("offsite_filter", f"WITH {ALLOWED_SQL} SELECT page_id FROM flagged WHERE follow")
def offsite_filter(spark, folder):
    return _flagged(spark, folder).filter("follow").select("page_id")


@query("offsite_policy", f"SELECT page_id, url FROM pages WHERE {HOST_SQL} LIKE '%.example.org'")
def offsite_policy(spark, folder):
    # The policy of the site stands in place of its domains.
    requests = _requests(spark, folder).withColumn("site_id", F.lit("all"))
    allowed = requests.select("site_id", netloc(F.col("url")).alias("domain"))
    kept = P.offsite_filter(requests, allowed, policy=F.col("host").endswith(".example.org"))
    return kept.select("page_id", "url")


@query(
    "offsite_counts",
    f"WITH {ALLOWED_SQL} SELECT count(DISTINCT host) AS offsite_domains, count(*) AS offsite_filtered FROM flagged WHERE NOT follow",
)
def offsite_counts(spark, folder):
    return P.offsite_counts(_flagged(spark, folder))


@query(
    "on_site",
    f"SELECT page_id, regexp_matches({HOST_SQL}, '(^|\\.)(example\\.com|blog\\.theror\\.example\\.net)$') AS follow FROM pages",
)
def on_site(spark, folder):
    follow = P.on_site(netloc(F.col("url")), ["example.com", "blog.theror.example.net"])
    return _requests(spark, folder).select("page_id", follow.alias("follow"))


@query(
    "clean_url_feed",
    """WITH feed AS (SELECT page_id AS line_no, '  ' || url AS url FROM pages UNION ALL SELECT page_id + 1000000, replace(url, 'https://', 'http://www.') FROM pages
           UNION ALL SELECT page_id + 2000000, 'https://taleo.net/' FROM pages),
       n AS (SELECT replace(replace(trim(url), 'http://', 'https://'), '//www.', '//') AS url, min(line_no) AS line_no FROM feed GROUP BY 1),
       bad AS (SELECT DISTINCT replace(replace(url, 'http://', 'https://'), '//www.', '//') AS url FROM pages WHERE contains(url, '#'))
       SELECT line_no, url FROM n WHERE url <> 'https://taleo.net/' AND url NOT IN (SELECT url FROM bad)""",
)
def clean_url_feed(spark, folder):
    pages_ = _requests(spark, folder)
    feed = pages_.select(F.col("page_id").alias("line_no"), F.concat(F.lit("  "), "url").alias("url"))
    feed = feed.unionByName(
        pages_.select((F.col("page_id") + 1000000).alias("line_no"), F.replace("url", F.lit("https://"), F.lit("http://www.")).alias("url"))
    ).unionByName(pages_.select((F.col("page_id") + 2000000).alias("line_no"), F.lit("https://taleo.net/").alias("url")))
    known = pages_.filter("contains(url, '#') OR contains(url, 'page=2')").select(
        P.normalize_feed_url(F.col("url")).alias("url"), F.when(F.contains("url", F.lit("#")), 404).otherwise(200).alias("status")
    )
    return P.clean_url_feed(feed, known, P.SKIP_URLS)


@query(
    "robots_media_type",
    "SELECT doc_id, 'text/html' AS media_type, source AS charset FROM documents",
)
def robots_media_type(spark, folder):
    from gleaner.sources.files import robots_media_type as media_type

    header = F.concat(F.lit(" Text/HTML ; q=1; Charset='"), F.upper("source"), F.lit("'"))
    return table(spark, folder, "documents").select("doc_id", F.inline(F.array(media_type(header))))


SERP_CONFIG = [
    {"id": "serp_job_link", "selector": "nav li a[href]"},
    {"id": "serp_location", "selector": "article h1"},
    {"id": "serp_title", "selector": "title"},
]


@query(
    "serp_link_match",
    f"""WITH {LINKS_SQL}, f AS (SELECT href, min({TITLE_SQL}) AS place FROM links JOIN pages USING (page_id)
          WHERE pos = 0 AND href <> '' AND {TITLE_SQL} <> '' GROUP BY href)
        SELECT page_id, CAST(pos AS INTEGER) AS pos, href AS url, place AS serp_location, CASE WHEN place IS NOT NULL THEN href END AS serp_job_link
        FROM links LEFT JOIN f USING (href)""",
)
def serp_link_match(spark, folder):
    source = pages(spark, folder)
    requests = source.select("page_id", F.posexplode(extract_links(F.col("html"))).alias("pos", "url"))
    parsed = parse_pages(source, keep=["page_id"], fields=TREE_FIELDS)
    serp = parsed.select(
        P.serp_value(Page(), SERP_CONFIG, "serp_job_link").alias("serp_job_link"),
        P.serp_value(Page(), SERP_CONFIG, "serp_location").alias("serp_location"),
    )
    return P.serp_link_match(requests, serp).select("page_id", "pos", "url", "serp_location", "serp_job_link")
