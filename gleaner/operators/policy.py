"""Which requests go out: offsite filter, url feed, links of a list page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import strip
from gleaner.functions.urls import hostname, normalize_feed_url
from gleaner.operators.joins import lookup_join
from gleaner.operators.selectors import Page, css_nodes, take
from gleaner.session import cut_lineage

# Feed urls that lead to no job board of their own.
SKIP_URLS = ("https://icims.com/", "https://www2.icims.com/", "https://www3.icims.com/", "https://taleo.net/")

# Fields a list page hands to the request of a job.
SERP_FIELDS = ("serp_job_link", "serp_location")


def host_suffixes(host: Column) -> Column:
    """The host and every domain above it."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


def on_site(host: Column, domains: Sequence[str]) -> Column:
    """Predicate for a fixed list of allowed domains; an empty list allows all."""
    if not domains:
        return F.lit(True)
    allowed = F.array(*[F.lit(d) for d in domains])
    return F.coalesce(F.arrays_overlap(host_suffixes(host), allowed), F.lit(False))


def offsite_flag(
    requests: DataFrame,
    allowed: DataFrame,
    site: str = "site_id",
    url: str = "url",
    dont_filter: Column | None = None,
    enabled: Column | None = None,
    policy: Column | None = None,
) -> DataFrame:
    """Add `host` and `follow`: the host lies under a domain of its site in `allowed(site, domain)`.

    Filtering must be switched on; a site without domains keeps all; `dont_filter` bypasses it; `policy` is a
    predicate over the request and its `host` that takes the place of the domain test. Each host of a site is
    looked at once, so suffixes are never multiplied by the requests.
    """
    keyed = requests.withColumn("host", F.coalesce(hostname(F.col(url)), F.lit("")))
    hosts = keyed.select(site, "host").distinct()
    listed = allowed.select(site, F.lower("domain").alias("domain")).distinct()
    under = hosts.select(site, "host", F.explode(host_suffixes(F.col("host"))).alias("domain"))
    good = under.join(listed, [site, "domain"], "left_semi").select(site, "host").distinct()
    sites = listed.select(site).distinct()
    flags = hosts.join(good.withColumn("_good", F.lit(True)), [site, "host"], "left")
    flags = flags.join(sites.withColumn("_listed", F.lit(True)), site, "left")
    verdicts = flags.select(site, "host", (F.col("_good").isNotNull() | F.col("_listed").isNull()).alias("follow"))
    if policy is None:
        joined = lookup_join(keyed, cut_lineage(verdicts), [site, "host"])
    else:
        joined = keyed.withColumn("follow", policy)
    bypass = [c for c in (dont_filter, None if enabled is None else ~enabled) if c is not None]
    for test in bypass:
        joined = joined.withColumn("follow", F.col("follow") | F.coalesce(test, F.lit(False)))
    return joined


def offsite_filter(requests: DataFrame, allowed: DataFrame, **options) -> DataFrame:
    return offsite_flag(requests, allowed, **options).filter("follow").drop("follow", "host")


def offsite_counts(flagged: DataFrame) -> DataFrame:
    """Distinct hosts filtered out, and requests filtered out."""
    return flagged.filter(~F.col("follow")).agg(
        F.countDistinct(F.nullif("host", F.lit(""))).alias("offsite_domains"), F.count("*").alias("offsite_filtered")
    )


def clean_url_feed(feed: DataFrame, statuses: DataFrame, skip: Sequence[str] | DataFrame = ()) -> DataFrame:
    """Feed urls by first line, normalised and distinct, without skipped urls and urls known not to answer 200.

    `feed(line_no, url)`; `statuses(url, status)` holds what is known; a url of unknown status is kept.
    """
    urls = feed.select("line_no", normalize_feed_url(strip(F.col("url"))).alias("url"))
    first = urls.groupBy("url").agg(F.min("line_no").alias("line_no"))
    if isinstance(skip, DataFrame):
        first = first.join(skip.select("url").distinct(), "url", "left_anti")
    else:
        first = first.filter(~F.col("url").isin(*skip))
    bad = statuses.groupBy("url").agg(F.bool_or(F.col("status") == 200).alias("_good")).filter("NOT _good")
    return first.join(bad, "url", "left_anti").select("line_no", "url")


def serp_value(page: Page, config: Sequence[dict], field: str) -> Column:
    """Value the configured selector of a field finds first on a list page: a link or a text."""
    selectors = [entry["selector"] for entry in config if entry.get("id") == field and entry.get("selector")]
    if not selectors:
        return F.lit(None).cast("string")
    nodes = F.slice(css_nodes(page, selectors[-1]), 1, 1)
    value = F.get(take(page, nodes, "@href" if field == "serp_job_link" else "string()"), F.lit(0))
    return F.when(value != "", value)


def serp_link_match(requests: DataFrame, serp: DataFrame, url: str = "url") -> DataFrame:
    """Give a job request the fields of the list page whose job link is its url.

    Only pages where every required field was found count; other requests stay as they are.
    """
    complete = F.lit(True)
    for field in SERP_FIELDS:
        complete = complete & F.coalesce(F.col(field) != "", F.lit(False))
    found = serp.filter(complete).groupBy(F.col("serp_job_link").alias(url)).agg(F.min("serp_location").alias("serp_location"))
    matched = lookup_join(requests, cut_lineage(found), [url])
    return matched.withColumn("serp_job_link", F.when(F.col("serp_location").isNotNull(), F.col(url)))
