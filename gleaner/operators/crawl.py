"""A whole crawl in one query: list pages to job requests, the pages behind them, and the items these hold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.urls import url_join
from gleaner.operators.elements import body_text, parse_pages
from gleaner.operators.joins import lookup_join
from gleaner.operators.rules import Rule, RuleSet, job_index_rows, load_value, merge_index_detail, rule_cascade
from gleaner.operators.validate import error_reason, item_defaults, reject_reason
from gleaner.session import cut_lineage


@dataclass(frozen=True)
class Site:
    """How a site is read: its list pages, its detail pages, what a list page hands on, and what marks an error page."""

    rule_sets: Sequence[RuleSet]
    rules: Mapping[str, Rule]
    index_fields: Sequence[str] = ()
    messages: Sequence[str] = ()
    defaults: Mapping[str, Column] = field(default_factory=dict)


def index_requests(list_pages: DataFrame, site: Site, order: str = "page_id") -> DataFrame:
    """`url`, place on the list pages and the fields handed on, for every job that has a link."""
    rows = job_index_rows(parse_pages(list_pages, keep=[order, "url"]), site.rule_sets, keep=(order, "url"))
    handed = [load_value(f, F.col("custom_items")[f]).alias(f) for f in site.index_fields]
    place = F.struct(order, "rule_ix", "pos").alias("place")
    return rows.filter("joburl IS NOT NULL").select(url_join(F.col("url"), F.col("joburl")).alias("url"), place, *handed)


def first_responses(responses: DataFrame, requests: DataFrame, order: str = "page_id") -> DataFrame:
    """One response of each requested url, the first by `order`; pages that nobody asked for leave before any is shuffled."""
    wanted = cut_lineage(requests.select("url").distinct())
    asked = lookup_join(responses, wanted, ["url"], "left_semi")
    rest = [c for c in responses.columns if c != "url"]
    return asked.groupBy("url").agg(F.min_by(F.struct(*rest), order).alias("_page")).select("url", "_page.*")


def crawl_items(
    list_pages: DataFrame,
    responses: DataFrame,
    site: Site,
    now: Column,
    route: Column,
    language: Column | None = None,
    order: str = "page_id",
    local: bool = True,
) -> DataFrame:
    """Items of the pages behind the links of list pages, with `reject`, why an item is dropped, and `route`, where it goes.

    `list_pages(page_id, url, html)`, `responses(page_id, url, html, status)`. Values of the detail page win, those that the
    first link to it handed on fill the empty ones, then the defaults. `language` and `route` may read the columns of the item
    and `status`; the route of a rejected item is null. Each page is parsed once, and only the pages of requested urls are.
    """
    requests = cut_lineage(index_requests(list_pages, site, order))
    pages = first_responses(responses, requests, order)
    reason = error_reason(F.col("status"), body_text(), site.messages).alias("_error")
    # The reason is read from the same parsed row as the fields.
    parsed = parse_pages(pages, keep=["url", "status"]).withColumn("_error", reason)
    detail = rule_cascade(parsed, site.rules, keep=("url", "status", "_error"))
    missing = [F.lit(None).cast("string").alias(f) for f in site.index_fields if f not in site.rules]
    items = merge_index_detail(detail.select("*", *missing), requests, "place", list(site.index_fields), **site.defaults)
    items = item_defaults(items, F.col("url"), now, language)
    items = items.withColumn("reject", reject_reason(local, F.col("_error")))
    return items.withColumn("route", F.when(F.col("reject").isNull(), route)).drop("_error")
