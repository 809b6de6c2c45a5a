"""Defaults, rejects and validity of items. Absent is NULL, empty is ''; defaults fill only absent fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.entities import TOP_LEVEL_DOMAINS, extract_emails, extract_logos, extract_salaries, extract_websites
from gleaner.functions.text import blank_to_null
from gleaner.operators.rollups import top_per_group

# Fields a posting must have.
REQUIRED_FIELDS = ("title", "description", "referencenumber", "location", "url", "company")
SITE_FIELDS = ("title", "description", "referencenumber", "location")
MAX_REFERENCE = 50


def fill_absent(items: DataFrame, getters: Mapping[str, Column]) -> DataFrame:
    """Fill each absent field from its getter; a field the table lacks is added."""
    filled = {
        name: F.coalesce(F.col(name), value) if name in items.columns else value for name, value in getters.items()
    }
    return items.withColumns(filled)


def item_defaults(items: DataFrame, page_url: Column, now: Column, language: Column | None = None) -> DataFrame:
    """Absent url, date and language; an empty default sets nothing."""
    getters = {"url": blank_to_null(page_url), "date": F.date_format(now, "yyyy/MM/dd")}
    if language is not None:
        getters["language"] = blank_to_null(language)
    return fill_absent(items, getters)


def ingest_defaults(items: DataFrame, now: Column, run: Mapping[str, Column], language: Column | None = None) -> DataFrame:
    """Absent date and run fields such as mining_job_id, spidername, iteration, on_demand and site_id."""
    getters = {"date": F.date_format(now, "yyyy-MM-dd HH:mm:ss"), **run}
    if language is not None:
        getters["language"] = blank_to_null(language)
    return fill_absent(items, getters)


def location_fallback(items: DataFrame) -> DataFrame:
    zip_code = blank_to_null(F.col("zip_code"))
    return items.withColumn("location", F.coalesce(blank_to_null(F.col("location")), zip_code, F.col("location")))


def auto_fields(
    pages: DataFrame,
    tlds: Sequence[str] = TOP_LEVEL_DOMAINS,
    logos: bool = True,
    emails: bool = True,
    salaries: bool = True,
    websites: bool = True,
    enabled: Column | None = None,
    html: str = "html",
    body: str = "body_text",
    links: str = "links",
) -> DataFrame:
    """Entities of the page in the autoextracted fields that are absent, one switch each."""
    getters = {}
    if logos:
        getters["autoextracted_logo_urls"] = extract_logos(F.col(html), F.col("url"))
    if emails:
        getters["autoextracted_emails"] = extract_emails(F.col(body))
    if salaries:
        getters["autoextracted_salaries"] = extract_salaries(F.col(body))
    if websites:
        getters["autoextracted_company_websites"] = extract_websites(F.col(body), F.col(links), tlds)
    if enabled is not None:
        getters = {name: F.when(enabled, value) for name, value in getters.items()}
    return fill_absent(pages, getters)


def is_empty(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) == "")


def missing_fields(fields: Sequence[str] = REQUIRED_FIELDS) -> Column:
    """Names of the required fields that are absent or empty."""
    return F.array_compact(F.array(*[F.when(is_empty(f), F.lit(f)) for f in fields]))


def long_reference(limit: int = MAX_REFERENCE) -> Column:
    """Predicate: the reference number is too long."""
    return F.coalesce(F.length("referencenumber") > limit, F.lit(False))


def error_reason(status: Column, body: Column, messages: Sequence[str] = ()) -> Column:
    """Why a page is no posting: its status, or the listed messages its body holds; NULL for a good page."""
    found = F.array_compact(F.array(*[F.when(F.contains(body, F.lit(m)), F.lit(m)) for m in messages]))
    by_body = F.when(F.size(found) > 0, F.concat(F.lit("Response Body Error: "), F.array_join(found, ", ")))
    by_status = F.when(status >= 400, F.concat(F.lit("Status Code Error: "), status.cast("string")))
    return F.coalesce(by_status, by_body) if messages else by_status


def reject_reason(local: bool = True, error: Column | None = None) -> Column:
    """First reason to drop an item, NULL to keep it. A long reference drops an item only in local mode."""
    reasons = [] if error is None else [F.when(error.isNotNull(), F.lit("error_page"))]
    reasons.append(F.when(is_empty("referencenumber"), F.lit("missing_reference")))
    if local:
        reasons.append(F.when(long_reference(), F.lit("long_reference")))
    return F.coalesce(*reasons)


def error_page_filter(pages: DataFrame, status: str, body: str, messages: Sequence[str] = ()) -> DataFrame:
    return pages.filter(error_reason(F.col(status), F.col(body), messages).isNull())


def drop_long_reference(items: DataFrame, local: bool = True, limit: int = MAX_REFERENCE) -> DataFrame:
    return items.filter(~long_reference(limit)) if local else items


def require_reference(items: DataFrame) -> DataFrame:
    return items.filter(~is_empty("referencenumber"))


def debug_urls(items: DataFrame, failed: Column, fields: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Debug mode keeps all rows: one row per url and problem, a failed page or a missing field."""
    problems = F.concat(F.array_compact(F.array(F.when(failed, F.lit("failed_url")))), missing_fields(fields))
    return items.select("url", F.explode(problems).alias("problem"))


def debug_report(items: DataFrame, failed: Column, fields: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """How many urls have each problem, and how many jobs miss any required field, in one pass."""
    counts = [F.count_if(failed).alias("failed_url")]
    counts += [F.count_if(is_empty(f)).alias(f"missing_{f}") for f in fields]
    counts.append(F.count_if(F.size(missing_fields(fields)) > 0).alias("jobs_missing_required_field"))
    wide = items.agg(*counts)
    return wide.unpivot([], wide.columns, "problem", "n")


def max_items_limit(items: DataFrame, run: str, order: Sequence[Column], limit: int) -> DataFrame:
    """First `limit` items of each run; 0 keeps all."""
    return top_per_group(items, [run], order, limit).drop("rank") if limit else items


def site_validity(
    items: DataFrame, site: str, order: Sequence[Column], max_items: int, cutoff: int | None = None, fields: Sequence[str] = SITE_FIELDS
) -> DataFrame:
    """A site is valid when enough of its first items miss no field, by default 80 % rounded down."""
    needed = int(max_items * 0.8) if cutoff is None else cutoff
    first = top_per_group(items, [site], order, max_items)
    complete = F.count_if(F.size(missing_fields(fields)) == 0)
    return first.groupBy(site).agg(
        F.count("*").alias("n_checked"),
        complete.alias("n_complete"),
        ((complete >= needed) & F.lit(needed > 0)).alias("valid"),
    )
