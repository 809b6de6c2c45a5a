"""Tables the engine reads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.sources.schema import ENCODING_FIELDS


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan_responses(pages: DataFrame, content_type: Column | None = None, body: Column | None = None) -> DataFrame:
    """One row per fetched page: url, html and its four encodings.

    The header names one, the page itself declares one, the bytes allow one (`body`; a text column is UTF-8),
    and the guess is the first of them.
    """
    from gleaner.sources.files import robots_media_type

    charset = F.lit(None).cast("string") if content_type is None else robots_media_type(content_type)["charset"]
    meta = F.regexp_extract("html", r"""(?i)<meta[^>]+charset=["']?([A-Za-z0-9_.:-]+)""", 1)
    fits = F.lit(True) if body is None else F.is_valid_utf8(body.cast("string"))
    headers, declared = F.nullif(charset, F.lit("")), F.lower(F.nullif(meta, F.lit("")))
    inferred = F.when(fits, "utf-8").otherwise("cp1252")
    return pages.select(
        "page_id",
        "url",
        "html",
        F.coalesce(headers, declared, inferred).alias("encoding_scrapy_guess"),
        headers.alias("encoding_headers"),
        declared.alias("encoding_body_declared"),
        inferred.alias("encoding_body_inferred"),
    )


def raw_capture(
    responses: DataFrame,
    reference: Column | None = None,
    reject: Column | None = None,
    extra: Mapping[str, Column] | None = None,
    **ids: str,
) -> DataFrame:
    """Raw mode: the whole page with its ids and encodings and no extracted field but the reference number.

    `reject` is a predicate for pages that are no posting; `extra` adds named columns.
    """
    kept = responses if reject is None else responses.filter(~F.coalesce(reject, F.lit(False)))
    return kept.select(
        *[F.lit(value).alias(name) for name, value in ids.items()],
        "url",
        (F.lit(None).cast("string") if reference is None else reference).alias("referencenumber"),
        F.col("html").alias("raw_html"),
        *ENCODING_FIELDS,
        *[column.alias(name) for name, column in (extra or {}).items()],
    )
