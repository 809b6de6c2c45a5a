"""The job posting record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# The fields of a posting.
SYSTEM_FIELDS = (
    "mining_job_id", "site_id", "batch_id", "iteration", "spidername", "start_url", "on_demand",
)
REQUIRED_FIELDS = (
    "title", "date", "expiration_date", "referencenumber", "url", "company", "company_description", "location",
    "zip_code", "description", "jobcategory", "jobtype", "org_name", "apply_url",
)
OPTIONAL_FIELDS = (
    "industry", "duration", "baseSalary", "benefits", "educationrequirements", "experiencerequirements",
    "incentives", "qualifications", "responsibilities", "requirements", "salaryCurrency", "skills",
    "specialcommitments", "workhours", "tracking_pixel_url",
)
CODED_FIELDS = ("ingested_industry_codes", "functions", "experience_level")
EXTRACTED_FIELDS = (
    "autoextracted_logo_urls", "autoextracted_emails", "autoextracted_salaries", "autoextracted_company_websites",
)
ENCODING_FIELDS = ("encoding_scrapy_guess", "encoding_headers", "encoding_body_declared", "encoding_body_inferred")
OTHER_FIELDS = (
    "other", "logo_url", "incremental_crawler_hash", "raw_html", "config", "page_classification", "language", "referer",
)

ITEM_SCHEMA = StructType(
    [
        StructField(name, ArrayType(StringType()) if name in EXTRACTED_FIELDS else StringType())
        for name in (
            *SYSTEM_FIELDS,
            *REQUIRED_FIELDS,
            *OPTIONAL_FIELDS,
            *CODED_FIELDS,
            *EXTRACTED_FIELDS,
            *ENCODING_FIELDS,
            *OTHER_FIELDS,
        )
    ]
)


def as_items(df: DataFrame) -> DataFrame:
    """All posting fields in their order; a field the table lacks is absent, which is NULL."""
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ITEM_SCHEMA.fields
        ]
    )
