"""What the given tables stand for, each as a Spark DataFrame and as SQL for the second engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleaner.session import spread
from gleaner.sources.tables import table

# Orders are job items: the customer is the crawl run, the priority is the site. Both engines run this text.
ITEM_COLUMNS = """
    o_orderkey AS item_no,
    concat('run', CAST(o_custkey AS STRING)) AS mining_job_id,
    o_orderpriority AS site_id,
    CASE WHEN o_totalprice < 20000 THEN NULL WHEN o_totalprice < 40000 THEN ''
         WHEN o_totalprice > 450000 THEN concat(repeat('9', 50), CAST(o_orderkey AS STRING))
         ELSE concat('ref-', CAST(o_orderkey AS STRING)) END AS referencenumber,
    CASE WHEN o_orderstatus = 'P' AND o_totalprice > 250000 THEN '' ELSE concat('job ', o_orderpriority) END AS title,
    concat('company ', CAST(o_custkey AS STRING)) AS company,
    CASE WHEN o_totalprice < 90000 THEN NULL WHEN o_totalprice < 120000 THEN ''
         ELSE concat('place ', substr(o_orderpriority, 1, 1)) END AS location,
    CAST(o_custkey AS STRING) AS zip_code,
    CASE WHEN o_totalprice > 430000 THEN NULL ELSE concat('about ', CAST(o_orderkey AS STRING)) END AS description,
    concat('http://www.jobs', CAST(o_custkey AS STRING), '.example.com/j/', CAST(o_orderkey AS STRING)) AS url,
    CASE o_orderstatus WHEN 'F' THEN 'Full-Time' WHEN 'O' THEN ' part time ' ELSE 'Casual' END AS jobtype,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Engineering' WHEN '2-HIGH' THEN 'Accounting/Auditing'
         WHEN '3-MEDIUM' THEN 'none' ELSE 'Night Shift' END AS job_function,
    CASE WHEN o_orderstatus = 'O' THEN NULL ELSE 'en' END AS language,
    CASE WHEN o_totalprice < 200000 THEN NULL ELSE '2016/05/01' END AS date,
    CASE WHEN o_orderstatus = 'F' AND o_totalprice < 100000 THEN 404
         WHEN o_orderstatus = 'O' AND o_totalprice < 60000 THEN 500 ELSE 200 END AS status,
    o_orderstatus,
    o_totalprice,
    o_orderdate AS scraped_at
"""
ITEMS_SQL = f"items AS (SELECT {ITEM_COLUMNS} FROM orders)"

# Text of the body of the given pages, for the second engine.
BODY_SQL = r"""body AS (SELECT page_id, url, html,
  replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<body>(.*)$', 1), '(?s)<!--.*?-->', '', 'g'),
      '<[^>]*>', '', 'g'), '$', ''),
    '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&'), '&amp', '&') AS body_text FROM pages)"""


def items(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "orders")).selectExpr(*split_columns(ITEM_COLUMNS))


def split_columns(text: str) -> list[str]:
    """Select expressions of a column list: commas inside brackets do not separate."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            out.append(text[start:i].strip())
            start = i + 1
    return [*out, text[start:].strip()]


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages, spread over all cores because each page is parsed or scanned as a whole."""
    return spread(table(spark, folder, "pages"))
