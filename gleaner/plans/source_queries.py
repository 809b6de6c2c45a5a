"""Sources and sinks over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gleaner.functions.markup import page_language
from gleaner.plans.inputs import ITEMS_SQL, items, pages
from gleaner.plans.registry import query
from gleaner.sources import files, tables
from gleaner.sources.tables import table


def scratch(spark, name):
    """A fresh folder below the checkpoint folder."""
    from gleaner.session import scratch_folder

    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


ENCODINGS_SQL = """coalesce({header}, 'utf-8') AS encoding_scrapy_guess, {header} AS encoding_headers, 'utf-8' AS encoding_body_declared, 'utf-8' AS encoding_body_inferred"""
HEADER_SQL = "CASE WHEN contains(url, 'blog') THEN 'iso-8859-1' END"


@query("scan_responses", f"SELECT page_id, url, html, {ENCODINGS_SQL.format(header=HEADER_SQL)} FROM pages")
def scan_responses(spark, folder):
    header = F.when(F.contains("url", F.lit("blog")), "text/html; charset=ISO-8859-1").otherwise("text/html")
    return tables.scan_responses(table(spark, folder, "pages"), header, F.encode("html", "UTF-8"))


@query(
    "raw_capture",
    f"""SELECT '99999' AS mining_job_id, '1' AS iteration, url, regexp_extract(url, '/([0-9]+)', 1) AS referencenumber,
              html AS raw_html, {ENCODINGS_SQL.format(header="CAST(NULL AS VARCHAR)")}, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS language
       FROM pages WHERE NOT contains(url, 'casino')""",
)
def raw_capture(spark, folder):
    return tables.raw_capture(
        tables.scan_responses(pages(spark, folder)),
        reference=F.regexp_extract("url", "/([0-9]+)", 1),
        reject=F.contains("url", F.lit("casino")),
        extra={"language": page_language(F.col("html"))},
        mining_job_id="99999",
        iteration="1",
    )


@query("scan_url_feed", "SELECT url, count(*) AS lines FROM pages GROUP BY url")
def scan_url_feed(spark, folder):
    path = scratch(spark, "feed")
    table(spark, folder, "pages").select(F.concat(F.lit("  "), "url", F.lit("\t")).alias("value")).write.text(path)
    return files.scan_url_feed(spark, path).groupBy("url").agg(F.count("*").alias("lines"))


@query("scan_dictionary", "SELECT p_name AS term, count(*) AS n FROM part GROUP BY p_name")
def scan_dictionary(spark, folder):
    path = scratch(spark, "dictionary")
    table(spark, folder, "part").select("p_name", "p_size").write.csv(path)
    return files.scan_dictionary(spark, path).groupBy("term").agg(F.count("*").alias("n"))


@query(
    "scan_robots",
    """SELECT doc_id, CAST(generate_subscripts(lines, 1) - 1 AS INTEGER) AS line_no, unnest(lines) AS line
       FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)""",
)
def scan_robots(spark, folder):
    return files.scan_robots(table(spark, folder, "documents"), "doc_id", "text")


@query(
    "write_items_jsonl",
    f"WITH {ITEMS_SQL} SELECT item_no, referencenumber, title, location, description FROM items",
)
def write_items_jsonl(spark, folder):
    path = scratch(spark, "items")
    fields = items(spark, folder).select("item_no", "referencenumber", "title", "location", "description")
    files.write_items_jsonl(fields, path)
    return spark.read.schema(fields.schema).json(path)


FLAGS = "o_totalprice < 50000 AS preview, o_orderpriority = '1-URGENT' AS aggregator, o_orderpriority = '2-HIGH' AS autocrawl, o_orderstatus <> 'P' AS extract"


@query(
    "route_items",
    f"""SELECT o_orderkey, CASE WHEN preview THEN CASE WHEN extract THEN 'temp-job' ELSE 'temp-raw' END
          WHEN aggregator THEN 'aggregator' WHEN autocrawl THEN 'autocrawl' WHEN extract THEN 'job' ELSE 'raw' END AS route
        FROM (SELECT o_orderkey, {FLAGS} FROM orders)""",
)
def route_items(spark, folder):
    flagged = table(spark, folder, "orders").selectExpr("o_orderkey", *FLAGS.split(", "))
    flags = [F.col(c) for c in ("preview", "aggregator", "autocrawl", "extract")]
    return flagged.select("o_orderkey", files.route_items(*flags).alias("route"))


@query(
    "run_lifecycle",
    """WITH runs AS (SELECT user_id, min(ts) AS a, max(ts) AS b FROM events GROUP BY user_id),
       r AS (SELECT *, CASE WHEN user_id < 20 THEN 'temp-job' WHEN user_id < 50 THEN 'aggregator-job' WHEN user_id < 90 THEN 'autocrawl' ELSE 'mining-job' END AS route FROM runs)
       SELECT user_id, route, 'start' AS message, epoch_us(a) AS at_us, CAST(NULL AS VARCHAR) AS end_message FROM r
       UNION ALL SELECT user_id, route, 'stop', epoch_us(b), CASE WHEN route = 'autocrawl' THEN 'done' END FROM r""",
)
def run_lifecycle(spark, folder):
    run = F.col("user_id")
    route = files.lifecycle_route(run < 20, run < 50, run < 90)
    rows = files.run_lifecycle(
        table(spark, folder, "events"), "user_id", "ts", route=route, end_fields={"end_message": F.lit("done")}
    )
    return rows.select(
        "user_id", "route", "message", F.unix_micros(F.col("at").cast("timestamp")).alias("at_us"), "end_message"
    )


@query(
    "payload_b64url",
    """SELECT doc_id, replace(replace(base64(encode(to_json({'doc_id': doc_id, 'lang': lang, 'source': source, 'text': text})::VARCHAR)), '+', '-'), '/', '_') AS payload
       FROM documents""",
)
def payload_b64url(spark, folder):
    fields = ["doc_id", "lang", "source", "text"]
    return table(spark, folder, "documents").select("doc_id", files.payload_b64url(fields).alias("payload"))


@query(
    "decode_body",
    """SELECT doc_id, replace(text, '…', '') AS text,
              replace(text, '…', '') AS latin, replace(text, '…', '') AS western, text AS wide FROM documents""",
)
def decode_body(spark, folder):
    docs = table(spark, folder, "documents")
    text = F.replace("text", F.lit("…"), F.lit(""))

    def through(column, charset, encoded):
        return files.decode_body(encoded, F.lit(charset)).alias(column)

    return docs.select(
        "doc_id",
        through("text", None, F.encode(text, "UTF-8")),
        through("latin", "ISO-8859-1", F.encode(text, "ISO-8859-1")),
        through("western", "cp1252", F.encode(text, "ISO-8859-1")),
        through("wide", "utf-16-le", F.encode("text", "UTF-16LE")),
    )


@query(
    "parse_selector_config",
    """SELECT p_partkey, 'serp_location' AS id, '.' || p_type AS selector FROM part
       UNION ALL SELECT p_partkey, 'serp_job_link', 'a.' || p_brand FROM part""",
)
def parse_selector_config(spark, folder):
    part = table(spark, folder, "part")
    config = F.concat(
        F.lit('[{"id": "serp_location", "selector": ".'),
        "p_type",
        F.lit('"}, {"id": "serp_job_link", "selector": "a.'),
        "p_brand",
        F.lit('"}]'),
    )
    return part.select("p_partkey", F.inline(files.parse_selector_config(config)))
