"""Codes, entities, validation and rollups over items derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import codes as C
from gleaner.functions import entities as G
from gleaner.functions.markup import extract_links
from gleaner.operators import rollups as I
from gleaner.operators import validate as H
from gleaner.operators.code_tables import map_by_table
from gleaner.operators.elements import body_text, parse_pages
from gleaner.plans.inputs import BODY_SQL, ITEMS_SQL, items, pages, split_columns
from gleaner.plans.registry import query
from gleaner.session import spread
from gleaner.sources.tables import table

NOW = "2016-05-03 10:00:00"


def _in_order():
    return [F.asc("scraped_at"), F.asc("item_no")]


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


# Code mapping


@query(
    "map_job_field",
    f"""WITH {ITEMS_SQL} SELECT item_no, CASE o_orderstatus WHEN 'F' THEN 'FULL' WHEN 'O' THEN 'PART-RATE' ELSE 'CASUAL' END AS code,
          CASE o_orderstatus WHEN 'F' THEN 'FULL' WHEN 'O' THEN 'PART' ELSE 'CASUAL' END AS plain FROM items""",
)
def map_job_field(spark, folder):
    values = F.array("jobtype")
    codes = C.map_job_field(values, {"part": "PART-RATE"}, remove=["Time"])
    plain = C.map_job_field(values, {}, remove=["Time"])
    joined = [F.rtrim(F.array_join(c, "|")) for c in (codes, plain)]
    return items(spark, folder).select("item_no", joined[0].alias("code"), joined[1].alias("plain"))


@query(
    "map_job_field_table",
    f"""WITH {ITEMS_SQL}
        SELECT item_no, CASE WHEN starts_with(site_id, '4') THEN '4 NOT SPECIFIED' ELSE n_name END AS code
        FROM items LEFT JOIN nation ON n_nationkey = CAST(left(site_id, 1) AS INTEGER)""",
)
def map_job_field_table(spark, folder):
    names = ["0", "urgent", "high", "medium", "x", "low"]
    word = F.coalesce(F.get(F.array(*map(F.lit, names)), F.col("n_nationkey")), F.col("n_name"))
    key = F.concat(F.col("n_nationkey").cast("string"), F.lit(" "), word)
    code_map = table(spark, folder, "nation").select(key.alias("key"), F.col("n_name").alias("code"))
    return map_by_table(items(spark, folder), "site_id", code_map, "code").select("item_no", "code")


@query(
    "map_job_types",
    f"""WITH {ITEMS_SQL} SELECT item_no, CASE o_orderstatus WHEN 'F' THEN 'FULL_TIME' WHEN 'O' THEN 'PART_TIME|OTHER' ELSE 'CASUAL|PART_TIME' END AS codes FROM items""",
)
def map_job_types(spark, folder):
    letter = F.when(F.col("o_orderstatus") == "F", F.lit(" ")).otherwise(F.lower("o_orderstatus"))
    return items(spark, folder).select(
        "item_no", F.array_join(C.map_job_types(F.array("jobtype", letter)), "|").alias("codes")
    )


@query(
    "map_experience_level",
    """SELECT p_partkey, coalesce(['NOT_APPLICABLE', 'INTERNSHIP', 'ENTRY_LEVEL', 'ASSOCIATE', 'MID_SENIOR_LEVEL', 'DIRECTOR', 'EXECUTIVE'][p_size + 1],
              CAST(p_size AS VARCHAR)) AS level FROM part""",
)
def map_experience_level(spark, folder):
    size = F.col("p_size").cast("string")
    return table(spark, folder, "part").select(
        "p_partkey", F.array_join(C.map_experience_level(F.array(size)), "|").alias("level")
    )


@query(
    "map_functions",
    f"""WITH {ITEMS_SQL} SELECT item_no, CASE site_id WHEN '1-URGENT' THEN '["ENG","SALE","FOO"]' WHEN '2-HIGH' THEN '["ACCT","SALE","FOO"]'
          WHEN '3-MEDIUM' THEN '["SALE","FOO","LGL"]' ELSE '["NIGHT SHIFT","SALE","FOO"]' END AS functions FROM items""",
)
def map_functions(spark, folder):
    values = F.array(F.col("job_function"), F.lit("Sales"), F.lit("Foo"), F.lit("Legal"))
    return items(spark, folder).select("item_no", C.map_functions(values).alias("functions"))


@query(
    "map_industries",
    """SELECT p_partkey, '[47,' || CAST(to_json(p_name) AS VARCHAR) || ',' || CAST(to_json(p_type) AS VARCHAR) || ']' AS industries FROM part""",
)
def map_industries(spark, folder):
    text = F.concat(F.lit("Retail, "), "p_name", F.lit(" ,,"), "p_type")
    return table(spark, folder, "part").select(
        "p_partkey", C.map_industries(F.array(text, F.col("p_brand"))).alias("industries")
    )


# Entities

EMAIL_SQL = r"list_distinct(regexp_extract_all(text, '\b[A-Za-z0-9.+_-]+@[A-Za-z0-9._-]+\.[a-zA-Z]+\b', 0))"


@query("extract_emails", f"SELECT doc_id, array_to_string(list_sort({EMAIL_SQL}), '|') AS emails, len({EMAIL_SQL}) AS n FROM documents")
def extract_emails(spark, folder):
    found = G.extract_emails(F.col("text"))
    return table(spark, folder, "documents").select(
        "doc_id", F.array_join(F.array_sort(found), "|").alias("emails"), F.size(found).cast("bigint").alias("n")
    )


# Salary texts are made from order prices: `low` is the price, `high` one more, `k` its thousands.
SALARY_COLUMNS = """o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) AS low, CAST(CAST(floor(o_totalprice) AS BIGINT) + 1 AS STRING) AS high,
    CAST(30 + o_custkey % 70 AS STRING) AS k, CAST(o_custkey % 10 AS STRING) AS d"""


def _salary_texts(spark, folder):
    made = spread(table(spark, folder, "orders")).selectExpr(*split_columns(SALARY_COLUMNS))
    text = F.format_string(
        "Pay $%1$s - $%2$s per hour, $%3$s.50/day. Base €%3$s,%4$s00 - €%3$s,%4$s00! Or £%3$sk; bonus ¥%3$s,%4$s00.",
        "low", "high", "k", "d",
    )
    return made.withColumn("text", text)


SALARY_PARTS = {
    "salary_range_per_period": "'$' || low || ' - $' || high || ' per hour'",
    "salary_per_period": "'$' || k || '.50/day'",
    "salary_range": "'€' || k || ',' || d || '00 - €' || k || ',' || d || '00'",
    "salary_single": "'£' || k || 'k|¥' || k || ',' || d || '00'",
}


def _salary_query(name):
    def run(spark, folder):
        found = F.array_join(getattr(G, name)(F.col("text")), "|")
        return _salary_texts(spark, folder).select("o_orderkey", found.alias("found"))

    query(name, f"SELECT o_orderkey, {SALARY_PARTS[name]} AS found FROM (SELECT {SALARY_COLUMNS} FROM orders)")(run)


for _name in SALARY_PARTS:
    _salary_query(_name)


@query(
    "extract_salaries",
    f"""SELECT o_orderkey, {" || '|' || ".join(SALARY_PARTS.values())} AS found FROM (SELECT {SALARY_COLUMNS} FROM orders)""",
)
def extract_salaries(spark, folder):
    twice = F.concat("text", F.lit(" Again: "), "text")
    return _salary_texts(spark, folder).select("o_orderkey", F.array_join(G.extract_salaries(twice), "|").alias("found"))


WEBSITES_SQL = r"""sites AS (SELECT page_id, list_transform(list_filter(flatten(list_transform(string_split(body_text, ' '), lambda w: regexp_extract_all(w, '(?:https?://)?(?:www.)?([0-9a-zA-Z.-]+\.[a-z]{2,})', 1))),
      lambda s: regexp_matches(s, '\.(KNOWN)$')), lambda s: lower(s)) AS named,
      list_transform(list_filter(regexp_extract_all(html, '<a href="([^"]*)">', 1), lambda h: starts_with(h, 'http')), lambda h: regexp_extract(h, '//(?:www\.)?([^/:?#]*)', 1)) AS hosts FROM body)""".replace("KNOWN", "|".join(G.TOP_LEVEL_DOMAINS))


@query(
    "extract_websites",
    f"WITH {BODY_SQL}, {WEBSITES_SQL} SELECT page_id, array_to_string(list_sort(list_distinct(list_concat(named, hosts))), '|') AS websites FROM sites",
)
def extract_websites(spark, folder):
    parsed = parse_pages(pages(spark, folder).withColumn("links", extract_links(F.col("html"))), keep=["page_id", "links"])
    found = G.extract_websites(body_text(), F.col("links"))
    return parsed.select("page_id", F.array_join(F.array_sort(found), "|").alias("websites"))


LOGO_SQL = """regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '^(https?://.*/)', 1) || 'img/' || CAST(page_id AS VARCHAR) || '.png|' || regexp_extract(url, '^(https?://[^/]*)', 1) || '/my-LOGO.gif'"""


def _with_logos(spark, folder):
    image = F.concat(F.lit('<img class="TopLogo" src="img/'), F.col("page_id").cast("string"), F.lit('.png">'))
    more = F.lit('<img src="/../my-LOGO.gif"><img src="/plain.gif"><!-- <img id="logo" src="/no.gif"> -->')
    return pages(spark, folder).withColumn("html", F.concat("html", image, more, image))


@query("extract_logos", f"SELECT page_id, {LOGO_SQL} AS logos FROM pages")
def extract_logos(spark, folder):
    found = G.extract_logos(F.col("html"), F.col("url"))
    return _with_logos(spark, folder).select("page_id", F.array_join(found, "|").alias("logos"))


@query(
    "auto_fields",
    f"""WITH {BODY_SQL}, {WEBSITES_SQL} SELECT page_id, {LOGO_SQL} AS logos,
          array_to_string(list_sort({EMAIL_SQL.replace("text", "body_text")}), '|') AS emails,
          '$4' || CAST(page_id % 10 AS VARCHAR) || ',000 - $50,000' AS salaries,
          CASE WHEN contains(url, 'blog') THEN 'kept.example' ELSE array_to_string(list_sort(list_distinct(list_concat(named, hosts))), '|') END AS websites
        FROM body JOIN sites USING (page_id)""",
)
def auto_fields(spark, folder):
    pay = F.concat(F.lit("<body><p>Pay $4"), (F.col("page_id") % 10).cast("string"), F.lit(",000 - $50,000 gross</p>"))
    source = _with_logos(spark, folder).withColumn("html", F.replace("html", F.lit("<body>"), pay))
    source = source.withColumn("links", extract_links(F.col("html")))
    kept = F.when(F.contains("url", F.lit("blog")), F.array(F.lit("kept.example")))
    parsed = parse_pages(source, keep=["page_id", "url", "links", "html"])
    parsed = parsed.withColumns({"body_text": body_text(), "autoextracted_company_websites": kept})
    done = H.auto_fields(parsed)

    def joined(name):
        return F.array_join(F.array_sort(F.col(name)), "|")

    return done.select(
        "page_id",
        F.array_join("autoextracted_logo_urls", "|").alias("logos"),
        joined("autoextracted_emails").alias("emails"),
        joined("autoextracted_salaries").alias("salaries"),
        joined("autoextracted_company_websites").alias("websites"),
    )


# Validation


@query(
    "item_defaults",
    f"""WITH {ITEMS_SQL} SELECT item_no, url, coalesce(date, '2016/05/03') AS date, coalesce(language, nullif(substr(title, 1, 3), '')) AS language FROM items""",
)
def item_defaults(spark, folder):
    done = H.item_defaults(items(spark, folder), F.lit("http://unused/"), _now(), F.substring("title", 1, 3))
    return done.select("item_no", "url", "date", "language")


@query(
    "ingest_defaults",
    f"""WITH {ITEMS_SQL} SELECT item_no, coalesce(date, '2016-05-03 10:00:00') AS date, mining_job_id, 'spider' AS spidername, 1 AS iteration,
          coalesce(language, 'de') AS language FROM items""",
)
def ingest_defaults(spark, folder):
    run = {"mining_job_id": F.lit("99999"), "spidername": F.lit("spider"), "iteration": F.lit(1)}
    done = H.ingest_defaults(items(spark, folder), _now(), run, F.lit("de"))
    return done.select("item_no", "date", "mining_job_id", "spidername", "iteration", "language")


@query("location_fallback", f"WITH {ITEMS_SQL} SELECT item_no, coalesce(nullif(location, ''), zip_code) AS location FROM items")
def location_fallback(spark, folder):
    return H.location_fallback(items(spark, folder)).select("item_no", "location")


MISSING_SQL = "concat_ws(',', " + ", ".join(f"CASE WHEN coalesce({f}, '') = '' THEN '{f}' END" for f in H.REQUIRED_FIELDS) + ")"


@query("missing_fields", f"WITH {ITEMS_SQL} SELECT item_no, {MISSING_SQL} AS missing FROM items")
def missing_fields(spark, folder):
    return items(spark, folder).select("item_no", F.array_join(H.missing_fields(), ",").alias("missing"))


@query(
    "drop_long_reference",
    f"WITH {ITEMS_SQL} SELECT item_no, referencenumber FROM items WHERE coalesce(length(referencenumber), 0) <= 50",
)
def drop_long_reference(spark, folder):
    return H.drop_long_reference(items(spark, folder)).select("item_no", "referencenumber")


@query(
    "error_page_filter",
    """SELECT page_id, url, CASE WHEN contains(url, '#') THEN 'Status Code Error: 404'
            WHEN contains(html, 'casino') OR contains(html, 'erer ') THEN 'Response Body Error: ' || concat_ws(', ',
              CASE WHEN contains(html, 'casino') THEN 'casino' END, CASE WHEN contains(html, 'erer ') THEN 'erer ' END) END AS reason FROM pages""",
)
def error_page_filter(spark, folder):
    status = F.when(F.contains("url", F.lit("#")), 404).otherwise(200)
    return table(spark, folder, "pages").select(
        "page_id", "url", H.error_reason(status, F.col("html"), ["casino", "erer "]).alias("reason")
    )


@query(
    "require_reference",
    f"WITH {ITEMS_SQL} SELECT item_no, referencenumber FROM items WHERE referencenumber <> ''",
)
def require_reference(spark, folder):
    return H.require_reference(items(spark, folder)).select("item_no", "referencenumber")


@query(
    "debug_report",
    f"WITH {ITEMS_SQL} SELECT 'failed_url' AS problem, count(*) AS n FROM items WHERE status >= 400 UNION ALL "
    + " UNION ALL ".join(f"SELECT 'missing_{f}', count(*) FROM items WHERE coalesce({f}, '') = ''" for f in H.REQUIRED_FIELDS)
    + f" UNION ALL SELECT 'jobs_missing_required_field', count(*) FROM items WHERE {MISSING_SQL} <> ''",
)
def debug_report(spark, folder):
    return H.debug_report(items(spark, folder), F.col("status") >= 400)


@query(
    "debug_urls",
    f"""WITH {ITEMS_SQL} SELECT url, unnest(list_filter(string_split(CASE WHEN status >= 400 THEN 'failed_url,' ELSE '' END || {MISSING_SQL}, ','), lambda x: x <> '')) AS problem FROM items""",
)
def debug_urls(spark, folder):
    return H.debug_urls(items(spark, folder), F.col("status") >= 400)


COMPLETE_SQL = " AND ".join(f"coalesce({f}, '') <> ''" for f in H.SITE_FIELDS)


@query(
    "site_validity",
    f"""WITH {ITEMS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY mining_job_id ORDER BY scraped_at, item_no) AS rn FROM items)
        SELECT mining_job_id, count(*) AS n_checked, count(*) FILTER (WHERE {COMPLETE_SQL}) AS n_complete,
               count(*) FILTER (WHERE {COMPLETE_SQL}) >= 4 AS valid FROM r WHERE rn <= 5 GROUP BY mining_job_id""",
)
def site_validity(spark, folder):
    return H.site_validity(items(spark, folder), "mining_job_id", _in_order(), 5)


@query(
    "max_items_limit",
    f"""WITH {ITEMS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY scraped_at, item_no) AS rn FROM items)
        SELECT item_no, site_id FROM r WHERE rn <= 25""",
)
def max_items_limit(spark, folder):
    return H.max_items_limit(items(spark, folder), "site_id", _in_order(), 25).select("item_no", "site_id")


# Rollups

ROLLUP_FIELDS = ["company", "location", "jobtype", "job_function", "title"]
ROLLUP_SQL = "roll AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS field, coalesce(nullif({f}, ''), 'none') AS value, count(*) AS n FROM items GROUP BY 2" for f in ROLLUP_FIELDS
) + ")"


def _rollup(spark, folder):
    return I.field_rollup(items(spark, folder), ROLLUP_FIELDS)


@query("field_rollup", f"WITH {ITEMS_SQL}, {ROLLUP_SQL} SELECT * FROM roll")
def field_rollup(spark, folder):
    return _rollup(spark, folder)


@query("field_uniques", f"WITH {ITEMS_SQL}, {ROLLUP_SQL} SELECT field, count(*) AS n_values FROM roll GROUP BY field")
def field_uniques(spark, folder):
    return I.field_uniques(_rollup(spark, folder))


@query(
    "field_topk",
    f"""WITH {ITEMS_SQL}, {ROLLUP_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY n DESC, value) AS rn FROM roll)
        SELECT field, value, n FROM r WHERE field IN ('jobtype', 'job_function') OR (field = 'company' AND rn <= 10) OR (field IN ('location', 'title') AND rn <= 3)""",
)
def field_topk(spark, folder):
    return I.field_topk(_rollup(spark, folder), I.rollup_settings("company:10,location:3,title:3,jobtype,job_function"))


@query(
    "line_rollup",
    """SELECT field, value, count(*) AS n FROM (UNPIVOT (SELECT l_returnflag, l_linestatus, CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber FROM lineitem)
         ON l_returnflag, l_linestatus, l_suppkey, l_linenumber INTO NAME field VALUE value) GROUP BY ALL""",
)
def line_rollup(spark, folder):
    return I.field_rollup(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus", "l_suppkey", "l_linenumber"])


@query(
    "missing_field_counts",
    f"WITH {ITEMS_SQL} "
    + " UNION ALL ".join(f"SELECT '{f}' AS field, count(*) AS n FROM items WHERE coalesce({f}, '') = ''" for f in H.REQUIRED_FIELDS)
    + f" UNION ALL SELECT 'any', count(*) FROM items WHERE {MISSING_SQL} <> ''",
)
def missing_field_counts(spark, folder):
    return I.missing_field_counts(items(spark, folder), H.REQUIRED_FIELDS)


@query(
    "expected_job_count",
    f"""WITH {ITEMS_SQL}, f AS (SELECT mining_job_id, count(*) AS n_items FROM items GROUP BY 1)
        SELECT 'run' || CAST(c_custkey AS VARCHAR) AS mining_job_id,
               CASE WHEN c_acctbal < 2000 THEN -1 ELSE CAST(regexp_replace(CAST(c_custkey AS VARCHAR) || '7', '[^0-9]', '', 'g') AS BIGINT) END AS expected,
               coalesce(n_items, 0) AS n_items FROM customer LEFT JOIN f ON f.mining_job_id = 'run' || CAST(c_custkey AS VARCHAR)""",
)
def expected_job_count(spark, folder):
    claim = F.when(F.col("c_acctbal") < 2000, "no number").otherwise(
        F.concat(F.col("c_custkey").cast("string"), F.lit(" jobs on 7 pages"))
    )
    claims = table(spark, folder, "customer").select(
        F.concat(F.lit("run"), F.col("c_custkey").cast("string")).alias("mining_job_id"), claim.alias("claim")
    )
    return I.expected_job_count(items(spark, folder), claims, "mining_job_id", "claim")


@query(
    "serp_expected_count",
    r"""SELECT doc_id, coalesce(list_max(list_transform(regexp_extract_all(text, '[.,0-9]+', 0), lambda x: TRY_CAST(nullif(regexp_replace(x, '[^0-9]', '', 'g'), '') AS BIGINT))), 0) AS from_text,
              n_chars AS from_count FROM documents""",
)
def serp_expected_count(spark, folder):
    shown = F.concat(F.lit("Showing 1-1 of "), F.format_number("n_chars", 0), F.lit(" jobs"))
    return table(spark, folder, "documents").select(
        "doc_id", I.serp_expected_count(F.col("text")).alias("from_text"), I.serp_expected_count(shown).alias("from_count")
    )


HISTOGRAM_SQL = """b AS (SELECT event_type, least(greatest(CAST(floor(value * 60) AS BIGINT), 1), 5000) AS v FROM events),
    t AS (SELECT event_type, CASE WHEN v >= 4096 THEN v - v % 32 + 31 WHEN v >= 2048 THEN v - v % 16 + 15 WHEN v >= 1024 THEN v - v % 8 + 7
        WHEN v >= 512 THEN v - v % 4 + 3 WHEN v >= 256 THEN v - v % 2 + 1 ELSE v END AS ms FROM b)"""


@query(
    "parse_time_histogram",
    f"""WITH {HISTOGRAM_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ms) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM t)
        SELECT event_type, CAST(sum(ms) AS BIGINT) AS total_ms, count(*) AS n_times, CAST(floor(sum(ms) / count(*)) AS BIGINT) AS average_ms,
               max(ms) FILTER (WHERE rn = floor(n * 50 / 100 + 0.5)) AS p50_ms, max(ms) FILTER (WHERE rn = floor(n * 90 / 100 + 0.5)) AS p90_ms
        FROM o GROUP BY event_type""",
)
def parse_time_histogram(spark, folder):
    return I.parse_time_histogram(table(spark, folder, "events"), F.floor(F.col("value") * 60), ["event_type"])


@query(
    "drop_counts",
    f"""WITH {ITEMS_SQL}, r AS (SELECT CASE WHEN status >= 400 THEN 'error_page' WHEN coalesce(referencenumber, '') = '' THEN 'missing_reference'
          WHEN length(referencenumber) > 50 THEN 'long_reference' END AS reason FROM items) SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason""",
)
def drop_counts(spark, folder):
    reason = H.reject_reason(error=H.error_reason(F.col("status"), F.col("title")))
    rejected = items(spark, folder).withColumn("reason", reason).filter("reason IS NOT NULL")
    return I.drop_counts(rejected, "reason")


@query(
    "request_latency",
    """WITH p AS (SELECT event_id // 2 AS request, min(ts) FILTER (WHERE event_id % 2 = 0) AS a, max(ts) FILTER (WHERE event_id % 2 = 1) AS b FROM events GROUP BY 1)
       SELECT request, epoch_us(b) - epoch_us(a) AS micros FROM p WHERE a IS NOT NULL AND b IS NOT NULL""",
)
def request_latency(spark, folder):
    events = table(spark, folder, "events").withColumn("request", F.floor(F.col("event_id") / 2))
    return I.request_latency(events, "request", F.col("event_id") % 2 == 0, "ts").select("request", "micros")


RUN_COLUMNS = """o_custkey AS spider, o_orderkey AS run_id,
    CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'running' ELSE 'pending' END AS state,
    CAST(CASE WHEN o_totalprice > 250000 THEN 2 ELSE 0 END AS BIGINT) AS errors_count, o_orderdate AS updated"""
LATEST_SQL = f"""runs AS (SELECT {RUN_COLUMNS} FROM orders),
    latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY spider ORDER BY updated DESC, run_id DESC) AS rn FROM runs) WHERE rn = 1)"""


def _latest(spark, folder):
    runs = table(spark, folder, "orders").selectExpr(*split_columns(RUN_COLUMNS))
    return I.latest_run(runs, "spider", "updated", "run_id")


@query("latest_run", f"WITH {LATEST_SQL} SELECT spider, run_id, state, errors_count, CAST(epoch(updated) AS BIGINT) AS updated_s FROM latest")
def latest_run(spark, folder):
    seconds = F.unix_seconds(F.col("updated").cast("timestamp")).alias("updated_s")
    return _latest(spark, folder).select("spider", "run_id", "state", "errors_count", seconds)


@query(
    "recent_failures",
    f"""WITH {LATEST_SQL} SELECT spider, run_id FROM latest WHERE state = 'finished' AND errors_count > 0
        AND updated <= TIMESTAMP '2001-07-20 00:00:00' AND updated > TIMESTAMP '2001-07-20 00:00:00' - INTERVAL 4800 HOUR""",
)
def recent_failures(spark, folder):
    now = F.lit("2001-07-20 00:00:00").cast("timestamp_ntz")
    return I.recent_failures(_latest(spark, folder), "updated", now, hours=4800).select("spider", "run_id")


@query("startable", f"WITH {LATEST_SQL} SELECT spider, run_id, state FROM latest WHERE state <> 'running'")
def startable(spark, folder):
    return I.startable(_latest(spark, folder)).select("spider", "run_id", "state")
