"""Elements, flat tag scans and rules over whole pages."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleaner.functions import markup
from gleaner.functions.text import WHITESPACE
from gleaner.functions.urls import url_host, url_join
from gleaner.operators import elements as E
from gleaner.operators import rules as R
from gleaner.operators import selectors as S
from gleaner.operators.callbacks import page_callback as page_callback_of
from gleaner.operators.callbacks import python_processor as python_processor_of
from gleaner.operators.crawl import Site, crawl_items
from gleaner.operators.rollups import top_per_group
from gleaner.operators.selectors import Page, Sel
from gleaner.plans.inputs import BODY_SQL, ITEMS_SQL, items, pages
from gleaner.plans.registry import query
from gleaner.plans.tree_sql import TREE_SQL
from gleaner.session import spread
from gleaner.sources.files import route_items
from gleaner.sources.tables import table

LINKS_SQL = """links AS (SELECT page_id, url, generate_subscripts(hrefs, 1) - 1 AS pos, unnest(hrefs) AS href, unnest(labels) AS label FROM
  (SELECT page_id, url, list_transform(regexp_extract_all(html, '<a href="([^"]*)">', 1), lambda h: replace(h, '&amp;', '&')) AS hrefs,
          list_transform(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1), lambda h: replace(h, '&amp;', '&')) AS labels FROM pages))"""
TITLE_SQL = """replace(replace(replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '&quot;', '"'), '&amp;', '&'), '&amp', '&')"""


@query(
    "host_links",
    r"""WITH l AS (SELECT regexp_extract(html, '<html lang="([a-z]+)"', 1) AS language,
             regexp_replace(regexp_extract(url, '^https?://([^/]*)', 1), '^www\.', '') AS host,
             len(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS links FROM pages),
       g AS (SELECT language, host, CAST(sum(links) AS BIGINT) AS links, count(*) AS n_pages FROM l GROUP BY ALL),
       r AS (SELECT *, CAST(row_number() OVER (PARTITION BY language ORDER BY links DESC, host) AS INTEGER) AS rank FROM g)
       SELECT language, host, links, n_pages, rank FROM r WHERE rank <= 10""",
)
def host_links(spark, folder):
    scanned = pages(spark, folder).select(
        markup.page_language(F.col("html")).alias("language"),
        url_host(F.col("url")).alias("host"),
        F.size(markup.extract_links(F.col("html"))).alias("n"),
    )
    counted = scanned.groupBy("language", "host").agg(F.sum("n").alias("links"), F.count("*").alias("n_pages"))
    return top_per_group(counted, ["language"], [F.desc("links"), F.asc("host")], 10)


@query(
    "explode_elements",
    """WITH t AS (SELECT page_id, unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)[^>]*>([^<]*)', 1)) AS tag, unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)[^>]*>([^<]*)', 2)) AS after,
           generate_subscripts(regexp_extract_all(html, '<([a-z][a-z0-9]*)[^>]*>([^<]*)', 1), 1) AS i FROM pages)
       SELECT page_id, CAST(i - 1 AS INTEGER) AS node_id, tag, CASE WHEN tag IN ('a', 'title', 'style', 'h1', 'div')
              THEN replace(replace(replace(after, '&quot;', '"'), '&amp;', '&'), '&amp', '&') END AS label FROM t""",
)
def explode_elements(spark, folder):
    rows = E.explode_elements(pages(spark, folder))
    return rows.select(
        "page_id", "node_id", "tag", F.when(F.col("tag").isin("a", "title", "style", "h1", "div"), F.col("text")).alias("label")
    )


@query(
    "element_tree",
    f"""WITH {TREE_SQL} SELECT page_id, node_id, parent_id, last_id, depth, ord, tag_ord, tag, text, html_len, path,
           replace(regexp_extract(t, ' (lang|charset|href|class)="([^"]*)"', 2), '&amp;', '&') AS attr FROM tree""",
)
def element_tree(spark, folder):
    rows = E.explode_elements(pages(spark, folder))
    attr = F.coalesce(*[F.col("attrs")[name] for name in ("lang", "charset", "href", "class")], F.lit(""))
    columns = ("page_id", "node_id", "parent_id", "last_id", "depth", "ord", "tag_ord", "tag", "text", "html_len", "path")
    return rows.select(*columns, attr.alias("attr"))


@query("page_body_text", f"WITH {BODY_SQL} SELECT page_id, body_text FROM body")
def page_body_text(spark, folder):
    return E.parse_pages(pages(spark, folder), keep=["page_id"]).select("page_id", E.body_text().alias("body_text"))


@query(
    "select_nodes",
    f"""WITH {LINKS_SQL}, n AS (SELECT page_id, string_agg(label, '|' ORDER BY pos) AS nav_links FROM links GROUP BY page_id)
        SELECT page_id, url, nav_links, {TITLE_SQL} AS title, regexp_extract(html, '<meta charset="([^"]*)"', 1) AS charset,
               regexp_extract(html, '<div class="ad">([^<]*)</div>', 1) AS ad
        FROM pages JOIN n USING (page_id)""",
)
def select_nodes(spark, folder):
    page = Page()
    return E.parse_pages(pages(spark, folder)).select(
        "page_id",
        "url",
        F.array_join(S.take(page, S.select_nodes(page, Sel("nav"), Sel("a", present=["href"])), "text()"), "|").alias("nav_links"),
        F.array_join(S.take(page, S.select_nodes(page, Sel("h1")), "string()"), "|").alias("title"),
        F.get(S.take(page, S.select_nodes(page, Sel("meta", present=["charset"])), "@charset"), F.lit(0)).alias("charset"),
        F.array_join(S.take(page, S.select_nodes(page, *S.css("body div.ad")), "text()"), "|").alias("ad"),
    )


@query(
    "label_value_pairs",
    "SELECT page_id, regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1) AS after_nav, ' ' || url AS second_cell FROM pages",
)
def label_value_pairs(spark, folder):
    cells = F.concat(F.lit("<table><tr><td>Page<td>:</td><td> "), "url", F.lit("<tr><td>x</table></body>"))
    page = Page()
    source = pages(spark, folder).select(
        "page_id", F.concat(F.regexp_replace("html", "</body>.*$", ""), F.lit("</p></article>"), cells).alias("html")
    )
    return E.parse_pages(source, keep=["page_id"]).select(
        "page_id",
        F.array_join(S.label_values(page, Sel("nav"), "div"), "|").alias("after_nav"),
        F.array_join(S.label_values(page, Sel("td", text_has="Page"), "td", nth=2), "|").alias("second_cell"),
    )


@query(
    "following_rows_text",
    f"""WITH {LINKS_SQL}, d AS (SELECT page_id, string_agg(label, '' ORDER BY pos) AS details FROM links WHERE pos > 0 GROUP BY page_id)
        SELECT page_id, coalesce(details, '') AS details FROM pages LEFT JOIN d USING (page_id)""",
)
def following_rows_text(spark, folder):
    # The rows of these pages are the items of their menu; those behind the first one follow a marker.
    return E.parse_pages(pages(spark, folder), keep=["page_id"]).select(
        "page_id", S.following_rows_text(Page(), "li", Sel("a", present=["href"])).alias("details")
    )


@query(
    "hidden_inputs",
    "SELECT page_id, CAST(page_id AS VARCHAR) AS page, url AS back, CAST(2 AS INTEGER) AS n FROM pages",
)
def hidden_inputs(spark, folder):
    def hidden(name, value):
        return F.concat(F.lit(f"<input type='hidden' name={name} value=\""), value, F.lit('"/>'))

    url = F.replace("url", F.lit("&"), F.lit("&amp;"))
    html = F.concat("html", hidden("page", F.lit("old")), hidden("back", url), F.lit('<input type="text" name="q" value="x">'))
    html = F.concat(html, hidden("page", F.col("page_id").cast("string")), F.lit("<!--"), hidden("no", F.lit("1")), F.lit("-->"))
    found = pages(spark, folder).select("page_id", markup.hidden_inputs(html).alias("m"))
    return found.select("page_id", F.col("m.page").alias("page"), F.col("m.back").alias("back"), F.size("m").alias("n"))


@query("page_language", """SELECT page_id, regexp_extract(html, '<html lang="([^"-]*)', 1) AS language FROM pages""")
def page_language(spark, folder):
    return pages(spark, folder).select("page_id", markup.page_language(F.col("html")).alias("language"))


@query("extract_links", f"WITH {LINKS_SQL} SELECT page_id, CAST(pos AS INTEGER) AS pos, href FROM links")
def extract_links(spark, folder):
    return pages(spark, folder).select("page_id", F.posexplode(markup.extract_links(F.col("html"))).alias("pos", "href"))


@query(
    "remove_bad_elements",
    r"""WITH t AS (SELECT page_id, regexp_replace(html, '(?s)<script.*?</script>|<nav>.*?</nav>|<!--.*?-->|<[^>]*>', '', 'g') AS t FROM pages)
        SELECT page_id, replace(replace(replace(replace(replace(t, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&'), '&amp', '&') AS cleaned FROM t""",
)
def remove_bad_elements(spark, folder):
    left = F.array_join(E.remove_bad_elements(F.array("html"), ["nav"]), "|")
    text = F.regexp_replace(left, "(?s)<!--.*?-->|<[^>]*>", "")
    for name, letter in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(letter))
    return pages(spark, folder).select("page_id", text.alias("cleaned"))


@query(
    "rule_cascade",
    f"""SELECT page_id, url, nullif(trim(regexp_replace({TITLE_SQL}, '\\s+', ' ', 'g')), '') AS title, 'the board' AS company,
               url AS apply_url, 'none' AS duration FROM pages""",
)
def rule_cascade(spark, folder):
    rules = {
        "title": R.Rule(xpath=[R.Source([R.Pick(Sel("h2")), R.Pick(Sel("h1"), what="string()")])], value=[R.Source(["untitled"])]),
        "company": R.Rule(xpath=[R.Source([R.Pick(Sel("dt"))])], value=[R.Source(["the board"])], static="unused"),
        "apply_url": R.Rule(xpath=[R.Source([R.Pick(Sel("h5"))])], responseurl=[R.Source()]),
        "duration": R.Rule(xpath=[R.Source([R.Pick(Sel("h6"))])], static="none"),
    }
    return R.rule_cascade(E.parse_pages(pages(spark, folder)), rules)


@query(
    "rule_alternatives",
    f"WITH {LINKS_SQL} SELECT page_id, string_agg(label, '|' ORDER BY pos) AS hits FROM links GROUP BY page_id",
)
def rule_alternatives(spark, folder):
    page = Page()
    picks = [R.Pick(Sel("dd")), R.Pick(Sel("nav"), Sel("a")), R.Pick(Sel("p"))]
    parsed = E.parse_pages(pages(spark, folder), keep=["page_id"])
    return parsed.select("page_id", F.array_join(R.rule_alternatives([p(page) for p in picks]), "|").alias("hits"))


@query(
    "rule_function",
    f"""WITH {LINKS_SQL}, h AS (SELECT page_id, string_agg(href, '|' ORDER BY pos) AS hits FROM links WHERE href <> '' GROUP BY page_id)
        SELECT page_id, coalesce(hits, 'none') AS hits FROM pages LEFT JOIN h USING (page_id)""",
)
def rule_function(spark, folder):
    def links(page, within):
        return S.take(page, S.select_nodes(page, Sel("a", present=["href"]), within=within), "@href")

    rule = R.Rule(xpath=[R.Source([R.Pick(Sel("h6"))])], function=links, static="none")
    parsed = E.parse_pages(pages(spark, folder))
    return parsed.select("page_id", F.array_join(R.extract_rule(rule, Page(), F.col("url")), "|").alias("hits"))


@query(
    "css_nodes",
    f"""WITH {LINKS_SQL}, l AS (SELECT page_id, string_agg(label, '|') FILTER (WHERE pos = 1) AS second,
          string_agg(label, '|' ORDER BY pos) FILTER (WHERE pos > 0) AS later, count(*) FILTER (WHERE starts_with(href, '/t')) AS n FROM links GROUP BY page_id)
        SELECT page_id, coalesce(second, '') AS second, coalesce(later, '') AS later, CAST(coalesce(n, 0) + 1 AS INTEGER) AS n_hits FROM pages LEFT JOIN l USING (page_id)""",
)
def css_nodes(spark, folder):
    page = Page()

    def texts(selector):
        return F.array_join(S.take(page, S.css_nodes(page, selector), "string()"), "|")

    return E.parse_pages(pages(spark, folder), keep=["page_id"]).select(
        "page_id",
        texts("nav > ul > li:nth-child(2) > a").alias("second"),
        texts("nav li:first-child ~ li").alias("later"),
        F.size(S.css_nodes(page, 'nav a[href^="/t"], article > h1')).alias("n_hits"),
    )


@query(
    "rule_processors",
    f"""WITH {LINKS_SQL}, w AS (SELECT page_id, pos, unnest(regexp_extract_all(href, '([a-z])([a-z]+)', 1)) AS a, unnest(regexp_extract_all(href, '([a-z])([a-z]+)', 2)) AS b,
             generate_subscripts(regexp_extract_all(href, '([a-z])([a-z]+)', 1), 1) AS i FROM links),
        j AS (SELECT page_id, string_agg(upper(a) || '|' || upper(b), '|' ORDER BY pos, i) AS words FROM w GROUP BY page_id)
        SELECT page_id, words FROM pages LEFT JOIN j USING (page_id)""",
)
def rule_processors(spark, folder):
    source = R.Source([R.Pick(Sel("a"), what="@href")], [lambda xs: F.transform(xs, lambda x: F.upper(x))], "([a-z])([a-z]+)")
    parsed = E.parse_pages(pages(spark, folder))
    hits = R.extract_rule(R.Rule(xpath=[source]), Page(), F.col("url"))
    return parsed.select("page_id", F.array_join(hits, "|").alias("words"))


def _index_rows(spark, folder):
    sets = [
        R.RuleSet(base=R.Pick(Sel("tr")), joburl=R.Rule(xpath=[R.Source([R.Pick(Sel("a"), what="@href")])])),
        R.RuleSet(
            base=R.Pick(Sel("nav"), Sel("li")),
            joburl=R.Rule(xpath=[R.Source([R.Pick(Sel("a"), what="@href")])]),
            relative={"title": R.Rule(xpath=[R.Source([R.Pick(Sel("a"))])])},
            nonrelative={"location": R.Rule(xpath=[R.Source([R.Pick(Sel("div", classes=["ad"]))])])},
            formdata={"lang": R.Rule(static="xx")},
            dont_filter=True,
        ),
    ]
    return R.job_index_rows(E.parse_pages(pages(spark, folder)), sets)


@query("job_index_rows", f"WITH {LINKS_SQL} SELECT page_id, CAST(1 AS INTEGER) AS rule_ix, CAST(pos AS INTEGER) AS pos, href AS joburl FROM links")
def job_index_rows(spark, folder):
    return _index_rows(spark, folder).select("page_id", "rule_ix", "pos", "joburl")


@query("relative_fields", f"WITH {LINKS_SQL} SELECT page_id, CAST(pos AS INTEGER) AS pos, label AS title FROM links")
def relative_fields(spark, folder):
    return _index_rows(spark, folder).select("page_id", "pos", F.array_join("custom_items.title", "|").alias("title"))


@query(
    "positional_zip",
    """WITH z AS (SELECT page_id, list_transform(regexp_extract_all(html, '<a href="([^"]*)">', 1), lambda h: replace(h, '&amp;', '&')) AS a, string_split(url, '/') AS b,
              regexp_extract_all(regexp_extract(html, '<div class="ad">([^<]*)</div>', 1), '[A-Z]', 0) AS c FROM pages),
       n AS (SELECT *, greatest(len(a), len(b), len(c)) AS n FROM z)
       SELECT page_id, CAST(i AS INTEGER) AS pos, a[i + 1] AS base, b[i + 1] AS segment, c[i + 1] AS letter
       FROM (SELECT *, unnest(range(n)) AS i FROM n)""",
)
def positional_zip(spark, folder):
    ad = F.regexp_extract("html", '<div class="ad">([^<]*)</div>', 1)
    zipped = R.positional_zip(
        markup.extract_links(F.col("html")),
        segment=F.split("url", "/"),
        letter=F.regexp_extract_all(ad, F.lit("[A-Z]"), F.lit(0)),
    )
    rows = pages(spark, folder).select("page_id", F.posexplode(zipped).alias("pos", "z"))
    return rows.select("page_id", "pos", "z.base", "z.segment", "z.letter")


@query(
    "merge_index_detail",
    f"""WITH {ITEMS_SQL}, x AS (SELECT l_orderkey, min(l_linenumber) AS line FROM lineitem GROUP BY l_orderkey),
        i AS (SELECT l_orderkey AS item_no, 'line ' || CAST(line AS VARCHAR) AS title, 'stop ' || CAST(line AS VARCHAR) AS location FROM x)
        SELECT d.item_no, d.url, coalesce(nullif(d.title, ''), i.title) AS title, coalesce(nullif(d.location, ''), i.location) AS location,
               coalesce(d.date, '2016/06/01') AS date, coalesce(d.language, 'xx') AS language
        FROM items d LEFT JOIN i USING (item_no)""",
)
def merge_index_detail(spark, folder):
    detail = items(spark, folder).select("item_no", "url", "title", "location", "date", "language")
    line = F.col("l_linenumber").cast("string")
    index = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("item_no"),
        "l_linenumber",
        F.concat(F.lit("line "), line).alias("title"),
        F.concat(F.lit("stop "), line).alias("location"),
    )
    return R.merge_index_detail(
        detail, index, "l_linenumber", ["title", "location"], "item_no", date=F.lit("2016/06/01"), language=F.lit("xx")
    )


_BLANK = r"'\\s+', ' ', 'g'"


@query(
    "whole_crawl",
    rf"""WITH {LINKS_SQL}, {BODY_SQL}, clean AS (SELECT page_id, html, regexp_extract(url, '^(https?://[^/]*)', 1) AS site,
           nullif(trim(regexp_replace({TITLE_SQL}, {_BLANK})), '') AS title, nullif(trim(regexp_replace(regexp_extract(html, '<div class="ad">([^<]*)</div>', 1), {_BLANK})), '') AS ad FROM pages),
        requests AS (SELECT site || href AS url, l.page_id, pos, nullif(trim(regexp_replace(label, {_BLANK})), '') AS company, CASE WHEN pos = 0 THEN ad END AS location
           FROM links l JOIN clean USING (page_id)),
        first AS (SELECT url, min_by(company, page_id * 1000 + pos) AS company, arg_min_null(location, page_id * 1000 + pos) AS location FROM requests GROUP BY url),
        answers AS (SELECT site || href AS url, min(c.page_id) AS page_id FROM links l JOIN clean c USING (page_id) WHERE pos = 1 GROUP BY 1),
        items AS (SELECT f.url, c.title, f.company, f.location, nullif(regexp_extract(f.url, '([a-z]+)$', 1), '') AS referencenumber, page_id % 7 = 0 AS gone, contains(b.body_text, 'eß') AS broken
           FROM answers a JOIN clean c USING (page_id) JOIN body b USING (page_id) JOIN first f ON f.url = a.url),
        judged AS (SELECT *, CASE WHEN gone OR broken THEN 'error_page' WHEN referencenumber IS NULL THEN 'missing_reference' END AS reject FROM items)
        SELECT url, title, coalesce(company, 'the board') AS company, location, referencenumber, '2016/06/01' AS date, 'xx' AS language, reject,
               CASE WHEN reject IS NULL THEN CASE WHEN contains(url, 'blog') THEN 'aggregator' WHEN contains(url, '//www.') THEN 'autocrawl' ELSE 'job' END END AS route FROM judged""",
)
def whole_crawl(spark, folder):
    """Every page is a list page; the page behind its second link is answered by that page itself."""
    source = pages(spark, folder)
    second = F.get(markup.extract_links(F.col("html")), F.lit(1))
    behind = source.select(
        "page_id", url_join(F.col("url"), second).alias("url"), "html", F.when(F.col("page_id") % 7 == 0, 404).otherwise(200).alias("status")
    )
    site = Site(
        rule_sets=[
            R.RuleSet(
                base=R.Pick(Sel("nav"), Sel("li")),
                joburl=R.Rule(xpath=[R.Source([R.Pick(Sel("a"), what="@href")])]),
                relative={"company": R.Rule(xpath=[R.Source([R.Pick(Sel("a"))])])},
                nonrelative={"location": R.Rule(xpath=[R.Source([R.Pick(Sel("div", classes=["ad"]))])])},
            )
        ],
        rules={
            "title": R.Rule(xpath=[R.Source([R.Pick(Sel("h1"), what="string()")])]),
            "company": R.Rule(xpath=[R.Source([R.Pick(Sel("h5"))])]),
            "referencenumber": R.Rule(responseurl=[R.Source(pattern="([a-z]+)$")]),
        },
        index_fields=["company", "location"],
        messages=["eß"],
        defaults={"company": F.lit("the board")},
    )
    route = route_items(F.lit(False), F.contains("url", F.lit("blog")), F.contains("url", F.lit("//www.")), F.lit(True))
    now = F.lit("2016-06-01").cast("timestamp")
    found = crawl_items(source.select("page_id", "url", "html"), behind.filter("url IS NOT NULL"), site, now, route, F.lit("xx"))
    return found.select("url", "title", "company", "location", "referencenumber", "date", "language", "reject", "route")


@query(
    "plan_pages",
    """SELECT o_orderkey, CAST(p AS INTEGER) AS page FROM (SELECT o_orderkey, unnest(range(2, CAST(ceil(floor(o_totalprice / 10000) / 20.0) AS BIGINT) + 1)) AS p FROM orders)""",
)
def plan_pages(spark, folder):
    items_found = F.floor(F.col("o_totalprice") / 10000)
    return table(spark, folder, "orders").select(
        "o_orderkey", F.explode(R.plan_pages(total_items=items_found, per_page=F.lit(20))).alias("page")
    )


@query(
    "follow_next",
    """WITH RECURSIVE t AS (SELECT conv_id, turn, CASE WHEN turn = max(turn) OVER (PARTITION BY conv_id) THEN 0 ELSE turn + 1 END AS next FROM conversations),
       walk AS (SELECT conv_id, turn, next, 0 AS depth FROM t WHERE turn = 0
                UNION ALL SELECT t.conv_id, t.turn, t.next, depth + 1 FROM walk w JOIN t ON t.conv_id = w.conv_id AND t.turn = w.next WHERE w.next <> 0)
       SELECT CAST(conv_id AS VARCHAR) || '/0' AS seed, CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS url, CAST(min(depth) AS INTEGER) AS depth
       FROM walk GROUP BY ALL""",
)
def follow_next(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn")
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("last"))

    def url(turn):
        return F.concat_ws("/", F.col("conv_id").cast("string"), turn.cast("string"))

    after = F.when(F.col("turn") == F.col("last"), F.lit(0)).otherwise(F.col("turn") + 1)
    links = turns.join(last, "conv_id").select(url(F.col("turn")).alias("src"), url(after).alias("dst"))
    seeds = turns.filter("turn = 0").select(url(F.col("turn")).alias("seed"))
    return R.follow_next(seeds, links)


@query(
    "job_requests",
    f"""WITH {LINKS_SQL} SELECT regexp_extract(url, '^(https?://[^/]*)', 1) || href AS url, label AS title, true AS dont_filter, 'xx' AS form_lang FROM links""",
)
def job_requests(spark, folder):
    requests = R.job_requests(_index_rows(spark, folder))
    return requests.select(
        "url", F.get("custom_items.title", F.lit(0)).alias("title"), "dont_filter", F.col("formdata.lang").alias("form_lang")
    )


@query(
    "two_hop_follow",
    "SELECT a.page_id AS from_page, b.page_id AS page_id, b.url FROM pages a JOIN pages b ON b.page_id = a.page_id + 1",
)
def two_hop_follow(spark, folder):
    responses = table(spark, folder, "pages").select("page_id", "url")
    hrefs = F.concat("url", F.lit("?session="), F.col("page_id").cast("string"))
    links = responses.select((F.col("page_id") - 1).alias("from_page"), hrefs.alias("href")).filter("from_page >= 0")
    return R.two_hop_follow(links, responses, "page_id").select("from_page", "page_id", "url")


@query(
    "load_item",
    r"""SELECT doc_id, nullif(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '[\s\x{a0}]+', ' ', 'g'))), lambda x: x <> '')[1], '') AS title,
              nullif(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> ''), ' '), '') AS description FROM documents""",
)
def load_item(spark, folder):
    lines = F.split("text", "\n")
    return table(spark, folder, "documents").select("doc_id", *R.load_item({"title": lines, "description": lines}))


@query(
    "scan_keyword_type",
    f"""WITH {ITEMS_SQL} SELECT item_no, CASE WHEN contains(upper(replace(jobtype, '-', ' ')), 'FULL TIME') THEN 'FULL TIME'
            WHEN contains(upper(jobtype), 'PART TIME') THEN 'PART TIME' END AS jobtype FROM items""",
)
def scan_keyword_type(spark, folder):
    text = F.replace("jobtype", F.lit("-"), F.lit(" "))
    return items(spark, folder).select("item_no", R.scan_keyword_type(text).alias("jobtype"))


@query("python_processor", f"WITH {LINKS_SQL} SELECT page_id, string_agg(reverse(href), '|' ORDER BY pos DESC) AS hits FROM links GROUP BY page_id")
def python_processor(spark, folder):
    flip = python_processor_of(lambda values: [v[::-1] for v in reversed(values)])
    return pages(spark, folder).select("page_id", F.array_join(flip(markup.extract_links(F.col("html"))), "|").alias("hits"))


def _lines_of(page):
    for place, line in enumerate(page["text"].split("\n")):
        if line.strip():
            yield {"doc_id": page["doc_id"], "place": place, "line": line}


@query(
    "page_callback",
    f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS place FROM documents)
        SELECT doc_id, place, line FROM l WHERE trim(line, '{WHITESPACE}') <> ''""",
)
def page_callback(spark, folder):
    schema = StructType().add("doc_id", "long").add("place", "long").add("line", "string")
    return page_callback_of(spread(table(spark, folder, "documents")), _lines_of, ["doc_id", "text"], schema)
