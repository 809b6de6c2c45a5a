import random
import re
import time
from datetime import datetime
from urllib.parse import urljoin

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.functions import codes as C
from gleaner.functions import entities as G
from gleaner.functions import markup as M
from gleaner.functions import text as T
from gleaner.functions import urls as U

few = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def array(values):
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def test_lists(one):
    assert one(T.coalesce_list(array(["", "a", "b"])), T.coalesce_list(array(["", "a", "b"]), last=True)) == ["a", "b"]
    assert one(T.coalesce_list(array([""]))) is None
    assert one(T.normalized_join(array([" a ", "", " ", "b"]))) == "a b"
    assert one(T.strip_nonempty(array(["\xa0x\n", " ", "y"]))) == ["x", "y"]
    assert one(T.extract_first(array([]), "d"), T.extract_first(array(["id=7"]), "d", r"=(\d)")) == ["d", "7"]
    assert one(T.normalized_join_without_tags(array(["<script>x</script>a", " ", "b<meta/>"]))) == "a\nb"


def test_dates(one):
    assert one(T.convert_date(array(["03/Feb/2016", "bad"]), "%d/%b/%Y")) == ["02/03/2016"]
    assert one(T.parse_date(F.lit(" 3.2.2016 "), "%d.%m.%Y")) == datetime(2016, 2, 3)
    with pytest.raises(Exception, match="not a date"):
        one(T.parse_date(F.lit("never"), "%d.%m.%Y"))
    with pytest.raises(ValueError):
        T.date_pattern("%q", True)


def test_html(one):
    assert one(T.remove_empty_tags(F.lit("<div><p><b> </b>&nbsp;</p></div>x<h1></h1>"))) == "x<h1></h1>"
    html = '<h2 class="a">T</h2><!-- c --><table><tr><td>x</td></tr></table>'
    assert one(T.html_format(F.lit(html))) == "<strong>T</strong>  <br/> x   "
    assert one(T.nl2br(F.lit("a\r\nb"))) == "a<br>b"


def test_empty_tags_go_at_any_depth(one):
    deep = "<i>" * 60 + "&nbsp; \n" * 3000 + "</i>" * 60
    assert one(T.remove_empty_tags(F.lit(deep + "end"))) == "end"


def test_empty_tags_take_time_in_proportion(spark):
    texts = {
        "nested": "<div>" * 10_000 + "</div>" * 10_000,
        "flat": "<b></b>" * 100_000,
        "full": "<b>x</b>" * 100_000,
        "void": "<br>" * 100_000 + "</p>",
        "open": "<p>x" * 100_000 + "</p>",
    }
    rows = spark.createDataFrame(list(texts.items()), "name string, html string").repartition(5)
    start = time.time()
    left = {r.name: r.left for r in rows.select("name", T.remove_empty_tags(F.col("html")).alias("left")).collect()}
    # A pass over the text per pair took minutes.
    assert time.time() - start < 40
    assert left == {k: "" if k in ("nested", "flat") else v for k, v in texts.items()}


@few
@given(st.lists(st.sampled_from(["<b>", "</b>", "<bx a='1'>", "</bx>", "<br>", " ", "&nbsp;", "x", "\n", "</B>", "</b >", ">", "\xa0", "\x01", "<i <b>"]), max_size=40))
def test_tags_are_reduced_as_the_pattern_would(one, parts):
    pattern = re.compile("<([a-zA-Z]*)[^>]*?>(?:[ \\t\\n\\x0b\\f\\r\xa0\xc2]|&nbsp;)*</\\1>")
    expected, before = "".join(parts), None
    while before != expected:
        before, expected = expected, pattern.sub("", expected)
    assert one(T.remove_empty_tags(F.lit("".join(parts)))) == expected


@few
@given(st.text(alphabet="<>/bip &;nsx", max_size=60))
def test_remove_empty_tags_is_a_fixpoint(one, html):
    pattern = re.compile("<([a-zA-Z]*)[^>]*?>(?:[ \\t\\n\\x0b\\f\\r\xa0\xc2]|&nbsp;)*</\\1>")
    expected, before = html, None
    while before != expected:
        before, expected = expected, pattern.sub("", expected)
    assert one(T.remove_empty_tags(F.lit(html))) == expected


def test_all_entities(one):
    names = T.ENTITY_NAMES
    assert len(names) == 88
    assert one(T.html_escape_codes(F.lit("a".join(names) + "&#9999;&"))) == "a".join(names.values()) + "&#9999;&"
    assert names["&#8211;"] == "&ndash;" and names["&#255;"] == "&yuml;   " and names["&#180;"] == "'"
    assert names["&#198;"] == "&AElig;" and names["&#181;"] == "&micro;"


def test_numbers(one):
    assert one(T.digits_of(F.lit("1,234 jobs (5 new)")), T.digits_of(F.lit("none"))) == [12345, -1]
    assert one(T.digits_of(F.lit("9" * 30)), T.digits_of(F.lit("0" * 30 + "7"))) == [2**63 - 1, 7]
    assert one(T.language_prefix(F.lit("en-US"))) == "en"


def test_urls(one):
    assert one(U.shrink_url(F.lit("http://a.com/j?id=7&utm=x&ref="), ["utm"])) == "http://a.com/j?id=7"
    assert one(U.shrink_url(F.lit("http://a.com/j?b=1;a=2&b=3%26%20"))) == "http://a.com/j?a=2&b=3"
    assert one(U.shrink_url(F.lit("http://a.com/100%?x=%zz"))) == "http://a.com/100%?x=%25zz"
    assert one(U.add_get_params(F.lit("http://a.com/j?a=1&b=2#f"), {"b": "x y"})) == "http://a.com/j?a=1&b=x+y#f"
    assert one(U.normalize_feed_url(F.lit("http://www.a.com/"))) == "https://a.com/"
    assert one(U.hostname(F.lit("HTTP://u:p@WWW.A.com:80/x")), U.url_host(F.lit("//www.b.org"))) == ["www.a.com", "b.org"]
    assert one(U.hostname(F.lit("mailto:x"))) is None
    assert one(U.is_absolute(F.lit("/x")), U.is_absolute(F.lit("//h/x"))) == [False, True]


BASE = "http://a/b/c/d;p?q"
REFERENCES = (
    "g:h g ./g g/ /g //g ?y g?y #s g#s g?y#s ;x g;x . ./ .. ../ ../g ../.. ../../ ../../g ../../../g ../../../../g /./g"
    " /../g g. .g g.. ..g ./../g ./g/. g/./h g/../h g;x=1/./y g;x=1/../y g?y/./x g#s/../x http://x/y/../z"
).split()


def test_url_join_follows_the_rfc(spark):
    rows = spark.createDataFrame([(r,) for r in [*REFERENCES, ""]], "r string")
    for r, got in rows.select("r", U.url_join(F.lit(BASE), F.col("r"))).collect():
        expected = r if r == "http://x/y/../z" else urljoin(BASE, r)
        assert got == expected, r


@few
@given(st.lists(st.sampled_from(["a", ".", "..", "b.c"]), max_size=6), st.sampled_from(["http://h", "http://h/x/y", "http://h/x/"]))
def test_url_join_paths(one, segments, base):
    url = "/".join(segments)
    if not url.startswith("//"):
        assert one(U.url_join(F.lit(base), F.lit(url))) == urljoin(base, url)


def test_codes(one):
    assert one(C.map_job_types(array(["Full-Time", "Casual", " f ", ""]))) == ["FULL_TIME", "CASUAL", "FULL_TIME"]
    assert one(C.map_experience_level(array(["3"]))) == ["ASSOCIATE"]
    assert one(C.map_functions(array(["Engineering", "Sales", "Foo", "Legal"]))) == '["ENG","SALE","FOO"]'
    assert one(C.map_functions(array(["Accounting/Auditing", "none", "Business Development"]))) == '["ACCT","BD"]'
    assert one(C.map_industries(array(["Retail,Banking"]))) == '[47,"Banking"]'
    codes = C.industry_codes(array(["Q,Retail , shops"]), {"retail": 47, "q": "QQ"})
    assert one(F.transform(codes, F.schema_of_variant)) == ["STRING", "BIGINT", "STRING"]
    assert one(F.variant_get(F.get(codes, F.lit(1)), "$", "int"), F.variant_get(F.get(codes, F.lit(2)), "$", "string")) == [47, "shops"]
    assert one(C.map_industries(array(["Retail: \"x\""]), splitter=":")) == '[47,"\\"x\\""]'


def test_entities(one):
    assert one(G.extract_emails(F.lit("a@b.com x a@b.com c.d@e.org"))) == ["a@b.com", "c.d@e.org"]
    assert one(G.extract_emails(F.lit("éa@b.com"))) == ["a@b.com"]
    kinds = (G.salary_range_per_period, G.salary_per_period, G.salary_range, G.salary_single)

    def found(text):
        return one(*[kind(F.lit(text)) for kind in kinds])

    assert found("$20 - $30 per hour") == [["$20 - $30 per hour"], [], [], []]
    assert found("$18.50/hour") == [[], ["$18.50/hour"], [], []]
    assert found("$40,000 - $50,000") == [[], [], ["$40,000 - $50,000"], []]
    assert found("£30k to £40k") == [[], [], ["£30k to £40k"], []]
    assert found("Pay $45,000.")[3] == ["$45,000"] and found("€50,000 a year")[3] == ["€50,000"]
    assert one(G.extract_salaries(F.lit("₹45k or ₹45k, $20 - $30 per hour"))) == ["$20 - $30 per hour", "₹45k"]
    assert one(G.extract_salaries(F.lit(None).cast("string"))) == []


def test_websites(one, spark):
    tlds = G.TOP_LEVEL_DOMAINS
    text = "see www.Acme.com or http://jobs.foo.org/x and v1.zzz"
    links = array(["https://www.l.de/x", "/rel", "ftp://no.com", "http://acme.com"])
    assert one(G.extract_websites(F.lit(text), array([]), tlds)) == ["acme.com", "jobs.foo.org"]
    assert one(G.extract_websites(F.lit(None).cast("string"), links, tlds)) == ["l.de", "acme.com"]
    assert {"uk", "krd", "de", "zw", "arpa"} <= set(tlds) and not {"um", "bl", "mf", "zzz"} & set(tlds)
    assert len(set(tlds)) == len(tlds) == 264 and len(T.ENTITY_NAMES) == 88


def test_logos(one):
    page = '<base href="http://cdn.x/y/"><img CLASS=MyLogo src="../a.png"><img id=logo src=\'b.png\'><img src="logo.gif"/><img src=c>'
    expected = ["http://cdn.x/a.png", "http://cdn.x/y/b.png", "http://cdn.x/y/logo.gif"]
    assert one(G.extract_logos(F.lit(page), F.lit("http://u/"))) == expected


def test_flat_scans(one):
    page = F.lit(
        "<HTML xml:lang='fr-CA'><!-- <a href='no'> --><script>'<a href=\"no\">'</script><a title=\"href=no\" href='x?a=1&amp;b=&#233;&#x41;&zz;'>"
        "<a href=plain>t</a><a name=x><input type=hidden name=a value=1><input type='hidden' name='a' value='2'><input type=hidden name=b>"
    )
    assert one(M.extract_links(page)) == ["x?a=1&b=éA&zz;", "plain"]
    assert one(M.hidden_inputs(page)) == {"a": "2"}
    assert one(M.page_language(page)) == "fr"
    meta = '<meta http-equiv="Content-Language" content="de-AT"><html><p>'
    assert one(M.page_language(F.lit(meta)), M.page_language(F.lit("<p>"))) == ["de", None]
    assert one(M.page_language(F.lit('<html lang="en-US"><p xml:lang="x">'))) == "en"


def test_website_pattern_keeps_its_hits(spark):
    random.seed(3)
    words = ["xhttp://www.foo.com", "www/foo.com", "xwww/foo.com", "foo.com9.x.org", "www.com", "a..bb.c", "http:/a.bb"]
    words += ["".join(random.choice(["www", "http://", "a", "bb", ".", "/", "-", "9", "A"]) for _ in range(9)) for _ in range(300)]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select(
        "w", F.regexp_extract_all("w", F.lit(G.NAME_START + G.WEBSITE), F.lit(1)).alias("found")
    )
    for w, found in rows.collect():
        assert found == re.findall(G.WEBSITE, w), w


def test_broken_pages_are_read_once(one):
    for page in ("<a " * 30000, "<!--" * 30000, "<script>" * 30000, "<" * 100000, "a." * 30000):
        one(*[F.hash(fn(F.lit(page))) for fn in (M.extract_links, M.page_language, T.html_format, T.replace_tags_with_space)])
        one(G.extract_websites(F.lit(page), array([]), ["com"]))
    assert one(T.html_format(F.lit("<h1>a</h1><td>b<b c"))) == "<strong>a</strong> b<b c"
