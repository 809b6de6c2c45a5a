import json
import random
import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gleaner.functions import markup
from gleaner.operators import boilerplate as B
from gleaner.operators import elements as E
from gleaner.operators import matching as K
from gleaner.operators import rules as R
from gleaner.operators import selectors as S
from gleaner.operators.callbacks import page_callback, python_processor
from gleaner.operators.html_tree import PageTree, without_elements
from gleaner.operators.selectors import Page, Sel

PAGES = "/root/testdata/sf0.001/pages.parquet"
FIELDS = (*E.TREE_FIELDS, "html_start", "html_chars", "html_len", "path")


def parsed(spark, *pages, url="http://h/list"):
    rows = [(i, url, page) for i, page in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return E.parse_pages(df, fields=FIELDS, page_fields=("page_text", "page_html", "breaks"))


def first(df, *columns):
    out = list(df.select(*columns).first())
    return out[0] if len(out) == 1 else out


def test_tree_repair():
    tree = PageTree("<p>a<b>b<p>c</p></p><ul><li>1<li>2<ul><li>3</ul></ul><table><tr><td>x<td>y<tr><th>z</table><br/>end")
    html = "".join(tree.html)
    assert html == (
        "<p>a<b>b</b></p><p>c</p><ul><li>1</li><li>2<ul><li>3</li></ul></li></ul>"
        "<table><tr><td>x</td><td>y</td></tr><tr><th>z</th></tr></table><br>"
    )
    assert tree.outside == ["end"]


def test_raw_text_and_entities():
    tree = PageTree('<div title="a&quot;b"><script>if (a < b) "</p>"</script>&lt;&eacute;</div>')
    assert "".join(tree.html) == '<div title="a&quot;b"><script>if (a < b) "</p>"</script>&lt;é</div>'
    assert tree.html_len[0] == len('<div title="a&quot;b"><script>if (a < b) "</p>"</script>&lt;&#233;</div>')


def test_elements(spark):
    page = "<html><body><div><p>hello</p></div><p>x<i>y</i>z</p></body></html>"
    df = spark.createDataFrame([(1, page), (2, ""), (3, None)], "page_id long, html string")
    rows = E.explode_elements(df, skip=["div"]).orderBy("page_id", "node_id").collect()
    assert [r.path for r in rows] == ["/html", "/html/body", "/html/body/div/p", "/html/body/p", "/html/body/p/i"]
    assert [r.text for r in rows] == ["helloxyz", "helloxyz", "hello", "xyz", "y"]
    assert rows[3].own_text == "xz" and rows[3].html_string == "<p>x<i>y</i>z</p>"


def test_parents_hold_their_children(spark):
    df = spark.read.parquet(PAGES)
    rows = E.explode_elements(df).select("page_id", "node_id", "parent_id", "last_id", "depth", "text", "html_string").collect()
    nodes = {(r.page_id, r.node_id): r for r in rows}
    for r in rows:
        if r.parent_id >= 0:
            parent = nodes[r.page_id, r.parent_id]
            assert parent.depth + 1 == r.depth and parent.node_id < r.node_id <= r.last_id <= parent.last_id
            assert r.text in parent.text and r.html_string in parent.html_string


def test_links_agree_with_the_tree(spark):
    pages = spark.read.parquet(PAGES)
    page = Page()
    by_tree = E.parse_pages(pages).select("page_id", S.take(page, S.select_nodes(page, Sel("a")), "@href").alias("x"))
    by_scan = pages.select("page_id", markup.extract_links(F.col("html")).alias("y"))
    assert by_tree.join(by_scan, "page_id").filter("x = y").count() == pages.count()


def test_body_text(spark):
    df = parsed(spark, "<title>t</title><body>a<script>b</script><p>c", "<p>none")
    assert [r[1] for r in df.select("page_id", E.body_text()).orderBy("page_id").collect()] == ["abc", None]


def test_selectors(spark):
    page = Page()
    df = parsed(
        spark,
        '<div id=m class="a b"><p class=b>one<b>!</b></p><p title="x y">two</p></div><p class="a b">three</p>',
    )

    def take(what, *steps):
        return first(df, S.take(page, S.select_nodes(page, *steps), what))

    assert take("string()", *S.css("div.a p")) == ["one!", "two"]
    assert take("text()", *S.css(".b")) == ["one", "three"]
    assert take("//text()", *S.css("#m")) == ["one", "!", "two"]
    assert take("@title", Sel("p", has={"title": "y"})) == ["x y"]
    assert take("html", Sel("p", text_has="ne")) == ['<p class="b">one<b>!</b></p>']
    assert take("string()", *S.css("[title=x]"), Sel("p")) == []
    for selector in ("a:hover", "a, b", "x*", ""):
        with pytest.raises(ValueError):
            S.css(selector)


def test_css(spark):
    page = Page()
    df = parsed(spark, '<div><p title="a, b">1<b>2</b></p><p>3</p><i>4</i><p>5<a href="/t/x">6</a></p></div><p title=q>7</p>')

    def texts(selector):
        return first(df, S.take(page, S.css_nodes(page, selector), "text()"))

    assert texts("div > p") == ["1", "3", "5"]
    assert texts("div > b") == []
    assert texts("p:first-child ~ p") == ["3", "5"]
    assert texts("p + i, p b,a") == ["2", "4", "6"]
    assert texts('[title*=", "], [title="q"]') == ["1", "7"]
    assert texts("a[href^='/t'][href$=x]") == ["6"]
    assert texts("div>p:nth-child( 4 ) , p:nth-child(4)") == ["5"]


def test_labels(spark):
    page = Page()
    df = parsed(
        spark,
        "<dl><dt>Job title</dt><dd>Nurse</dd><dt>Location</dt><dd>Leeds</dd></dl>"
        "<table><tr><td>Job Title<td>:<td>Cook<tr><td>Description</td></tr><tr><td>a<i>b</i><tr><td>Full time</table>",
    )
    assert first(df, S.label_values(page, Sel("dt", text_has="title"), "dd")) == ["Nurse"]
    assert first(df, S.label_values(page, Sel("td", text_has="Job Title"), "td", nth=2)) == ["Cook"]
    details = S.following_rows_text(page, "tr", Sel("td", text_has="Description"))
    assert first(df, details, R.scan_keyword_type(details)) == ["abFull time", "FULL TIME"]


def test_remove_bad_elements(spark, one):
    fragments = ["<div>a<button>b<i>c</i></button>d</div>", "<script>x</script>", " ", "<!-- c -->", "text<nav>n</nav>", "a<p>b", "<p>k</p>"]
    column = F.array(*[F.lit(f) for f in fragments])
    got = one(E.remove_bad_elements(column, ["nav"]))
    assert got == ["<div>ad</div>", "<div>text</div>", "<div>a<p>b</p></div>", "<p>k</p>"]
    assert without_elements("bare", frozenset()) == "<p>bare</p>"


def test_rule_order(spark):
    df = parsed(spark, "<h1>T</h1><p>1</p><p>2</p>")
    page, url = Page(), F.col("url")
    none = R.Source([R.Pick(Sel("h9"))])

    def run(**sources):
        return first(df, R.extract_rule(R.Rule(**sources), page, url))

    assert run(xpath=[none], value=[R.Source(["x"])], static="s") == ["x"]
    assert run(xpath=[none], static="s") == ["s"]
    assert run(xpath=[none]) is None
    assert run(xpath=[none], responseurl=[R.Source(pattern="//(.)/(l)")]) == ["h", "l"]
    assert run(function=lambda p, n: F.array(F.lit("f")), static="s") == ["f"]
    assert run(xpath=[R.Source([R.Pick(Sel("h9")), R.Pick(Sel("p"))], [lambda v: F.reverse(v)])]) == ["2", "1"]


def test_job_index(spark):
    sets = [
        R.RuleSet(R.Pick(Sel("tr")), R.Rule(xpath=[R.Source([R.Pick(Sel("a"), what="@href")])])),
        R.RuleSet(
            R.Pick(Sel("li")),
            R.Rule(xpath=[R.Source([R.Pick(Sel("a"), what="@href")])]),
            relative={"title": R.Rule(xpath=[R.Source([R.Pick(Sel("a"))])])},
            nonrelative={"location": R.Rule(xpath=[R.Source([R.Pick(Sel("b"))])]), "none": R.Rule()},
            formdata={"t": R.Rule(xpath=[R.Source([R.Pick(Sel("a"))])])},
        ),
    ]
    page = "<b>a</b><b>b</b><ul><li><a href=1>x</a><li><a href=/2>y</a><li>z</ul>"
    df = R.job_index_rows(parsed(spark, page, "<tr><a href=t>", "<p>"), sets)
    rows = df.orderBy("page_id", "pos").collect()
    assert [(r.page_id, r.rule_ix, r.pos, r.joburl) for r in rows] == [(0, 1, 0, "1"), (0, 1, 1, "/2"), (0, 1, 2, None), (1, 0, 0, "t")]
    assert rows[0].custom_items == {"location": ["a"], "none": None, "title": ["x"]}
    assert rows[2].custom_items == {"location": None, "none": None, "title": None} and rows[1].formdata == {"t": "y"}
    requests = R.job_requests(df).orderBy("url").collect()
    assert [r.url for r in requests] == ["http://h/1", "http://h/2", "http://h/t"]


def test_positional_zip(one):
    rows = one(R.positional_zip(F.array(F.lit("1"), F.lit("2"), F.lit("3")), x=F.array(F.lit("a"), F.lit("b")), y=F.lit(None)))
    assert [(r.base, r.x, r.y) for r in rows] == [("1", "a", None), ("2", "b", None), ("3", None, None)]


def test_plan_pages(one):
    def pages(items):
        return one(R.plan_pages(total_items=F.lit(items), per_page=F.lit(20)))

    assert pages(45) == [2, 3] and pages(10) == [] and one(R.plan_pages(total_pages=F.lit(2))) == [2]


def test_follow_next(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("b", "c")], "src string, dst string")
    seeds = spark.createDataFrame([("a",), ("x",)], "seed string")
    rows = {(r.seed, r.url): r.depth for r in R.follow_next(seeds, links).collect()}
    assert rows == {("a", "a"): 0, ("a", "b"): 1, ("a", "c"): 2, ("x", "x"): 0}


def test_two_hops(spark):
    links = spark.createDataFrame([(1, "u?a=1"), (2, "u?b"), (3, "u"), (4, "x?")], "i int, href string")
    responses = spark.createDataFrame([("u", 2, "late"), ("u", 1, "early")], "url string, page_id int, html string")
    rows = R.two_hop_follow(links, responses, "page_id").orderBy("i").collect()
    assert [(r.i, r.url, r.html) for r in rows] == [(1, "u", "early"), (2, "u", "early")]


def test_callbacks(spark, one):
    from pyspark.sql.types import StructType

    double = python_processor(lambda values: [v for v in values for _ in range(2)])
    assert one(double(F.array(F.lit("a"), F.lit("b")))) == ["a", "a", "b", "b"]
    pages = spark.createDataFrame([("u", "x y"), ("v", None)], "url string, html string")
    schema = StructType().add("url", "string").add("word", "string")
    rows = page_callback(pages, lambda p: ({"url": p["url"], "word": w} for w in (p["html"] or "").split()), ["url", "html"], schema)
    assert sorted(tuple(r) for r in rows.collect()) == [("u", "x"), ("u", "y")]


def test_load_item(one):
    values = F.array(F.lit(" "), F.lit("\n a  b\t"), F.lit("c "))
    assert one(R.load_value("title", values), R.load_value("description", values)) == ["a b", "a  b c"]
    assert one(R.load_value("title", F.array(F.lit(" ")))) is None


def test_merge_keeps_one_row_per_detail(spark):
    detail = spark.createDataFrame([("u", ""), ("u", "own"), ("v", None)], "url string, title string")
    index = spark.createDataFrame([("u", "late", 2), ("u", "early", 1)], "url string, title string, pos int")
    rows = R.merge_index_detail(detail, index, "pos", ["title"], language=F.lit("en")).collect()
    assert sorted((r.url, r.title, r.language) for r in rows if r.title) == [("u", "early", "en"), ("u", "own", "en")]
    assert len(rows) == 3


def test_description_score(spark):
    df = parsed(spark, "<html><body><div><p>hello</p></div></body></html>", "<html></html>")
    best = df.select("page_id", K.best_element().alias("b")).orderBy("page_id").collect()
    assert best[0].b.score == pytest.approx(25 / 12) and best[0].b.node.tag == "p" and best[1].b is None


def reference_similarity(a, b, n):
    def grams(t):
        t = "$" * (n - 1) + t.lower() + "$" * (n - 1)
        return [t[i : i + n] for i in range(len(t) - n + 1)]

    left, right = grams(a), grams(b)
    rest, shared = list(right), 0
    for g in left:
        if g in rest:
            rest.remove(g)
            shared += 1
    return shared / (len(left) + len(right) - shared)


def test_ngram_search(spark):
    words = ["leeds", "leeds uk", "Banana", "bananana", "é", "", "aaaaaaa", "aaab", "a long text that is like nothing " * 20]
    texts = spark.createDataFrame(list(enumerate(words)), "id int, text string")
    terms = spark.createDataFrame([(w,) for w in words[:8]], "term string")
    for n in (3, 5):
        got = {(r.id, r.term): r.similarity for r in K.ngram_search(texts, ["id"], "text", terms, n).collect()}
        want = {(i, t): reference_similarity(w, t, n) for i, w in enumerate(words) for t in words[:8]}
        assert got == {k: v for k, v in want.items() if v >= 0.2}
    assert reference_similarity("leeds", "leeds uk", 3) == 5 / 12


def test_index_posts_no_gram_that_all_terms_hold(spark):
    terms = [f"{a}{b} limited company" for a in ("north", "south", "east", "west") for b in ("gate", "field", "moor", "wick", "ham")]
    index = K.GramIndex(spark.createDataFrame([(t,) for t in terms], "term string"))
    held = {r.token: r.held for r in index.frequency.collect()}
    common = {t for t, n in held.items() if n == len(terms)}
    posted = {r.token for r in index.postings.collect()}
    sizes = [len(t) + 2 for t in terms]
    dropped = min(math.ceil(0.2 * s - 1e-9) - 1 for s in sizes)
    assert len(common) > 15 and len(common - posted) >= dropped > 3
    # At a higher bound a term posts its rarest grams alone.
    keys = index.keys(spark.createDataFrame([("northgate limited company",)], "t string"), "t")
    matched = index.matches(keys, 0.8)
    assert [r.similarity for r in matched.collect()] == [1.0]
    text = matched._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize("threshold", [0.0, 0.2, 0.35, 0.5, 0.8, 1.0])
def test_index_loses_no_pair(spark, threshold):
    draw = random.Random(int(threshold * 10))
    words = ["".join(draw.choices("abc ", k=draw.randint(1, 25))) for _ in range(90)]
    texts = spark.createDataFrame([(i, w) for i, w in enumerate(words)] + [(99, None)], "id int, text string")
    terms = spark.createDataFrame([(w,) for w in words[:60]] + [(None,)], "term string")
    got = {(r.id, r.term): r.similarity for r in K.ngram_search(texts, ["id"], "text", terms, 3, threshold).collect()}
    want = {(i, t): reference_similarity(w, t, 3) for i, w in enumerate(words) for t in words[:60]}
    assert got == {k: v for k, v in want.items() if v >= threshold and v > 0}


def test_empty_dictionary(spark):
    texts = spark.createDataFrame([(1, "leeds")], "id int, text string")
    nothing = spark.createDataFrame([], "term string")
    assert K.ngram_search(texts, ["id"], "text", nothing).count() == 0
    assert K.fuzzy_field(parsed(spark, "<p>leeds</p>"), nothing).count() == 0


def test_fuzzy_field(spark):
    df = parsed(spark, "<div><p>Leed</p><p>Leeds</p><b>Leeds</b></div>", "<p>nothing alike</p>")
    terms = spark.createDataFrame([("leeds uk",), ("leeds",), ("Leeds",)], "term string")
    rows = K.fuzzy_field(df, terms).collect()
    assert [(r.page_id, r.node_id, r.term, r.similarity) for r in rows] == [(0, 2, "Leeds", 1.0)]


def test_scores_on_given_pages(spark):
    df = spark.read.parquet(PAGES).limit(40)
    words = sorted({w for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect() for w in r.text.split() if len(w) > 7})[:60]
    nodes = E.parse_pages(df, fields=FIELDS, page_fields=("page_text",))
    best = {r.page_id: (r.b.score, r.b.node.node_id) for r in nodes.select("page_id", K.best_element().alias("b")).collect()}
    fuzzy = {r.page_id: (r.node_id, r.term, r.similarity) for r in K.fuzzy_field(nodes, spark.createDataFrame([(w,) for w in words], "term string")).collect()}
    for row in df.collect():
        tree = PageTree(row.html)
        page, scores, matches = "".join(tree.text), [], []
        for i, tag in enumerate(tree.tag):
            text = page[tree.text_start[i] : tree.text_start[i] + tree.text_len[i]]
            if text and tag not in K.SKIPPED_TAGS:
                scores.append((len(text) ** 2 / tree.html_len[i], -i))
            if len(text) < 200:
                matches += [(-reference_similarity(text, w, 3), i, w) for w in words]
        assert best[row.page_id] == (max(scores)[0], -max(scores)[1])
        score, i, word = min(matches)
        assert fuzzy.get(row.page_id) == ((i, word, -score) if -score >= 0.2 else None)


class Node:
    def __init__(self, i, tag, sig):
        self.i, self.tag, self.sig, self.children, self.parent = i, tag, sig, [], None


def trees(pages):
    out = []
    for html in pages:
        tree = PageTree(html)
        nodes = [Node(i, t, s) for i, (t, s) in enumerate(zip(tree.tag, tree.signatures()))]
        for node, parent in zip(nodes, tree.parent):
            if parent >= 0:
                node.parent = nodes[parent]
                nodes[parent].children.append(node)
        out.append(nodes[0])
    return out


def strip_together(nodes, from_end, removed):
    """Compare elements at the same place of all pages, leaves first, and remove the equal ones."""
    lists = [list(n.children) for n in nodes]
    for k in range(min(map(len, lists))):
        strip_together([c[-1 - k] if from_end else c[k] for c in lists], from_end, removed)
    if all(not n.children for n in nodes) and len({n.sig for n in nodes}) == 1 and nodes[0].parent:
        removed.append(nodes[0].tag)
        for n in nodes:
            n.parent.children.remove(n)


def left(node):
    return [node.i] + [i for c in node.children for i in left(c)]


def check_boilerplate(spark, groups):
    rows = [(g, i, html) for g, pages in groups.items() for i, html in enumerate(pages)]
    df = spark.createDataFrame(rows, "host string, page_id long, html string")
    kept = defaultdict(set)
    for r in B.remove_boilerplate(df).collect():
        kept[r.host, r.page_id].add(r.node_id)
    report = defaultdict(list)
    for r in B.boilerplate_elements(df).collect():
        report[r.host].append(r.tag)
    for group, pages in groups.items():
        roots, removed = trees(pages), []
        if len(roots) > 1:
            strip_together(roots, False, removed)
            strip_together(roots, True, removed)
        assert sorted(report[group]) == sorted(removed), group
        for i, root in enumerate(roots):
            assert kept[group, i] == set(left(root)), (group, i)


def test_boilerplate(spark):
    page = "<body><nav>Home</nav><p>{}</p>{}<footer>F</footer></body>"
    check_boilerplate(
        spark,
        {
            "two": [page.format("A", ""), page.format("B", "")],
            "end": [page.format("A", ""), page.format("B", "<i>more</i><b>m</b>")],
            "nested": [
                "<body><div><ul><li>1</li><li>2</li></ul><p>x</p></div><div><b>s</b></div></body>",
                "<body><div><ul><li>1</li><li>3</li></ul><p>y</p></div><div><b>s</b></div></body>",
            ],
            "one": [page.format("A", "")],
            "same": ["<body><p>a</p></body>", "<body><p>a</p></body>"],
            "deep": ["<body>" + "<div>" * 50 + "x", "<body>" + "<div>" * 50 + "x<p>q</p>"],
        },
    )


def test_boilerplate_on_given_pages(spark):
    groups = defaultdict(list)
    for row in spark.read.parquet(PAGES).collect():
        groups[row.url.split("/")[2]].append(row.html)
    check_boilerplate(spark, groups)


def test_selector_config(one):
    from gleaner.operators.policy import serp_value
    from gleaner.sources.files import parse_selector_config

    config = [{"id": "serp_location", "selector": "#p"}]
    assert [r.selector for r in one(parse_selector_config(F.lit(json.dumps(config))))] == ["#p"]
    assert one(parse_selector_config(F.lit(None).cast("string"))) == []
    assert serp_value(Page(), [], "serp_location") is not None


def test_whole_crawl(spark):
    from gleaner.operators.crawl import Site, crawl_items

    lists = [
        (1, "http://a.com/l", "<ul><li><a href='/j1'>One</a><li><a href='/j2'>Two</a><li><b>no link</b></ul>"),
        (2, "http://a.com/m", "<ul><li><a href='j1'>Again</a><li><a href='/j3'>Three</a><li><a href='/j4'>Four</a></ul>"),
    ]
    answers = [
        (8, "http://a.com/j1", "<h1> A  job </h1><i>7</i>", 200),
        (9, "http://a.com/j1", "<h1>Later</h1><i>9</i>", 200),
        (8, "http://a.com/j2", "<i>2</i>", 200),
        (8, "http://a.com/j3", "<h1>x</h1>", 200),
        (8, "http://a.com/j4", "<body><h1>gone for good</h1><i>4</i></body>", 200),
        (8, "http://a.com/other", "<h1>never asked for</h1><i>1</i>", 200),
        (8, "http://a.com/m", None, 500),
    ]
    pick = lambda tag: R.Rule(xpath=[R.Source([R.Pick(Sel(tag))])])
    sets = [R.RuleSet(base=R.Pick(Sel("li")), joburl=R.Rule(xpath=[R.Source([R.Pick(Sel("a"), what="@href")])]), relative={"title": pick("a")})]
    site = Site(sets, {"title": pick("h1"), "referencenumber": pick("i")}, ["title"], ["for good"], {"company": F.lit("c")})
    found = crawl_items(
        spark.createDataFrame(lists, "page_id int, url string, html string"),
        spark.createDataFrame(answers, "page_id int, url string, html string, status int"),
        site, F.lit("2020-01-02").cast("timestamp"), F.when(F.col("title") == "Two", "temp-job").otherwise("job"),
    )
    rows = {r.url[-2:]: (r.title, r.referencenumber, r.company, r.date, r.reject, r.route) for r in found.collect()}
    assert rows == {
        "j1": ("A job", "7", "c", "2020/01/02", None, "job"),
        "j2": ("Two", "2", "c", "2020/01/02", None, "temp-job"),
        "j3": ("x", None, "c", "2020/01/02", "missing_reference", None),
        "j4": ("gone for good", "4", "c", "2020/01/02", "error_page", None),
    }
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.split("== Initial Plan ==")[0].count("MapInArrow") == 1
