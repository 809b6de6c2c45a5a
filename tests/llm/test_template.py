"""Main text against a direct deduction over all pages of a host, and literal pages."""

import random
from collections import Counter, defaultdict

import pytest

from gleaner.llm import template

SCHEMA = "page_id long, url string, html string, text string, host string"


def text_of(html):
    return template.Page(html).text(None, frozenset())


def texts(spark, rows):
    table = spark.createDataFrame([(i, u, h, "t", "h") for i, u, h in rows], SCHEMA).repartition(3)
    out = defaultdict(list)
    for r in template.main_text(table).collect():
        out[r["page_id"]].append(r["text"])
    return out


@pytest.mark.parametrize(
    "html,want",
    [
        ("<main><h1>T</h1><p>The long story goes on here.</p></main><div><article>Teaser one</article></div>", "T The long story goes on here."),
        ("<div><article><p>one</p></article></div><section><article><p>two</p></article></section>", "one two"),
        ("<article><p>story</p><div class='user-comments'><p>nice nice nice nice</p></div><div class='cookie-bar'>We use</div></article>", "story"),
        ("<article><p>story</p></article><article class='comment'><p>much longer than the story is</p></article>", "story"),
        ("<article><div class='entry-header'><h1>Head</h1></div><p>text</p></article>", "Head text"),
        ("<div class='content has-sidebar'><p>all text</p></div>", "all text"),
        ("<div id='content' class='no-comments'><p>all text</p></div>", "all text"),
        ("<body class='comments-open'><div class='comments'>only text</div>", "only text"),
        ("<article>a &amp; b&nbsp;c</article>", "a & b c"),
        ("", ""),
    ],
)
def test_literal_pages(html, want):
    assert text_of(html) == want


def host_pages(draw, n, article, notices=True):
    word = lambda: f"w{draw.randrange(10**6)}"
    rows = []
    for k in range(n):
        story = [" ".join(word() for _ in range(30)) for _ in range(4)]
        inner = "".join(f"<p>{p}</p>" for p in story[:2]) + ("<div><p>Sign up for our letter today</p></div>" if notices else "")
        inner += "".join(f"<p>{p}</p>" for p in story[2:])
        html = f"<body><div class='x1'><a href='/'>Home</a> <a href='/b'>More</a></div>{article.format(inner)}<div class='x2'>All rights kept</div></body>"
        rows.append((html, " ".join(story)))
    return rows


@pytest.mark.parametrize("article", ["<div class='q7'>{}</div>", "<article>{}</article>", "<div><div class='post'>{}</div></div>"])
def test_repeated_notices_go_whatever_the_article_is_called(spark, article):
    draw = random.Random(5)
    rows = host_pages(draw, 12, article)
    given = [(i, f"http://a.org/{i}", h) for i, (h, _) in enumerate(rows)]
    # An empty page, an odd page and copies of a page change nothing.
    given += [(100, "http://a.org/e", None), (101, "http://a.org/o", "<div>odd</div>"), *[(200 + k, f"http://a.org/c{k}", rows[0][0]) for k in range(30)], (3, "http://a.org/3", rows[3][0])]
    found = texts(spark, given)
    assert all(found[i] == [w] * (2 if i == 3 else 1) for i, (_, w) in enumerate(rows))
    assert found[100] == [""] and found[101] == ["odd"] and found[200] == [rows[0][1]]


def test_template_equals_a_direct_deduction(spark):
    draw = random.Random(8)
    given, pages_of = [], defaultdict(list)
    for host in range(6):
        shape = draw.choice(["<div class='q7'>{}</div>", "<article>{}</article>"])
        for html, _ in host_pages(draw, draw.randint(3, 14), shape, notices=host % 2 == 0):
            given.append((len(given), f"http://h{host}.org/p", html))
            pages_of[f"h{host}.org"].append(html)
    table = spark.createDataFrame(given, "page_id long, url string, html string").withColumn("host", template.host_of("url"))
    found = {r["host"]: (r["region"], set(r["template"])) for r in template.templates(table).collect()}
    for host, pages in pages_of.items():
        parsed = [template.Page(h) for h in pages]
        vectors = defaultdict(dict)
        for k, page in enumerate(parsed):
            for token, n in (Counter(page.elements) + Counter(template.text_token(p, t) for p, t in page.blocks)).items():
                vectors[token][k] = n
        wide = {t: v for t, v in vectors.items() if 2 * len(v) >= len(pages) and (not t.startswith("#") or len(v) >= template.LEAST_PAGES)}
        total = sum(len(t) for page in parsed for _, t in page.blocks)
        inner = [t for t, v in wide.items() if not t.startswith("#") and set(v.values()) == {1}
                 and sum(page.letters((t,)) for page in parsed) >= template.SHARE * total]
        assert found[host] == (max(inner, key=lambda t: (len(t), t)), {t for t in wide if t.startswith("#")})


def test_a_notice_on_few_pages_goes_with_the_element_that_always_holds_it(spark):
    draw = random.Random(3)
    rows = host_pages(draw, 40, "<div class='q7'>{}</div>", notices=False)
    box = "<div class='z9'><p>Meet us at the fair</p></div></body>"
    given = [(i, f"http://a.org/{i}", h.replace("</body>", box) if i < 8 else h) for i, (h, _) in enumerate(rows)]
    # The same words in an element that says something else elsewhere, and near copies of an article in an element of their own, stay.
    quote = [(h.replace("</p></div><div class='x2'>", f"</p><p class='k2'>{'Said so' if i < 26 else i}</p></div><div class='x2'>"), i) for i, (h, _) in enumerate(rows) if 20 <= i < 32]
    given = [(i, u, dict((k, q) for q, k in quote).get(i, h)) for i, u, h in given]
    copy = "long copied words of the story " * 40
    given += [(100 + k, f"http://a.org/c{k}", f"<body><div class='x1'>Home</div><div class='r5'><p>{copy}</p><p>take {k}</p></div></body>") for k in range(6)]
    found = texts(spark, given)
    assert all(found[i] == [rows[i][1]] for i in range(8))
    assert all(found[i][0].endswith("Said so") for i in range(20, 26))
    assert all(copy.strip() in found[100 + k][0] for k in range(6))


@pytest.mark.parametrize("path,part", [("/html/div.a.b/p/", "/html/div.a.b/"), ("/div.a/div.b/", "/div.a/div.b/"), ("/html/p/", ""), ("/", "")])
def test_named_part(path, part):
    assert template.named_part(path) == part


def test_very_long_and_many_blocks(spark):
    long = "<article>" + "".join(f"<p>part {k} of it</p>" for k in range(60_000)) + "</article>"
    [found] = texts(spark, [(1, None, long)])[1]
    assert found.startswith("part 0 of it part 1 of it") and found.endswith("part 59999 of it")
    assert texts(spark, []) == {}
