import json
import re
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gleaner.operators import policy as P
from gleaner.operators import robots as J
from gleaner.operators import rollups as I
from gleaner.operators import rules as R
from gleaner.operators import runs
from gleaner.operators import validate as H
from gleaner.operators.code_tables import map_by_table
from gleaner.operators.joins import carry_backward, carry_forward, lookup_join
from gleaner.operators.rollups import top_per_group
from gleaner.sources import files
from gleaner.sources.schema import ITEM_SCHEMA, as_items
from gleaner.sources.tables import raw_capture, scan_responses

ROBOTS = """User-agent: *
Disallow: /private
Allow: /private/ok

User-agent: FooBot
Disallow: /*.pdf$
"""


def robots(spark, *bodies):
    return spark.createDataFrame([(f"h{i}", body) for i, body in enumerate(bodies)], "host string, body string")


def allowed(spark, body, agent, *paths, decide=J.robots_decide, **options):
    groups = J.robots_groups(robots(spark, body), relaxed=decide is J.robots_decide_relaxed)
    requests = spark.createDataFrame([(i, f"http://h0{p}") for i, p in enumerate(paths)], "i int, url string")
    return [r.allowed for r in decide(requests, groups, agent, **options).orderBy("i").collect()]


def test_robots_first_match(spark):
    assert allowed(spark, ROBOTS, "FooBot/1.0", "/a.pdf", "/a.pdf?x=1", "/private") == [False, True, True]
    assert allowed(spark, ROBOTS, "Other", "/private/ok", "/", "") == [False, True, True]
    assert allowed(spark, "User-agent: *\nDisallow:\n", "x", "/a") == [True]
    assert allowed(spark, "User-agent: *\nAllow:\nDisallow: /\n", "x", "/a") == [False]
    assert allowed(spark, "User-agent: *\nDisallow: /a%2fb\nDisallow: /c%20d", "x", "/a/b", "/a%2Fb", "/c d") == [True, False, False]
    assert allowed(spark, "User-agent: *\nDisallow: /*q=[1].x", "x", "/p?q=[1].x", "/p?q=1ax") == [False, True]
    assert allowed(spark, ROBOTS, "FooBot", "/a.pdf", "/*.pdf$", strict=True) == [True, False]


def test_robots_relaxed(spark):
    relaxed = {"decide": J.robots_decide_relaxed}
    assert allowed(spark, ROBOTS, "Other/2.0", "/private/ok", "/PRIVATE/x", **relaxed) == [True, False]
    assert allowed(spark, ROBOTS, "foobot/9", "/x.PDF", "/x.pdf?a=1", "/y", **relaxed) == [False, False, True]
    assert allowed(spark, "User-agent: *\nDisallow: tmp\n", "x", "/a/tmp", "/a", **relaxed) == [False, True]
    two = "User-agent: *\nDisallow: /a\n\nUser-agent: *\nDisallow: /b\n"
    assert allowed(spark, two, "x", "/a", "/b", **relaxed) == [True, False]


def test_robots_groups(spark):
    body = (
        "Disallow: /before\nUser-agent: A\n# c\nnonsense\nUseragent: B # x\nCrawl-delay: fast\nCrawl-delay: 3\nDisallow: /1\n"
        "User-agent: *\nAllow: /2\nSitemap: http://s/1\nUser-agent: C\n\nDisallow: /lost\nUser-agent:\nDisallow: /x\rUser-agent: D\rDisallow: /\t3\r\n"
    )
    groups = J.robots_groups(robots(spark, body, "")).orderBy("group_no").collect()
    found = [(r.agents, [(x.kind, x.path) for x in r.rules], r.crawl_delay) for r in groups]
    assert found == [
        (["A", "B"], [("disallow", "/1")], 3.0),
        (["D"], [("disallow", "/3")], None),
        (["*"], [("allow", "/2")], None),
    ]
    assert [r.sitemap for r in J.sitemaps(robots(spark, body)).collect()] == ["http://s/1"]
    assert J.robots_rules(J.robots_groups(robots(spark, body))).count() == 4


def test_robots_files(one):
    assert one(files.robots_media_type(F.lit(" Text/Plain; a=b; charset='UTF-8'"))).asDict() == {"media_type": "text/plain", "charset": "utf-8"}
    assert one(files.robots_media_type(F.lit(None).cast("string"))).media_type == ""
    status = F.lit(403)
    assert one(J.robots_by_status(status), J.robots_by_status(status, strict=False)) == ["deny", "allow"]
    assert one(J.robots_by_status(F.lit(404)), J.robots_by_status(F.lit(500)), J.robots_by_status(F.lit(200))) == ["allow", "error", None]
    fetched = F.lit(datetime(2016, 1, 1))
    for form in ("Sun, 03 Jan 2016 01:00:00 GMT", "Sunday, 03-Jan-16 01:00:00 GMT", "Sun Jan  3 01:00:00 2016", "3 Jan 2016 02:00:00 +0100"):
        assert one(J.robots_expiry(F.lit(form), fetched)) == datetime(2016, 1, 3, 1), form
    assert one(J.robots_expiry(F.lit("0"), fetched)) == datetime(2016, 1, 8)


def test_robots_status(spark):
    decided = spark.createDataFrame([(f"h{s}", True) for s in (200, 403, 404, 500, 0)], "host string, allowed boolean")
    fetches = spark.createDataFrame([(f"h{s}", s) for s in (200, 403, 404, 500)], "host string, status int")
    strict = {r.host: r.allowed for r in J.apply_robots_status(decided, fetches).collect()}
    assert strict == {"h200": True, "h403": False, "h404": True, "h500": None, "h0": True}
    denied = decided.withColumn("allowed", F.lit(False))
    relaxed = {r.host: r.allowed for r in J.apply_robots_status(denied, fetches, strict=False).collect()}
    assert relaxed == {"h200": False, "h403": True, "h404": True, "h500": True, "h0": False}


def test_offsite_policy(spark):
    requests = spark.createDataFrame([("s", "http://a.com/"), ("s", "http://b.com/")], "site_id string, url string")
    none = spark.createDataFrame([], "site_id string, domain string")
    kept = P.offsite_filter(requests, none, policy=F.col("host") == "b.com").collect()
    assert [tuple(r) for r in kept] == [("s", "http://b.com/")]


def test_one_robots_text_per_host(spark):
    fetches = spark.createDataFrame([("h", "old", 1), ("h", "new", 2)], "host string, body string, at int")
    assert [tuple(r) for r in J.latest_robots(fetches, fetched="at").collect()] == [("h", "new")]


def test_robots_globs(spark):
    draw = random.Random(2)
    rows = [
        (i, "".join(draw.choices("/ab*$.", k=draw.randint(0, 7))), "".join(draw.choices("/ab.$\n" if i % 9 == 0 else "/ab.$", k=draw.randint(0, 9))))
        for i in range(2000)
    ]
    frame = spark.createDataFrame(rows, "i int, path string, target string")
    for floating in (False, True):
        rule = F.struct(*[c.alias(k) for k, c in J._matcher(F.col("path"), floating).items()])
        got = {r.i: r.fits for r in frame.select("i", J._fits(F.col("target"), rule).alias("fits")).collect()}
        for i, path, target in rows:
            plain = path.removesuffix("$")
            pattern = ("^.*" if floating and not path.startswith("/") else "^") + ".*".join(map(re.escape, plain.split("*"))) + ("$" if plain != path else "")
            assert got[i] == bool(re.search(pattern, target)), (path, target)


def test_robots_for_several_agents(spark):
    body = "User-agent: a\nDisallow: /x*y$\nAllow: /x\nCrawl-delay: 2\n\nUser-agent: *\nDisallow: /x"
    groups = J.robots_groups(robots(spark, body))
    urls = [f"http://{groups.first()['host']}{p}" for p in ("/x1y", "/x1yz", "/z")]
    asked = J.decide_for_agents(spark.createDataFrame([(u,) for u in urls], "url string"), groups, {"one": "A/1", "two": "B"})
    assert [(r.one, r.two, r.one_delay, r.two_delay) for r in asked.orderBy("url").collect()] == [
        (False, False, 2.0, None), (True, False, 2.0, None), (True, True, 2.0, None)
    ]


def test_robots_size_limit(spark):
    body = "User-agent: *\n" + "Disallow: /é\n" * 20000
    kept = body.encode()[: files.ROBOTS_BYTES].decode("utf-8", "replace")
    assert files.scan_robots(robots(spark, body), most_bytes=files.ROBOTS_BYTES).count() == len(kept.split("\n"))
    assert files.scan_robots(robots(spark, body)).count() == 20002


def test_robots_of_the_latest_fetch(spark):
    fetches = spark.createDataFrame(
        [("h", "User-agent: *\nDisallow: /z", 503, 1), ("h", "User-agent: *\nDisallow: /a\nSitemap: s", 200, 2)],
        "host string, body string, status int, at int",
    )
    rules = J.robots_rules(J.robots_groups(fetches, fetched="at")).collect()
    assert [r["path"] for r in rules] == ["/a"]
    assert [r["sitemap"] for r in J.sitemaps(fetches, fetched="at").collect()] == ["s"]
    decided = spark.createDataFrame([("h", True)], "host string, allowed boolean")
    assert J.apply_robots_status(decided, fetches, fetched="at").first()["allowed"] is True
    assert J.apply_robots_status(decided, fetches).first()["allowed"] is None


def test_run_without_a_claim_keeps_its_items(spark):
    items = spark.createDataFrame([("a",), ("a",), ("b",)], "run string")
    claims = spark.createDataFrame([("b", "7 jobs"), ("c", "none")], "run string, claim string")
    found = {r["run"]: (r["expected"], r["n_items"]) for r in I.expected_job_count(items, claims, "run", "claim").collect()}
    assert found == {"a": (None, 2), "b": (7, 1), "c": (-1, 0)}


def test_walk_deeper_than_any_cap(spark):
    links = spark.createDataFrame([(f"u{i}", f"u{i + 1}") for i in range(40)], "src string, dst string")
    found = R.follow_next(spark.createDataFrame([("u0",)], "seed string"), links)
    assert found.agg({"depth": "max"}).first()[0] == 40 and found.count() == 41


def walked(seeds, links):
    out = {}
    for seed in seeds:
        depth, frontier = {seed: 0}, [seed]
        while frontier:
            frontier = [d for u in frontier for s, d in links if s == u and d not in depth and not depth.update({d: depth[u] + 1})]
        out |= {(seed, u): d for u, d in depth.items()}
    return out


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(R, "_along_chains", lambda starts, jumps, run=R._along_chains: (run(starts, jumps), rounds.append(len(jumps)))[0])
    links = spark.createDataFrame([(f"u{i}", f"u{i + 1}") for i in range(5000)], "src string, dst string")
    found = R.follow_next(spark.createDataFrame([("u0",), ("u4990",)], "seed string"), links)
    assert found.count() == 5001 + 11 and found.agg({"depth": "max"}).first()[0] == 5000
    assert rounds and max(rounds) < 20


def test_walk_over_forks_and_cycles(spark):
    draw = random.Random(4)
    for size in (12, 28, 40):
        links = [(f"u{draw.randrange(25)}", f"u{draw.randrange(25)}") for _ in range(size)] + [("u1", "u2"), ("u1", "u2"), (None, "u3"), ("u3", None)]
        seeds = [f"u{draw.randrange(25)}" for _ in range(4)] + ["alone"]
        found = R.follow_next(spark.createDataFrame([(x,) for x in seeds], "seed string"), spark.createDataFrame(links, "src string, dst string"))
        assert {(r.seed, r.url): r.depth for r in found.collect()} == walked(seeds, [x for x in links if None not in x])


def test_boilerplate_of_several_roots_and_empty_pages(spark):
    from gleaner.operators.boilerplate import boilerplate_elements, remove_boilerplate

    pages = lambda *html: spark.createDataFrame([("h", i, x) for i, x in enumerate(html)], "host string, page_id int, html string")
    tags = lambda frame: sorted((r["page_id"], r["tag"]) for r in frame.collect())
    one = pages("<div><p>x</p></div><div><p>x</p></div>", "<div></div>")
    assert tags(remove_boilerplate(one)) == [(0, "div"), (0, "div"), (0, "p"), (0, "p"), (1, "div")]
    two = pages("<div><nav>m</nav><b>1</b></div><div><i>s</i></div>", "<div><nav>m</nav><b>2</b></div><div><i>s</i></div>", "")
    assert tags(remove_boilerplate(two)) == [(0, "b"), (0, "div"), (0, "div"), (1, "b"), (1, "div"), (1, "div")]
    assert sorted(r["tag"] for r in boilerplate_elements(two).collect()) == ["i", "nav"]


def test_offsite(spark):
    urls = ["http://a.com/", "http://x.a.com/", "http://ba.com/", "javascript:void(0)", "http://other.org/"]
    requests = spark.createDataFrame([(s, u) for s in ("s", "free") for u in urls], "site_id string, url string")
    rules = spark.createDataFrame([("s", "a.com")], "site_id string, domain string")
    flagged = P.offsite_flag(requests, rules, dont_filter=F.contains("url", F.lit("other")))
    kept = {(r.site_id, r.url) for r in flagged.filter("follow").collect()}
    assert kept == {("s", u) for u in (urls[0], urls[1], urls[4])} | {("free", u) for u in urls}
    assert P.offsite_counts(flagged).first().asDict() == {"offsite_domains": 1, "offsite_filtered": 2}
    assert P.offsite_flag(requests, rules, enabled=F.lit(False)).filter("NOT follow").count() == 0


def test_url_feed(spark, tmp_path):
    path = tmp_path / "feed.txt"
    path.write_text(" http://www.a.com/\t\nhttps://a.com/\nhttps://taleo.net/\nhttps://gone.com/\nhttps://new.com/\n")
    feed = files.scan_url_feed(spark, str(path))
    known = spark.createDataFrame([("https://gone.com/", 404), ("https://a.com/", 200)], "url string, status int")
    kept = P.clean_url_feed(feed, known, P.SKIP_URLS).orderBy("line_no").collect()
    assert [r.url for r in kept] == ["https://a.com/", "https://new.com/"]
    # Nothing is skipped unless it is listed.
    whole = P.clean_url_feed(feed, known).orderBy("line_no").collect()
    assert [r.url for r in whole] == ["https://a.com/", "https://taleo.net/", "https://new.com/"]
    skip = spark.createDataFrame([("https://new.com/",)], "url string")
    assert P.clean_url_feed(feed, known, skip).count() == 2


def test_serp_match(spark):
    requests = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "url string")
    serp = spark.createDataFrame([("u1", "here"), ("u2", None), ("u2", "")], "serp_job_link string, serp_location string")
    rows = P.serp_link_match(requests, serp).orderBy("url").collect()
    assert [(r.url, r.serp_location, r.serp_job_link) for r in rows] == [("u1", "here", "u1"), ("u2", None, None), ("u3", None, None)]


def test_item_lines(spark, tmp_path):
    items = spark.createDataFrame([("é", None, "job"), ("x", "", "raw")], "title string, location string, route string")
    files.write_items_jsonl(items, str(tmp_path / "plain"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "plain")).collect()]
    assert sorted(lines, key=str) == sorted([{"title": "é", "route": "job"}, {"title": "x", "location": "", "route": "raw"}], key=str)
    assert "é" in "".join(r.value for r in spark.read.text(str(tmp_path / "plain")).collect())
    files.write_items_jsonl(items, str(tmp_path / "routed"), route="route")
    assert sorted(p.name for p in (tmp_path / "routed").iterdir() if p.is_dir()) == ["route=job", "route=raw"]


def test_decode(spark):
    rows = [("é€".encode("cp1252"), "Windows-1252"), ("é".encode("latin-1"), "latin-1"), ("日本".encode("shift_jis"), "shift_jis"),
            ("é".encode(), None), (b"\xff!", "utf-8"), (None, "utf-8"), (b"x", "no-such")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, body binary, charset string")
    texts = [r.t for r in df.select("i", files.decode_body(F.col("body"), F.col("charset")).alias("t")).orderBy("i").collect()]
    assert texts == ["é€", "é", "日本", "é", "�!", None, "x"]


def test_payload(spark):
    import base64

    df = spark.createDataFrame([("?" * 100 + "ÿ>é", None)], "a string, b string")
    payload = df.select(files.payload_b64url(["a", "b"]).alias("p")).first().p
    assert "\n" not in payload and "+" not in payload and "/" not in payload and len(payload) % 4 == 0
    assert json.loads(base64.urlsafe_b64decode(payload)) == {"a": "?" * 100 + "ÿ>é"}


def test_raw_capture(spark):
    page = '<META content="text/html; charset=ISO-8859-1"><p>'
    responses = scan_responses(spark.createDataFrame([(1, "u", page), (2, "bad", "<p>")], "page_id long, url string, html string"))
    assert responses.orderBy("page_id").first().encoding_body_declared == "iso-8859-1"
    rows = raw_capture(responses, reject=F.col("url") == "bad", mining_job_id="7").collect()
    assert [(r.mining_job_id, r.url, r.raw_html) for r in rows] == [("7", "u", page)]


def test_encodings(spark):
    pages = spark.createDataFrame([(1, "u", "<p>", b"\xe9", "text/html"), (2, "v", "<meta charset=X>", b"a", "t; charset=Y")], "page_id long, url string, html string, body binary, header string")
    rows = scan_responses(pages, F.col("header"), F.col("body")).orderBy("page_id").collect()
    assert [tuple(r)[3:] for r in rows] == [("cp1252", None, None, "cp1252"), ("y", "y", "x", "utf-8")]


def test_posting_schema(spark):
    assert len(ITEM_SCHEMA.fields) == len(set(ITEM_SCHEMA.names)) == 55
    row = as_items(spark.createDataFrame([(7, ["a"])], "title int, autoextracted_emails array<string>")).first()
    assert (row.title, row.autoextracted_emails, row.location) == ("7", ["a"], None)


def test_defaults(spark):
    items = spark.createDataFrame([(None, None, "", "12"), ("u", "2015/01/01", None, "")], "url string, date string, location string, zip_code string")
    now = F.lit(datetime(2016, 5, 3))
    rows = H.item_defaults(H.location_fallback(items), F.lit("p"), now, F.lit("")).collect()
    assert [(r.url, r.date, r.location, r.language) for r in rows] == [("p", "2016/05/03", "12", None), ("u", "2015/01/01", None, None)]


def test_rejects(one, spark):
    body = F.lit("x Position filled y gone")
    messages = ["Position filled", "gone", "never"]
    assert one(H.error_reason(F.lit(404), body, messages)) == "Status Code Error: 404"
    assert one(H.error_reason(F.lit(200), body, messages)) == "Response Body Error: Position filled, gone"
    assert one(H.error_reason(F.lit(200), F.lit("fine"), messages)) is None
    items = spark.createDataFrame([("r" * 51,), ("r",), ("",), (None,)], "referencenumber string")
    assert H.drop_long_reference(items).count() == 3 and H.drop_long_reference(items, local=False).count() == 4
    assert H.require_reference(items).count() == 2


def site(spark, n_valid):
    rows = [("s", i, "t" if i <= n_valid else "", "d", "r", "l") for i in range(1, 13)]
    return spark.createDataFrame(rows, "site string, i int, title string, description string, referencenumber string, location string")


def test_site_validity(spark):
    for n_valid, valid in ((8, True), (7, False)):
        row = H.site_validity(site(spark, n_valid), "site", [F.asc("i")], 10).first()
        assert (row.n_checked, row.n_complete, row.valid) == (10, n_valid, valid)


def test_top_per_group_prunes_before_the_shuffle(spark):
    plan = top_per_group(spark.range(1000).withColumn("g", F.col("id") % 2), ["g"], [F.asc("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]


def test_rollup(spark):
    items = spark.createDataFrame([("a", None), ("a", ""), ("b", "x\ny")], "company string, location string")
    rollup = I.field_rollup(items, ["company", "location"])
    assert {(r.field, r.value): r.n for r in rollup.collect()} == {
        ("company", "a"): 2, ("company", "b"): 1, ("location", "none"): 2, ("location", "x\ny"): 1
    }
    assert I.rollup_settings("company:10,location:20,jobtype,functions") == {"company": 10, "location": 20, "jobtype": -1, "functions": -1}
    top = I.field_topk(rollup, {"company": 1, "location": -1}).collect()
    assert sorted((r.field, r.value) for r in top) == [("company", "a"), ("location", "none"), ("location", "x\ny")]


def test_serp_count(one):
    texts = ["Showing 1-20 of 1,234 jobs", "none", ",", None]
    assert one(*[I.serp_expected_count(F.lit(t).cast("string")) for t in texts]) == [1234, 0, 0, 0]


def test_histogram(spark):
    times = spark.createDataFrame([(float(v),) for v in [0, 10, 255, 256, 257, 600, 9000]], "ms double")
    row = I.parse_time_histogram(times, F.col("ms")).first()
    # Bins: 1, 10, 255, 257, 257, 603, 5023
    assert (row.n_times, row.total_ms, row.average_ms, row.p50_ms, row.p90_ms) == (7, 6406, 915, 257, 603)


def test_mapping_table(spark):
    items = spark.createDataFrame([("Night-Job",), ("x",), (None,)], "kind string")
    codes = spark.createDataFrame([("night ", "N"), ("NIGHT", "N2")], "key string, code string")
    rows = map_by_table(items, "kind", codes, "code", remove=["Job"]).collect()
    assert sorted(str(r.code) for r in rows) == ["N", "None", "X"]


def test_lookup_join_both_ways(spark):
    facts = spark.range(100).withColumn("k", F.when(F.col("id") < 90, 0).otherwise(F.col("id")))
    table = spark.createDataFrame([(0, "a"), (95, "b")], "k long, v string")
    small, large = lookup_join(facts, table, ["k"]), lookup_join(facts, table, ["k"], limit=0)
    assert sorted(small.collect()) == sorted(large.collect())
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_carry(spark):
    start = datetime(2024, 1, 1)
    minutes = [0, 1, 59, 61, 61, 300, 300, 500]
    df = spark.createDataFrame([("r", i, start + timedelta(minutes=m), i % 3 == 0) for i, m in enumerate(minutes)], "k string, i int, ts timestamp, hit boolean")
    value = F.when(F.col("hit"), F.col("ts"))
    for strict in (False, True):
        last = {r.i: r.x for r in carry_forward(df, ["k"], "ts", value, "x", strict=strict).collect()}
        following = {r.i: r.x for r in carry_backward(df, ["k"], "ts", value, "x", strict=strict).collect()}
        for i, m in enumerate(minutes):
            hits = [h for j, h in enumerate(minutes) if j % 3 == 0]
            before = [h for h in hits if h < m or (h == m and not strict)]
            after = [h for h in hits if h > m or (h == m and not strict)]
            assert last[i] == (start + timedelta(minutes=max(before)) if before else None)
            assert following[i] == (start + timedelta(minutes=min(after)) if after else None)


def test_stale_runs(spark):
    day = datetime(2024, 1, 1)
    rows = [("r", day, "job"), ("r", day + timedelta(minutes=10), "job"), ("r", day + timedelta(minutes=45), "job"), ("r", day + timedelta(minutes=50), "api")]
    messages = spark.createDataFrame(rows, "run string, ts timestamp, type string")
    alerts = runs.stale_run_alerts(messages, "run", "ts", F.col("type") == "api", F.lit(day + timedelta(hours=5))).collect()
    assert [(r.last_seen, r.alert_after) for r in alerts] == [(day + timedelta(minutes=10), day + timedelta(minutes=40))]


def test_recent_failures(spark):
    now = datetime(2024, 1, 1, 12)
    rows = [("a", 1, "finished", 3, now - timedelta(hours=1)), ("a", 0, "running", 3, now - timedelta(hours=3)), ("b", 2, "finished", 0, now),
            ("c", 3, "finished", 1, now - timedelta(hours=2)), ("d", 4, "running", 1, now)]
    latest = I.latest_run(spark.createDataFrame(rows, "spider string, run long, state string, errors_count int, updated timestamp"), "spider", "updated", "run")
    assert [r.spider for r in I.recent_failures(latest, "updated", F.lit(now)).collect()] == ["a"]
    assert sorted(r.spider for r in I.startable(latest).collect()) == ["a", "b", "c"]
