"""Robots rules as tables, and decisions as a join on the host.

The groups of a host are kept nested in one row. For the asked agents, all at once, the group of each is chosen and its rules are
made into matchers: the literal parts between wildcards, found one after another. A request meets the one row of its host and
finds the first matching rule inside it, so no request is multiplied by rules or agents, and no pattern is built for a request.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.text import strip
from gleaner.functions.urls import netloc, unquote, url_path, url_tail
from gleaner.operators.joins import lookup_join
from gleaner.session import cut_lineage
from gleaner.sources.files import scan_robots

# Fixed value: how long a robots file without an expiry is good.
EXPIRY = "INTERVAL 7 DAYS"
DIRECTIVE = r"(?i)(allow|disallow|user-?agent|sitemap|crawl-delay):[ \t]*(.*)"


def unquote_path(path: Column) -> Column:
    """Percent-decode a path but for its escaped slashes."""
    kept = F.regexp_replace(path, "%2[fF]", "\n")
    return F.replace(unquote(kept), F.lit("\n"), F.lit("%2F"))


def latest_robots(robots: DataFrame, host: str = "host", body: str = "body", fetched: str | None = None) -> DataFrame:
    """One text per host, however often it was fetched: the one with the greatest `fetched`, else the greatest text."""
    text = F.max(body) if fetched is None else F.max_by(body, fetched)
    return robots.groupBy(host).agg(text.alias(body))


def _directives(robots: DataFrame, host: str, body: str, relaxed: bool, fetched: str | None = None) -> DataFrame:
    """Lines that mean something: `field`, `data`; a blank line that ends a group has field ''."""
    lines = scan_robots(latest_robots(robots, host, body, fetched), host, body).withColumn("line", strip(F.col("line")))
    cut = strip(F.regexp_replace("line", "#.*$", ""))
    if relaxed:
        # Only an empty line ends a group; the name must be the whole text before the first colon.
        lines = lines.filter((F.col("line") == "") | (cut != ""))
        name = F.lower(strip(F.substring_index(cut, ":", 1)))
        field = F.when(cut == "", "").when(cut.contains(":") & name.isin("user-agent", "allow", "disallow"), name)
        data = F.lower(unquote(strip(F.regexp_extract(cut, "^[^:]*:(.*)$", 1))))
    else:
        lines = lines.filter(~F.startswith("line", F.lit("#")))
        name = F.replace(F.lower(F.regexp_extract(cut, DIRECTIVE, 1)), F.lit("useragent"), F.lit("user-agent"))
        field = F.when(cut == "", "").when(name != "", name)
        data = strip(F.regexp_replace(F.regexp_extract(cut, DIRECTIVE, 2), r"[\x00-\x1f\x7f]", ""))
    return lines.select(host, "line_no", field.alias("field"), data.alias("data")).filter(F.col("field").isNotNull())


def robots_groups(
    robots: DataFrame, host: str = "host", body: str = "body", relaxed: bool = False, fetched: str | None = None
) -> DataFrame:
    """One row per rule group in the order groups are tried: `host, group_no, agents, rules, crawl_delay`.

    Consecutive user-agent lines share a group; a user-agent line after rules, or a blank line, ends one.
    Groups without agent or rule are dropped, groups that name `*` come last.
    """
    by_line = Window.partitionBy(host).orderBy("line_no")
    directives = _directives(robots, host, body, relaxed, fetched)
    is_agent = F.col("field") == "user-agent"
    opens = (F.col("field") == "") | (is_agent & (F.coalesce(F.lag("field").over(by_line), F.lit("")) != "user-agent"))
    spans = directives.withColumn("opens", opens).withColumn("span", F.sum(F.col("opens").cast("int")).over(by_line))
    named = F.lit(relaxed) | (F.col("data") != "")
    is_rule = F.col("field").isin("allow", "disallow")
    path = F.col("data") if relaxed else unquote_path(F.col("data"))
    delay = F.when(F.col("field") == "crawl-delay", F.col("data").try_cast("double"))
    groups = spans.groupBy(host, "span").agg(
        F.array_sort(F.collect_list(F.when(is_agent & named, F.struct("line_no", "data")))).alias("agents"),
        F.array_sort(
            F.collect_list(F.when(is_rule, F.struct("line_no", F.col("field").alias("kind"), path.alias("path"))))
        ).alias("rules"),
        F.max_by(delay, F.when(delay.isNotNull(), F.col("line_no"))).alias("crawl_delay"),
    )
    groups = groups.withColumn("agents", F.transform("agents", lambda a: a["data"]))
    groups = groups.filter((F.size("agents") > 0) & (F.size("rules") > 0))
    default = F.array_contains("agents", "*")
    # The relaxed reader keeps the last of several default groups.
    span = F.when(default, -F.col("span")).otherwise(F.col("span")) if relaxed else F.col("span")
    place = F.row_number().over(Window.partitionBy(host).orderBy(default, span))
    return groups.select(host, place.alias("group_no"), "agents", "rules", "crawl_delay")


def robots_rules(groups: DataFrame, host: str = "host") -> DataFrame:
    """Flat rules: one row per group, agent and rule."""
    agents = groups.select(host, "group_no", "crawl_delay", "rules", F.explode("agents").alias("agent"))
    rules = agents.select(host, "group_no", "agent", "crawl_delay", F.posexplode("rules").alias("ord", "rule"))
    return rules.select(host, "group_no", "agent", "ord", "rule.kind", "rule.path", "crawl_delay")


def sitemaps(robots: DataFrame, host: str = "host", body: str = "body", fetched: str | None = None) -> DataFrame:
    """Sitemap urls of each robots text, in file order."""
    named = _directives(robots, host, body, relaxed=False, fetched=fetched).filter("field = 'sitemap'")
    return named.select(host, "line_no", F.col("data").alias("sitemap"))


def _names(user_agent: str, relaxed: bool) -> Column:
    """Whether a group is meant for a user agent."""
    if relaxed:
        token = F.lit(user_agent.split("/")[0].lower())
        return F.exists("agents", lambda a: (a == "*") | F.contains(token, F.substring_index(F.lower(a), "/", 1)))
    token = F.lit(user_agent.lower())
    return F.exists("agents", lambda a: (a == "*") | F.contains(token, F.lower(a)))


def _quoted(text: Column) -> Column:
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def _matcher(path: Column, floating: bool = False) -> dict[str, Column]:
    """A path whose `*` is any text, a last `$` the end and all else literal: its literal parts, and whether the last ends it.

    A floating path without a leading slash may start anywhere. `pattern` says the same for targets of several lines, which no
    `*` crosses.
    """
    ends = F.endswith(path, F.lit("$"))
    plain = F.when(ends, F.substr(path, F.lit(1), F.length(path) - 1)).otherwise(path)
    loose = ~F.startswith(path, F.lit("/")) if floating else F.lit(False)
    parts = F.split(F.when(loose, F.concat(F.lit("*"), plain)).otherwise(plain), r"\*")
    pattern = F.concat(F.lit("^"), F.array_join(F.transform(parts, _quoted), ".*"), F.when(ends, "$").otherwise(""))
    return {"parts": parts, "ends": ends, "pattern": pattern}


def _fits(target: Column, rule: Column) -> Column:
    """The parts of a rule stand in the target, one behind the other, the first at its start."""
    parts, ends, n = rule["parts"], rule["ends"], F.size(rule["parts"])
    first, last = F.get(parts, F.lit(0)), F.get(parts, n - 1)
    inner = F.filter(F.slice(parts, 2, F.greatest(F.lit(0), n - F.when(ends, 2).otherwise(1))), lambda p: p != "")

    def behind(at: Column, part: Column) -> Column:
        """Place behind the next occurrence of a part, 0 once one was not found."""
        found = F.call_function("locate", part, target, at)
        return F.when((at > 0) & (found > 0), found + F.length(part)).otherwise(0)

    reached = F.aggregate(inner, F.length(first) + 1, behind)
    closed = F.endswith(target, last) & (F.length(target) - F.length(last) + 1 >= reached)
    whole = F.when(n == 1, target == first).otherwise((reached > 0) & closed)
    one_line = F.startswith(target, first) & F.when(ends, whole).otherwise(reached > 0)
    return F.when(target.contains("\n"), F.rlike(target, rule["pattern"])).otherwise(one_line)


def _chosen(groups: DataFrame, host: str, agents: Mapping[str, str], relaxed: bool, compiled: Callable[[Column], Column]) -> DataFrame:
    """One row per host: for each agent, under its name, the matchers and the delay of the group that counts for it.

    Written once for the size check and the join.
    """
    first = [F.min_by(F.struct("rules", "crawl_delay"), F.when(_names(a, relaxed), F.col("group_no"))).alias(f"_g{i}") for i, a in enumerate(agents.values())]
    chosen = groups.groupBy(host).agg(*first)
    made = [
        F.when(g.isNotNull(), F.struct(F.transform(g["rules"], compiled).alias("rules"), g["crawl_delay"].alias("delay"))).alias(f"_of_{name}")
        for g, name in zip((F.col(f"_g{i}") for i in range(len(agents))), agents)
    ]
    return cut_lineage(chosen.select(host, *made))


def decide_for_agents(
    requests: DataFrame, groups: DataFrame, agents: Mapping[str, str], url: str = "url", host: str = "host", strict: bool = False
) -> DataFrame:
    """Add for each name of `agents` whether its user agent may ask, and `<name>_delay`.

    The first group for the agent counts, and in it the first matching rule in file order; a blank path turns its rule round.
    `strict` takes `*` and `$` literally. Without rules everything is allowed.
    """
    target = unquote_path(url_tail(F.col(url)))
    keyed = requests.withColumn(host, netloc(F.col(url))).withColumn("_target", target)

    def compiled(rule: Column) -> Column:
        more = {} if strict else _matcher(rule["path"])
        allows = (rule["kind"] == "allow") != (rule["path"] == "")
        return F.struct(allows.alias("allows"), rule["path"].alias("path"), *[c.alias(k) for k, c in more.items()])

    def hit(rule: Column) -> Column:
        return F.startswith(F.col("_target"), rule["path"]) if strict else _fits(F.col("_target"), rule)

    joined = lookup_join(keyed, _chosen(groups, host, agents, False, compiled), [host])
    added = {}
    for name in agents:
        first = F.get(F.filter(F.col(f"_of_{name}.rules"), hit), F.lit(0))
        added |= {name: F.coalesce(first["allows"], F.lit(True)), f"{name}_delay": F.col(f"_of_{name}.delay")}
    return joined.withColumns(added).drop("_target", *[f"_of_{name}" for name in agents])


def robots_decide(
    requests: DataFrame, groups: DataFrame, user_agent: str, url: str = "url", host: str = "host", strict: bool = False
) -> DataFrame:
    """Add `allowed` and `crawl_delay` for one user agent; see `decide_for_agents`."""
    decided = decide_for_agents(requests, groups, {"allowed": user_agent}, url, host, strict)
    return decided.withColumnRenamed("allowed_delay", "crawl_delay")


def _quote(path: Column) -> Column:
    plain = F.replace(F.replace(F.url_encode(path), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A"))
    return F.replace(plain, F.lit("%2F"), F.lit("/"))


def decide_relaxed_for_agents(
    requests: DataFrame, groups: DataFrame, agents: Mapping[str, str], url: str = "url", host: str = "host"
) -> DataFrame:
    """Add for each name of `agents`: any matching allow rule, else any matching disallow rule; only the path counts, in any case."""
    path = F.lower(_quote(url_path(unquote(F.col(url)))))
    keyed = requests.withColumn(host, netloc(F.col(url))).withColumn("_target", F.when(path == "", "/").otherwise(path))

    def compiled(rule: Column) -> Column:
        more = {"prefix": F.lower(_quote(rule["path"])), **_matcher(F.lower(rule["path"]), floating=True)}
        allows = (rule["kind"] == "allow") | (rule["path"] == "")
        return F.struct(allows.alias("allows"), (rule["kind"] == "disallow").alias("denies"), *[c.alias(k) for k, c in more.items()])

    def hit(rule: Column) -> Column:
        return F.startswith(F.col("_target"), rule["prefix"]) | _fits(F.col("_target"), rule)

    joined = lookup_join(keyed, _chosen(groups, host, agents, True, compiled), [host])
    added = {}
    for name in agents:
        rules = F.col(f"_of_{name}.rules")
        allows, denies = F.exists(rules, lambda r: r["allows"] & hit(r)), F.exists(rules, lambda r: r["denies"] & hit(r))
        added[name] = F.coalesce(allows | ~denies, F.lit(True))
    return joined.withColumns(added).drop("_target", *[f"_of_{name}" for name in agents])


def robots_decide_relaxed(requests: DataFrame, groups: DataFrame, user_agent: str, url: str = "url", host: str = "host") -> DataFrame:
    """Add `allowed` for one user agent; see `decide_relaxed_for_agents`."""
    return decide_relaxed_for_agents(requests, groups, {"allowed": user_agent}, url, host)


def robots_by_status(status: Column, strict: bool = True) -> Column:
    """What the status of a robots fetch decides alone: `allow`, `deny`, `error`; NULL leaves it to the rules."""
    if not strict:
        return F.when(status >= 400, "allow")
    return F.when(status.isin(401, 403), "deny").when(status == 404, "allow").when(~status.between(200, 299), "error")


def apply_robots_status(
    decided: DataFrame, fetches: DataFrame, strict: bool = True, host: str = "host", fetched: str | None = None
) -> DataFrame:
    """Let the status of the robots fetch, `fetches(host, status)`, overrule the rules; NULL after a failed fetch.

    Of several fetches of a host the one with the greatest `fetched` counts, without that column the greatest status.
    """
    status = F.max("status") if fetched is None else F.max_by("status", fetched)
    status = fetches.groupBy(host).agg(status.alias("_status"))
    joined = lookup_join(decided, status, [host])
    verdict = robots_by_status(F.col("_status"), strict)
    allowed = (
        F.when(verdict == "deny", F.lit(False))
        .when(verdict == "allow", F.lit(True))
        .when(verdict == "error", F.lit(None).cast("boolean"))
        .otherwise(F.col("allowed"))
    )
    return joined.withColumn("allowed", allowed).drop("_status")


def robots_expiry(expires: Column, fetched: Column) -> Column:
    """When a robots file gets stale: its Expires header in any http date form, else seven days after the fetch."""
    text = F.regexp_replace(strip(expires), r"^[A-Za-z]+,?\s+(?=[A-Za-z0-9])", "")
    zoned = F.when(text.rlike(r"[+-]\d{4}$"), text).otherwise(
        F.concat(F.regexp_replace(text, r"\s*(GMT|UTC|Z)$", ""), F.lit(" +0000"))
    )
    forms = ("d MMM yyyy HH:mm:ss xx", "d-MMM-yy HH:mm:ss xx", "MMM d HH:mm:ss yyyy xx")
    parsed = [F.try_to_timestamp(F.regexp_replace(zoned, r"\s+", " "), F.lit(form)) for form in forms]
    return F.coalesce(*parsed, fetched + F.expr(EXPIRY))


def is_expired(expires: Column, fetched: Column, now: Column) -> Column:
    return robots_expiry(expires, fetched) <= now
