"""Rule-driven extraction: a rule spec becomes one column over a parsed page.

A rule holds sources in order of preference. Columns are lazy, so a later source costs nothing on a page
where an earlier one has hits. Nothing here joins or shuffles except the merges at the end.
"""

from __future__ import annotations

import re
import itertools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import blank_to_null, clean_value, each, let, normalized_join
from gleaner.operators.joins import lookup_join
from gleaner.operators.selectors import Page, Sel, select_nodes, take
from gleaner.session import cut_lineage

Processor = Callable[[Column], Column]  # array<string> -> array<string>
NO_VALUES = "array<string>"

# Fields whose values are joined instead of cut to the first one.
JOINED_FIELDS = (
    "description",
    "experiencerequirements",
    "qualifications",
    "requirements",
    "skills",
    "responsibilities",
    "company_description",
    "benefits",
)


@dataclass(frozen=True)
class Pick:
    """Values of selected elements; `Pick(Sel("td"), what="text()")`."""

    steps: tuple[Sel, ...]
    what: str = "text()"

    def __init__(self, *steps: Sel, what: str = "text()"):
        object.__setattr__(self, "steps", steps)
        object.__setattr__(self, "what", what)

    def nodes(self, page: Page, within: Column | None = None) -> Column:
        return select_nodes(page, *self.steps, within=within)

    def __call__(self, page: Page, within: Column | None = None) -> Column:
        return take(page, self.nodes(page, within), self.what)


@dataclass(frozen=True)
class Source:
    """Alternatives of one source, with the regex and the processors their hits go through."""

    values: Sequence = ()
    processors: Sequence[Processor] = ()
    pattern: str | None = None

    def refine(self, hits: Column) -> Column:
        if self.pattern is not None:
            hits = regex_hits(hits, self.pattern)
        return reduce(lambda acc, step: step(acc), self.processors, hits)


@dataclass(frozen=True)
class Rule:
    """Sources in order: selections, constants, the page url, a function; else the static value."""

    xpath: Sequence[Source] = ()
    value: Sequence[Source] = ()
    responseurl: Sequence[Source] = ()
    function: Callable[[Page, Column | None], Column] | None = None
    static: str | None = None


@dataclass(frozen=True)
class RuleSet:
    """How to read a list page: the job elements, the fields inside them and the fields listed beside them."""

    base: Pick
    joburl: Rule
    relative: Mapping[str, Rule] = field(default_factory=dict)
    nonrelative: Mapping[str, Rule] = field(default_factory=dict)
    formdata: Mapping[str, Rule] = field(default_factory=dict)
    dont_filter: bool = False


def regex_hits(values: Column, pattern: str) -> Column:
    """All matches of a pattern in all values: its groups in order, or the whole match without groups."""
    groups = re.compile(pattern).groups

    def hits(v: Column) -> Column:
        found = [F.regexp_extract_all(v, F.lit(pattern), F.lit(g)) for g in (range(1, groups + 1) if groups else [0])]
        if len(found) == 1:
            return found[0]
        return F.flatten(F.transform(found[0], lambda _, i: F.array(*[F.get(f, i) for f in found])))

    return F.flatten(F.transform(values, hits))


def _found(values: Column) -> Column:
    return let(values, lambda v: F.when(F.size(v) > 0, v))


def rule_alternatives(alternatives: Sequence[Column]) -> Column:
    """The first alternative with hits, with all its hits."""
    return F.coalesce(*[_found(a) for a in alternatives], F.array().cast(NO_VALUES))


def extract_rule(rule: Rule | None, page: Page, url: Column, within: Column | None = None) -> Column:
    """Values a rule finds on a page, or below one element of it; NULL when it finds none."""
    if rule is None:
        return F.lit(None).cast(NO_VALUES)
    options = [source.refine(pick(page, within)) for source in rule.xpath for pick in source.values]
    options += [source.refine(F.array(F.lit(v))) for source in rule.value for v in source.values]
    options += [source.refine(F.array(url)) for source in rule.responseurl]
    if rule.function is not None:
        options.append(rule.function(page, within))
    static = F.lit(None).cast(NO_VALUES) if rule.static is None else F.array(F.lit(rule.static))
    return F.coalesce(*[_found(o) for o in options], static)


def load_value(name: str, values: Column) -> Column:
    """One value of a field: long texts are joined, of a short field the first non-empty value is cleaned."""
    if name in JOINED_FIELDS:
        return blank_to_null(normalized_join(values))
    cleaned = F.filter(each(clean_value)(values), lambda v: v != "")
    return F.get(cleaned, F.lit(0))


def load_item(fields: Mapping[str, Column]) -> list[Column]:
    return [load_value(name, values).alias(name) for name, values in fields.items()]


def rule_cascade(pages: DataFrame, rules: Mapping[str, Rule], keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """Detail pages to items: every rule is tried on the parsed page row."""
    page, url = Page(), F.col("url")
    return pages.select(*keep, *load_item({name: extract_rule(rule, page, url) for name, rule in rules.items()}))


def positional_zip(base: Column, **lists: Column) -> Column:
    """Rows of a base list and the lists beside it by position; the shorter ones end in NULL."""
    empty = F.array().cast(NO_VALUES)
    return F.arrays_zip(base.alias("base"), *[F.coalesce(v, empty).alias(k) for k, v in lists.items()])


def _entries(pairs: Sequence[tuple[str, Column]], kind: str) -> Column:
    flat = [x for name, value in pairs for x in (F.lit(name), value)]
    return F.create_map(*flat) if flat else F.create_map().cast(f"map<string,{kind}>")


def _rows(rule_ix: int, rules: RuleSet, page: Page, url: Column) -> Column:
    """Job rows of one rule set on one page, NULL when its base does not match."""
    beside = {name: extract_rule(rule, page, url) for name, rule in rules.nonrelative.items()}
    found = F.struct(rules.base.nodes(page).alias("jobs"), *[v.alias(f"list{i}") for i, v in enumerate(beside.values())])

    def rows(lists: Column) -> Column:
        columns = {name: lists[f"list{i}"] for i, name in enumerate(beside)}
        sizes = [F.size(lists["jobs"]), *[F.coalesce(F.size(v), F.lit(0)) for v in columns.values()]]
        count = F.greatest(*sizes) if columns else sizes[0]

        def row(i: Column) -> Column:
            job = F.get(lists["jobs"], i)

            def inside(rule: Rule) -> Column:
                return F.when(job.isNotNull(), extract_rule(rule, page, url, within=job))

            carried = [(k, F.when(F.get(v, i).isNotNull(), F.array(F.get(v, i)))) for k, v in columns.items()]
            carried += [(k, inside(rule)) for k, rule in rules.relative.items()]
            form = [(k, F.get(inside(rule), F.lit(0))) for k, rule in rules.formdata.items()]
            return F.struct(
                F.lit(rule_ix).alias("rule_ix"),
                i.cast("int").alias("pos"),
                F.get(inside(rules.joburl), F.lit(0)).alias("joburl"),
                _entries(carried, "array<string>").alias("custom_items"),
                _entries(form, "string").alias("formdata"),
                F.lit(rules.dont_filter).alias("dont_filter"),
            )

        return F.when(F.size(lists["jobs"]) > 0, F.transform(F.sequence(F.lit(0), count - 1), row))

    return let(found, rows)


def job_index_rows(pages: DataFrame, rule_sets: Sequence[RuleSet], keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """One row per job element of a list page, read by the first rule set whose base matches."""
    page, url = Page(), F.col("url")
    rows = F.coalesce(*[_rows(i, rules, page, url) for i, rules in enumerate(rule_sets)])
    return pages.select(*keep, F.inline(rows))


def job_requests(index_rows: DataFrame) -> DataFrame:
    """Requests of the jobs on list pages, with absolute urls and the fields they carry."""
    from gleaner.functions.urls import url_join

    return index_rows.filter(F.col("joburl").isNotNull()).select(
        url_join(F.col("url"), F.col("joburl")).alias("url"), "formdata", "custom_items", "dont_filter"
    )


def merge_index_detail(
    detail: DataFrame, index: DataFrame, order: str, fields: Sequence[str], on: str = "url", **defaults: Column
) -> DataFrame:
    """Detail values win, the first index row of the same url fills the empty ones, then the defaults."""
    carried = cut_lineage(index.groupBy(on).agg(F.min_by(F.struct(*fields), order).alias("_index")))
    joined = lookup_join(detail, carried, [on])
    filled = {f: F.coalesce(blank_to_null(F.col(f)), blank_to_null(F.col(f"_index.{f}"))) for f in fields}
    for name, default in defaults.items():
        have = filled.get(name, blank_to_null(F.col(name)) if name in detail.columns else F.lit(None))
        filled[name] = F.coalesce(have, default)
    return joined.withColumns(filled).drop("_index")


def plan_pages(total_pages: Column | None = None, total_items: Column | None = None, per_page: Column | None = None) -> Column:
    """Numbers of the list pages after the first one."""
    pages = total_pages if total_pages is not None else F.ceil(total_items / per_page)
    return F.when(pages >= 2, F.sequence(F.lit(2), pages.cast("int"))).otherwise(F.array().cast("array<int>"))


def _along_chains(starts: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """(seed, url, depth): the starts and all urls behind them along links with one successor, at the least depth.

    `jumps[k]` leads 2**k steps ahead; missing ones are made from the one before. What is reached is doubled each round, so the
    rounds grow with the logarithm of the longest chain; a round that brings nothing new has closed every cycle.
    """
    found, known = starts, starts.count()
    for k in itertools.count():
        if k == len(jumps):
            half = jumps[-1]
            behind = half.select(F.col("src").alias("dst"), F.col("dst").alias("end"))
            jumps.append(cut_lineage(half.join(behind, "dst").select("src", F.col("end").alias("dst"))))
        ahead = found.join(jumps[k], found["url"] == jumps[k]["src"])
        ahead = ahead.select("seed", F.col("dst").alias("url"), (F.col("depth") + (1 << k)).alias("depth"))
        found = cut_lineage(found.unionByName(ahead).groupBy("seed", "url").agg(F.min("depth").alias("depth")))
        before, known = known, found.count()
        if known == before:
            return found


def follow_next(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """Urls reached from each seed over next links, with the least number of steps.

    `seeds(seed)`, `links(src, dst)` with the links whose condition holds. Links with one successor are followed by doubled
    steps; a url with several is left by all of them at once, and what is new or nearer that way is followed again. Every
    round is written to the checkpoint folder, and cycles bring nothing new, so the walk runs to its end however deep it is.
    """
    edges = cut_lineage(links.filter("src IS NOT NULL AND dst IS NOT NULL").select("src", "dst").distinct())
    ways = edges.groupBy("src").agg(F.count("*").alias("ways"))
    counted = cut_lineage(edges.join(ways, "src"))
    single, forks = counted.filter("ways = 1").select("src", "dst"), counted.filter("ways > 1").select("src", "dst")
    jumps, forked = [cut_lineage(single)], not forks.isEmpty()
    starts = cut_lineage(seeds.select("seed", F.col("seed").alias("url"), F.lit(0).alias("depth")).distinct())
    reached = None
    while True:
        found = _along_chains(starts, jumps)
        if not forked:
            return found
        new = found
        if reached is not None:
            nearer = reached.select("seed", "url", F.col("depth").alias("known"))
            new = cut_lineage(found.join(nearer, ["seed", "url"], "left").filter("known IS NULL OR depth < known").drop("known"))
            found = cut_lineage(reached.unionByName(new).groupBy("seed", "url").agg(F.min("depth").alias("depth")))
        reached = found
        left = new.join(forks, new["url"] == forks["src"]).select("seed", F.col("dst").alias("url"), (F.col("depth") + 1).alias("depth"))
        left = left.groupBy("seed", "url").agg(F.min("depth").alias("depth"))
        known = reached.select("seed", "url", F.col("depth").alias("known"))
        starts = cut_lineage(left.join(known, ["seed", "url"], "left").filter("known IS NULL OR depth < known").drop("known"))
        if starts.isEmpty():
            return reached


def two_hop_follow(links: DataFrame, responses: DataFrame, order: str, href: str = "href") -> DataFrame:
    """Pages behind links whose query is cut off; a link without a query is not followed.

    Of several responses of one url the first by `order` counts, so copies on both sides never multiply.
    """
    target = F.regexp_extract(href, r"(?s)^(.*)\?", 1)
    hops = links.filter(F.contains(F.col(href), F.lit("?"))).withColumn("url", target)
    # Pages nobody links to leave before any page is sorted or shuffled.
    wanted = lookup_join(responses, cut_lineage(hops.select("url").distinct()), ["url"], "left_semi")
    rest = [c for c in responses.columns if c != "url"]
    pages = wanted.groupBy("url").agg(F.min_by(F.struct(*rest), order).alias("_page")).select("url", "_page.*")
    return hops.join(pages, "url")


def scan_keyword_type(text: Column, keywords: Sequence[str] = ("FULL TIME", "PART TIME")) -> Column:
    """First keyword, in the given order, that the upper-cased text holds."""
    return F.coalesce(*[F.when(F.contains(F.upper(text), F.lit(k)), F.lit(k)) for k in keywords])
