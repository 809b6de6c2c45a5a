"""Element selection inside a parsed page row, as higher-order functions: no join and no shuffle."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.operators.elements import node_html, node_text


@dataclass(frozen=True)
class Page:
    """The columns of a parsed page."""

    nodes: Column = field(default_factory=lambda: F.col("nodes"))
    text: Column = field(default_factory=lambda: F.col("page_text"))
    html: Column = field(default_factory=lambda: F.col("page_html"))
    breaks: Column = field(default_factory=lambda: F.col("breaks"))


@dataclass(frozen=True)
class Sel:
    """Which elements: tag, equal attributes, attribute parts, present attributes, classes, leading text part.

    `nth` is the place among all siblings, from 1. `join` says where a step looks from the elements before it: anywhere
    below, or among children (`>`), at the next sibling (`+`) or at all later ones (`~`).
    """

    tag: str = "*"
    eq: Mapping[str, str] = field(default_factory=dict)
    has: Mapping[str, str] = field(default_factory=dict)
    present: Sequence[str] = ()
    classes: Sequence[str] = ()
    text_has: str | None = None
    starts: Mapping[str, str] = field(default_factory=dict)
    ends: Mapping[str, str] = field(default_factory=dict)
    nth: int | None = None
    join: str = " "

    def matches(self, n: Column) -> Column:
        tests = [] if self.tag == "*" else [n["tag"] == self.tag]
        tests += [n["attrs"][k] == v for k, v in self.eq.items()]
        tests += [F.contains(n["attrs"][k], F.lit(v)) for k, v in self.has.items()]
        tests += [F.startswith(n["attrs"][k], F.lit(v)) for k, v in self.starts.items()]
        tests += [F.endswith(n["attrs"][k], F.lit(v)) for k, v in self.ends.items()]
        tests += [n["attrs"][k].isNotNull() for k in self.present]
        tests += [
            F.array_contains(F.split(F.coalesce(n["attrs"]["class"], F.lit("")), r"\s+"), c) for c in self.classes
        ]
        if self.nth is not None:
            tests.append(n["ord"] == self.nth - 1)
        if self.text_has is not None:
            tests.append(F.contains(F.get(n["texts"], F.lit(0)), F.lit(self.text_has)))
        out = F.lit(True)
        for test in tests:
            out = out & F.coalesce(test, F.lit(False))
        return out


def descendants(nodes: Column, n: Column) -> Column:
    """Elements below one element: they follow it directly."""
    return F.slice(nodes, n["node_id"] + 2, n["last_id"] - n["node_id"])


def following_siblings(nodes: Column, n: Column) -> Column:
    parent_last = F.get(nodes, n["parent_id"])["last_id"]
    after = F.slice(nodes, n["last_id"] + 2, F.coalesce(parent_last - n["last_id"], F.lit(0)))
    return F.filter(after, lambda s: s["parent_id"] == n["parent_id"])


def reached(nodes: Column, n: Column, join: str) -> Column:
    """Elements a step looks at from one element."""
    if join == ">":
        return F.filter(descendants(nodes, n), lambda c: c["parent_id"] == n["node_id"])
    if join == "+":
        return F.slice(following_siblings(nodes, n), 1, 1)
    return following_siblings(nodes, n) if join == "~" else descendants(nodes, n)


def select_nodes(page: Page, *steps: Sel, within: Column | None = None) -> Column:
    """Elements of the page, or below `within`, that match the last step under matches of the earlier ones."""
    scope = page.nodes if within is None else descendants(page.nodes, within)
    found = F.filter(scope, steps[0].matches)
    for step in steps[1:]:
        below = F.flatten(F.transform(found, lambda n: F.filter(reached(page.nodes, n, step.join), step.matches)))
        found = F.array_sort(F.array_distinct(F.transform(below, lambda n: n["node_id"])))
        found = F.transform(found, lambda i: F.get(page.nodes, i))
    return found


def text_nodes(page: Page, n: Column) -> Column:
    """Every text node below an element, in document order."""
    end = n["text_start"] + n["text_len"]
    starts = F.filter(page.breaks, lambda b: (b >= n["text_start"]) & (b < end))
    return F.transform(
        starts, lambda b, i: F.substr(page.text, b + 1, F.coalesce(F.get(starts, i + 1), end) - b)
    )


def take(page: Page, nodes: Column, what: str) -> Column:
    """Values of elements: `text()`, `//text()`, `string()`, `html` or `@name`."""
    if what == "text()":
        return F.flatten(F.transform(nodes, lambda n: n["texts"]))
    if what == "//text()":
        return F.flatten(F.transform(nodes, lambda n: text_nodes(page, n)))
    if what == "string()":
        return F.transform(nodes, lambda n: node_text(n, page.text))
    if what == "html":
        return F.transform(nodes, lambda n: node_html(n, page.html))
    if what.startswith("@"):
        return F.filter(F.transform(nodes, lambda n: n["attrs"][what[1:]]), lambda v: v.isNotNull())
    raise ValueError(f"cannot take {what!r}")


def label_values(page: Page, label: Sel, value_tag: str, nth: int = 1, what: str = "text()") -> Column:
    """Values of the n-th following sibling with that tag of every label element."""
    values = F.transform(
        F.filter(page.nodes, label.matches),
        lambda n: F.get(
            F.filter(following_siblings(page.nodes, n), lambda s: s["tag"] == value_tag), F.lit(nth - 1)
        ),
    )
    return take(page, F.filter(values, lambda v: v.isNotNull()), what)


def following_rows(page: Page, row: str, marker: Sel) -> Column:
    """Rows after the first row of each parent that has a marker child."""
    parents = F.transform(F.filter(page.nodes, marker.matches), lambda n: F.get(page.nodes, n["parent_id"]))
    marked = F.filter(parents, lambda n: n["tag"] == row)
    later = F.flatten(
        F.transform(marked, lambda n: F.filter(following_siblings(page.nodes, n), lambda s: s["tag"] == row))
    )
    return F.transform(
        F.array_sort(F.array_distinct(F.transform(later, lambda n: n["node_id"]))), lambda i: F.get(page.nodes, i)
    )


def following_rows_text(page: Page, row: str, marker: Sel) -> Column:
    return F.array_join(take(page, following_rows(page, row, marker), "string()"), "")


ATTRIBUTE = r"""\[\s*([\w-]+)\s*(?:([*^$]?=)\s*("[^"]*"|'[^']*'|[^\]"'\s]*)\s*)?\]"""
PIECE = re.compile(rf"#([\w-]+)|\.([\w-]+)|{ATTRIBUTE}|:(first)-child|:nth-child\(\s*(\d+)\s*\)")
JOIN = re.compile(r"\s*([>+~,])\s*|\s+")
PARTS = {"=": "eq", "*=": "has", "^=": "starts", "$=": "ends"}


def _compound(selector: str, at: int, join: str) -> tuple[Sel, int]:
    """The step of a css selector that starts there, and where it ends."""
    tag = re.compile(r"\*|[\w-]*").match(selector, at)
    found: dict[str, dict] = {kind: {} for kind in PARTS.values()}
    present, classes, nth, end = [], [], None, tag.end()
    while piece := PIECE.match(selector, end):
        ident, name, attribute, kind, value, first, place = piece.groups()
        if ident:
            found["eq"]["id"] = ident
        elif name:
            classes.append(name)
        elif attribute and kind:
            found[PARTS[kind]][attribute] = value[1:-1] if value[:1] in ("'", '"') else value
        elif attribute:
            present.append(attribute)
        else:
            nth = 1 if first else int(place)
        end = piece.end()
    if end == at:
        raise ValueError(f"unsupported selector {selector!r}")
    return Sel(tag[0] or "*", present=present, classes=classes, nth=nth, join=join, **found), end


def css_list(selector: str) -> list[list[Sel]]:
    """Steps of every selector of a css list: tag, #id, .class, [name], [name=value] with *=, ^= and $=, :first-child and
    :nth-child(n), joined by blanks, `>`, `+` or `~`."""
    selector = selector.strip()
    step, at = _compound(selector, 0, " ")
    lists = [[step]]
    while at < len(selector):
        join = JOIN.match(selector, at)
        if join is None:
            raise ValueError(f"unsupported selector {selector!r}")
        kind = join[1] or " "
        if kind == ",":
            lists.append([])
        step, at = _compound(selector, join.end(), " " if kind == "," else kind)
        lists[-1].append(step)
    return lists


def css(selector: str) -> list[Sel]:
    """Steps of a single css selector; see `css_list`."""
    steps, *more = css_list(selector)
    if more:
        raise ValueError(f"{selector!r} is a list; use css_nodes")
    return steps


def css_nodes(page: Page, selector: str) -> Column:
    """Elements that any selector of a css list finds, in document order."""
    found = [select_nodes(page, *steps) for steps in css_list(selector)]
    if len(found) == 1:
        return found[0]
    ids = F.array_sort(F.array_distinct(F.concat(*[F.transform(nodes, lambda n: n["node_id"]) for nodes in found])))
    return F.transform(ids, lambda i: F.get(page.nodes, i))
