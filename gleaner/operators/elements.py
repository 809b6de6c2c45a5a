"""Html pages as elements.

`parse_pages` parses each page once and keeps its elements nested in the page row. Rules, selectors and
scores then work inside the row and need no shuffle; `explode_elements` gives one row per element where a
table is wanted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators.html_tree import PageTree, without_elements

# Field of an element, its Spark type, its Arrow type.
NODE_FIELDS = {
    "node_id": ("int", pa.int32()),
    "parent_id": ("int", pa.int32()),  # -1 for a root
    "last_id": ("int", pa.int32()),  # last id of the subtree
    "depth": ("int", pa.int32()),
    "ord": ("int", pa.int32()),  # position among siblings, from 0
    "tag_ord": ("int", pa.int32()),  # position among siblings of the same tag, from 1
    "tag": ("string", pa.string()),
    "attrs": ("map<string,string>", pa.map_(pa.string(), pa.string())),
    "texts": ("array<string>", pa.list_(pa.string())),  # own text nodes
    "text_start": ("int", pa.int32()),  # run of page_text
    "text_len": ("int", pa.int32()),
    "html_start": ("int", pa.int32()),  # run of page_html
    "html_chars": ("int", pa.int32()),
    "html_len": ("int", pa.int32()),  # length of the html written in ASCII
    "path": ("string", pa.string()),
    "sig": ("bigint", pa.int64()),  # same tag, attributes and leading text
}
TREE_FIELDS = ("node_id", "parent_id", "last_id", "ord", "tag", "attrs", "texts", "text_start", "text_len")
ALL_FIELDS = tuple(f for f in NODE_FIELDS if f != "sig")
PAGE_FIELDS = {"page_text": "string", "page_html": "string", "breaks": "array<int>"}
PAGES_PER_BATCH = 200


def _columns(tree: PageTree, fields: Sequence[str]) -> dict[str, list]:
    have = {
        "node_id": range(len(tree.tag)),
        "parent_id": tree.parent,
        "last_id": tree.last,
        "depth": tree.depth,
        "ord": tree.ord,
        "tag_ord": tree.tag_ord,
        "tag": tree.tag,
        "attrs": tree.attrs,
        "texts": tree.texts,
        "text_start": tree.text_start,
        "text_len": tree.text_len,
        "html_start": tree.html_start,
        "html_chars": tree.html_chars,
        "html_len": tree.html_len,
    }
    if "path" in fields:
        have["path"] = tree.paths()
    if "sig" in fields:
        have["sig"] = tree.signatures()
    return {f: have[f] for f in fields}


def _array(field: str, values: list) -> pa.Array:
    if field == "attrs":
        values = [list(v.items()) for v in values]
    return pa.array(values, NODE_FIELDS[field][1])


def parse_pages(
    pages: DataFrame,
    html: str = "html",
    keep: Sequence[str] = ("page_id", "url"),
    fields: Sequence[str] = TREE_FIELDS,
    page_fields: Sequence[str] = ("page_text",),
) -> DataFrame:
    """Add `nodes` and the asked page fields to the kept columns.

    Nothing is pruned through a Python step, so the caller names the columns that later steps read.
    """
    source = pages.select(*keep, F.col(html).alias("_html"))
    node = ", ".join(f"{f}: {NODE_FIELDS[f][0]}" for f in fields)
    kept = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join([*kept, *(f"{p} {PAGE_FIELDS[p]}" for p in page_fields), f"nodes array<struct<{node}>>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PAGES_PER_BATCH):
                batch = whole.slice(at, PAGES_PER_BATCH)
                offsets, flat = [0], {f: [] for f in fields}
                page_values = {p: [] for p in page_fields}
                for page in batch.column("_html").to_pylist():
                    tree = PageTree(page or "")
                    for f, values in _columns(tree, fields).items():
                        flat[f].extend(values)
                    offsets.append(offsets[-1] + len(tree.tag))
                    for p in page_fields:
                        page_values[p].append(
                            tree.breaks if p == "breaks" else "".join(tree.text if p == "page_text" else tree.html)
                        )
                struct = pa.StructArray.from_arrays([_array(f, flat[f]) for f in fields], list(fields))
                columns = [batch.column(c) for c in keep]
                columns += [
                    pa.array(page_values[p], pa.list_(pa.int32()) if p == "breaks" else pa.string()) for p in page_fields
                ]
                columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct))
                yield pa.RecordBatch.from_arrays(columns, [*keep, *page_fields, "nodes"])

    return source.mapInArrow(run, schema)


def node_text(node: Column, page_text: Column | None = None) -> Column:
    """Text of the whole element."""
    text = F.col("page_text") if page_text is None else page_text
    return F.substr(text, node["text_start"] + 1, node["text_len"])


def node_html(node: Column, page_html: Column | None = None) -> Column:
    """Normalised html of the whole element."""
    html = F.col("page_html") if page_html is None else page_html
    return F.substr(html, node["html_start"] + 1, node["html_chars"])


def explode_elements(pages: DataFrame, keep: Sequence[str] = ("page_id",), skip: Sequence[str] = (), html: str = "html") -> DataFrame:
    """One row per element in document order; a skipped tag drops the element, not its descendants."""
    parsed = parse_pages(pages, html, keep, ALL_FIELDS, ("page_text", "page_html"))
    nodes = F.filter("nodes", lambda n: ~n["tag"].isin(*skip)) if skip else F.col("nodes")

    def row(n: Column) -> Column:
        return F.struct(
            *[n[f].alias(f) for f in ("node_id", "parent_id", "last_id", "depth", "ord", "tag_ord", "tag", "attrs")],
            F.array_join(n["texts"], "").alias("own_text"),
            node_text(n).alias("text"),
            node_html(n).alias("html_string"),
            n["html_len"].alias("html_len"),
            n["path"].alias("path"),
        )

    # Texts are cut inside the row, so no element row carries its page.
    return parsed.select(*keep, F.inline(F.transform(nodes, row)))


def body_text(nodes: Column | None = None, page_text: Column | None = None) -> Column:
    """Text of the body element of a parsed page, NULL without one."""
    nodes = F.col("nodes") if nodes is None else nodes
    body = F.get(F.filter(nodes, lambda n: n["tag"] == "body"), F.lit(0))
    return node_text(body, page_text)


def remove_bad_elements(values: Column, bad: Sequence[str] = ()) -> Column:
    """Drop buttons, scripts, inputs and the caller's tags with their content from html fragments.

    A fragment whose root is bad, or that holds no element and no text, is dropped. The text after a removed
    element stays.
    """
    tags = frozenset(("button", "script", "input", *bad))

    @F.arrow_udf("array<string>")
    def run(column: pa.Array) -> pa.Array:
        def clean(fragments: list[str]) -> list[str]:
            done = (without_elements(f, tags) for f in fragments if f and not f.isspace())
            return [d for d in done if d is not None]

        return pa.array([None if v is None else clean(v) for v in column.to_pylist()], pa.list_(pa.string()))

    return run(values)
