"""Elements that all pages of a group share.

An element goes when it and everything below it is the same, at the same position, on every page of its group. One pass parses
each page and hashes its subtrees bottom-up, so one group-by per direction finds all of them, however deep the pages are, and
what goes leaves by a join: all that stands below a shared element is shared as well. Positions count children from the front
first, then from the end on what is left; only pages that have lost elements are counted and hashed again, in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.operators.html_tree import PageTree
from gleaner.operators.joins import lookup_join
from gleaner.session import cut_lineage

PAGES_PER_BATCH = 200
# Of an element: ancestors from the root down, positions from the front and from the end, hashes of itself and of its subtree.
ELEMENT = {
    "node_id": ("int", pa.int32()),
    "above": ("array<int>", pa.list_(pa.int32())),
    "tag": ("string", pa.string()),
    "path": ("string", pa.string()),
    "front": ("string", pa.string()),
    "back": ("string", pa.string()),
    "sig": ("bigint", pa.int64()),
    "print": ("bigint", pa.int64()),
}


def subtree_prints(parents: list[int], sigs: list[int]) -> list[int]:
    """Hash of every element with all that stands below it."""
    below: list[list[int]] = [[] for _ in parents]
    prints = [0] * len(parents)
    for i in range(len(parents) - 1, -1, -1):
        data = repr((sigs[i], below[i][::-1])).encode()
        prints[i] = int.from_bytes(blake2b(data, digest_size=8).digest(), "big", signed=True)
        if parents[i] >= 0:
            below[parents[i]].append(prints[i])
    return prints


def positions(parents: list[int]) -> tuple[list[str], list[str]]:
    """Position of every element, by its place among its siblings and those of its ancestors, from the front and from the end.

    A position starts with the number of its root, counted from the front in both.
    """
    place, count = [], [0] * len(parents)
    roots = 0
    for parent in parents:
        place.append(count[parent] if parent >= 0 else roots)
        if parent >= 0:
            count[parent] += 1
        else:
            roots += 1
    front, back = [], []
    for i, parent in enumerate(parents):
        front.append(f"{front[parent]}/{place[i]}" if parent >= 0 else str(place[i]))
        back.append(f"{back[parent]}/{count[parent] - 1 - place[i]}" if parent >= 0 else str(place[i]))
    return front, back


def _elements(pages: DataFrame, group: str, page: str, html: str) -> DataFrame:
    """`group, page`, a number of the page row and the columns of `ELEMENT`: one row per element, from one pass over the pages."""
    source = pages.select(group, page, F.monotonically_increasing_id().alias("_page"), F.col(html).alias("_html"))
    kinds = source.drop("_html").dtypes
    keys = [c for c, _ in kinds]
    schema = ", ".join([f"`{c}` {kind}" for c, kind in kinds] + [f"{c} {kind}" for c, (kind, _) in ELEMENT.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, PAGES_PER_BATCH):
                batch = whole.slice(start, PAGES_PER_BATCH)
                at, rows = [], {c: [] for c in ELEMENT}
                for i, text in enumerate(batch.column("_html").to_pylist()):
                    tree = PageTree(text or "")
                    sigs = tree.signatures()
                    above: list[list[int]] = []
                    for parent in tree.parent:
                        above.append([*above[parent], parent] if parent >= 0 else [])
                    front, back = positions(tree.parent)
                    columns = (range(len(sigs)), above, tree.tag, tree.paths(), front, back, sigs, subtree_prints(tree.parent, sigs))
                    for c, values in zip(ELEMENT, columns):
                        rows[c].extend(values)
                    at.extend([i] * len(sigs))
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(take) for c in keys] + [pa.array(rows[c], kind) for c, (_, kind) in ELEMENT.items()],
                    [*keys, *ELEMENT],
                )

    return source.mapInArrow(run, schema)


def _is_root() -> Column:
    return F.size("above") == 0


def _shared(rows: DataFrame, sizes: DataFrame, group: str, direction: str) -> DataFrame:
    """Positions that hold the same subtree on every page of a group of at least two pages. Roots have no position."""
    found = rows.filter(~_is_root()).groupBy(group, F.col(direction).alias("place")).agg(
        F.count("*").alias("n"), F.min("print").alias("low"), F.max("print").alias("high"), F.min("tag").alias("tag")
    )
    found = lookup_join(found.filter("low = high AND n >= 2"), sizes, [group], "inner").filter("n = n_pages")
    return found.select(group, F.lit(direction).alias("direction"), "place", "tag", "n_pages")


def _without(rows: DataFrame, shared: DataFrame, group: str, direction: str) -> DataFrame:
    """Elements at no shared position. A root's position is never in the list."""
    return rows.join(shared.select(group, F.col("place").alias(direction)), [group, direction], "left_anti").select(*rows.columns)


def _counted_again(rows: DataFrame) -> DataFrame:
    """Elements of pages that have lost some, with new positions from the end and new subtree hashes.

    An element meets its ancestors by joins and partial sums, as many rows as it has ancestors; a subtree is hashed as the set
    of its elements, each with its position in it, whose order does not matter.
    """
    siblings = Window.partitionBy("_page", F.get("above", F.size("above") - 1))
    nth = F.row_number().over(siblings.orderBy(F.when(_is_root(), F.col("node_id")).otherwise(-F.col("node_id")))) - 1
    own = cut_lineage(rows.withColumn("nth", nth))
    chain = F.concat("above", F.array("node_id"))
    steps = own.select("_page", "node_id", F.posexplode(chain).alias("level", "up"))
    steps = steps.join(own.select("_page", F.col("node_id").alias("up"), "nth"), ["_page", "up"])
    ordered = F.array_sort(F.collect_list(F.struct("level", "nth")))
    places = steps.groupBy("_page", "node_id").agg(F.array_join(F.transform(ordered, lambda s: s["nth"].cast("string")), "/").alias("back"))
    placed = cut_lineage(own.drop("back", "print", "nth").join(places, ["_page", "node_id"]))

    within = placed.select("_page", "sig", "back", F.posexplode(chain).alias("level", "up")).filter("level > 0")
    outside = F.length(F.call_function("substring_index", F.col("back"), F.lit("/"), F.col("level") + 1))
    mark = F.xxhash64(F.substr("back", outside + 1), "sig")
    prints = within.groupBy("_page", F.col("up").alias("node_id")).agg(F.xxhash64(F.bit_xor(mark), F.count("*")).alias("print"))
    return placed.join(prints, ["_page", "node_id"], "left").select(*rows.columns)


def _passes(pages: DataFrame, group: str, page: str, html: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What is left, and the shared positions of both directions."""
    # Parsed once and written: the sizes, both directions and the result read it again. A page without elements is no page.
    rows = cut_lineage(_elements(pages, group, page, html))
    sizes = cut_lineage(rows.filter("node_id = 0").groupBy(group).agg(F.count("*").alias("n_pages")))
    front = cut_lineage(_shared(rows, sizes, group, "front"))
    left = _without(rows, front, group, "front")
    changed = cut_lineage(front.select(group).distinct())
    again = _counted_again(left.join(changed, group, "left_semi").select(*rows.columns))
    left = cut_lineage(left.join(changed, group, "left_anti").select(*rows.columns).unionByName(again))
    back = cut_lineage(_shared(left, sizes, group, "back"))
    return _without(left, back, group, "back"), front, back


def remove_boilerplate(pages: DataFrame, group: str = "host", page: str = "page_id", html: str = "html") -> DataFrame:
    """Elements that are left: `group, page, node_id, tag, path`."""
    left, _, _ = _passes(pages, group, page, html)
    return left.select(group, page, "node_id", "tag", "path")


def boilerplate_elements(pages: DataFrame, group: str = "host", page: str = "page_id", html: str = "html") -> DataFrame:
    """Elements that were removed, one row per group, direction and position."""
    _, front, back = _passes(pages, group, page, html)
    return front.unionByName(back)
