"""Element scores and similarity to a dictionary."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import let
from gleaner.operators.elements import node_text
from gleaner.operators.joins import fits_broadcast
from gleaner.session import cut_lineage

# Elements that never hold the description themselves; search settings of the dictionaries.
SKIPPED_TAGS = ("html", "body", "head", "script")
THRESHOLD = 0.2
LOCATION_N, TITLE_N = 3, 5


def description_score(node: Column) -> Column:
    """Text length squared by html length, NULL for a skipped or empty element."""
    usable = ~node["tag"].isin(*SKIPPED_TAGS) & (node["text_len"] > 0) & (node["html_len"] > 0)
    length = node["text_len"].cast("double")
    return F.when(usable, length * length / node["html_len"])


def best_element(score: Callable[[Column], Column] = description_score, nodes: Column | None = None) -> Column:
    """`struct<score, node>` of the element with the highest score, the first one on a tie; NULL without any."""
    nodes = F.col("nodes") if nodes is None else nodes
    scored = F.transform(nodes, lambda n: F.struct(score(n).alias("score"), (-n["node_id"]).alias("place")))
    best = F.array_max(F.filter(scored, lambda s: s["score"].isNotNull()))

    def picked(b: Column) -> Column:
        return F.when(b.isNotNull(), F.struct(b["score"].alias("score"), F.get(nodes, -b["place"]).alias("node")))

    return let(best, picked)


def grams(text: Column, n: int) -> Column:
    """Padded n-grams, each with how often it came before, as `array<struct<gram, seen>>`.

    Counting the repeats makes equal grams of two texts equal rows, so their overlap is a plain count.
    """
    pad = F.lit("$" * (n - 1))
    found = F.regexp_extract_all(F.concat(pad, text, pad), F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
    return let(
        F.array_sort(found),
        lambda ordered: F.transform(
            ordered,
            lambda g, i: F.struct(g.alias("gram"), (i + 1 - F.array_position(ordered, g)).cast("int").alias("seen")),
        ),
    )


def gram_count(text: Column, n: int) -> Column:
    return F.length(text) + (n - 1)


def _size_limits(index: GramIndex, threshold: float) -> tuple[int, int]:
    return math.floor(index.low * threshold), math.ceil(index.high / threshold) if threshold else 1 << 62


#: Products of sizes and thresholds that are whole numbers may come out a hair above them.
_HAIR = 1e-9


def prefix_size(size: Column, threshold: float) -> Column:
    """How many grams, rarest first, one of which two texts of that similarity must share."""
    return size - F.ceil(F.lit(threshold) * size - _HAIR).cast("int") + 1


def least_shared(size: Column, other: Column, threshold: float) -> Column:
    """Grams that two texts of these sizes share at least at that similarity."""
    return F.lit(threshold / (1 + threshold)) * (size + other) - _HAIR


def _tokens(text: Column, n: int) -> Column:
    return F.transform(grams(text, n), lambda g: F.concat_ws(":", g["seen"], g["gram"]))


class GramIndex:
    """A dictionary as an exact prefix-filter index, built once and written.

    Grams are ordered by how many terms hold them, rarest first. Two texts as similar as the threshold share one of the
    first grams of each (`prefix_size`), so only these are posted, each with its place; a gram that most terms hold stands
    last and is not posted by any term long enough to spare it.
    """

    def __init__(self, dictionary: DataFrame, n: int = LOCATION_N, threshold: float = THRESHOLD):
        self.n, self.threshold = n, threshold
        terms = dictionary.select("term").distinct().withColumn("_term", F.lower("term")).filter("_term IS NOT NULL")
        # Numbers stand for the terms until the last step; written, so they stay the same when a task is run again.
        terms = cut_lineage(terms.withColumn("_term_id", F.monotonically_increasing_id()))
        each = terms.select("_term_id", F.explode(_tokens(F.col("_term"), n)).alias("token"))
        self.frequency = cut_lineage(each.groupBy("token").agg(F.count("*").alias("held")))
        self.small = {"frequency": fits_broadcast(self.frequency)}
        ordered = self._ordered(each, "_term_id").withColumnRenamed("tokens", "_term_tokens")
        sized = terms.select("_term_id", "term", gram_count(F.col("_term"), n).alias("_term_size"))
        self.terms = cut_lineage(sized.join(ordered, "_term_id"))
        first = F.slice("_term_tokens", 1, prefix_size(F.col("_term_size"), threshold))
        posted = self.terms.select("_term_id", "_term_size", F.posexplode(first).alias("_term_place", "token"))
        self.postings = cut_lineage(posted)
        self.small |= {"postings": fits_broadcast(self.postings), "terms": fits_broadcast(self.terms)}
        sizes = self.terms.agg(F.min("_term_size").alias("low"), F.max("_term_size").alias("high")).first()
        self.low, self.high = sizes["low"] or 0, sizes["high"] or 0

    def _lookup(self, name: str, table: DataFrame | None = None) -> DataFrame:
        """A table of the index, or a part of it, to be broadcast if it was measured to be small."""
        table = getattr(self, name) if table is None else table
        return F.broadcast(table) if self.small[name] else table

    def _ordered(self, each: DataFrame, key: str) -> DataFrame:
        """(key, tokens): the grams that the dictionary knows, rarest first; no longer than a text."""
        known = each.join(self._lookup("frequency"), "token")
        ordered = F.array_sort(F.collect_list(F.struct("held", "token")))
        return known.groupBy(key).agg(ordered.alias("tokens")).select(key, F.col("tokens.token").alias("tokens"))

    def named(self, alike: DataFrame) -> DataFrame:
        """Matches with the term in place of its number."""
        return alike.join(self._lookup("terms", self.terms.select("_term_id", "term")), "_term_id").drop("_term_id")

    def similar_size(self, text: Column, threshold: float | None = None) -> Column:
        """Predicate: a text of this size can reach the threshold with some term at all."""
        return gram_count(text, self.n).between(*_size_limits(self, self.threshold if threshold is None else threshold))

    def keys(self, texts: DataFrame, text: str) -> DataFrame:
        """(_text_id, text, _size, tokens) of each distinct text that shares a gram with a term, written."""
        keys = texts.select(text).filter(self.similar_size(F.col(text))).distinct()
        keys = cut_lineage(keys.withColumn("_text_id", F.monotonically_increasing_id()))
        ordered = self._ordered(keys.select("_text_id", F.explode(_tokens(F.col(text), self.n)).alias("token")), "_text_id")
        return cut_lineage(keys.withColumn("_size", gram_count(F.col(text), self.n)).join(ordered, "_text_id"))

    def matches(self, keys: DataFrame, threshold: float | None = None) -> DataFrame:
        """(_text_id, _term_id, similarity) of all pairs that reach the threshold, which is not below that of the index.

        Pairs that share a posted gram are counted, and verified on all grams if these and the grams behind the last shared
        one could still reach the threshold.
        """
        threshold = self.threshold if threshold is None else threshold
        size, other, place, term_place = (F.col(c) for c in ("_size", "_term_size", "_place", "_term_place"))
        # Grams that no term holds are the rarest: they stand before the known ones and match nothing.
        unknown = size - F.size("tokens")
        first = F.slice("tokens", 1, F.greatest(F.lit(0), prefix_size(size, threshold) - unknown))
        asked = keys.filter(size.between(*_size_limits(self, threshold)))
        asked = asked.select("_text_id", "_size", unknown.alias("_unknown"), F.posexplode(first).alias("_at", "token"))
        asked = asked.select("_text_id", "_size", (F.col("_at") + F.col("_unknown")).alias("_place"), "token")
        posted = self.postings.filter(term_place < prefix_size(other, threshold))
        shared = asked.join(self._lookup("postings", posted), "token")
        near = (size >= other * threshold) & (other >= size * threshold)
        behind = F.least(size - place, other - term_place)
        possible = F.least(place, term_place) + behind >= least_shared(size, other, threshold)
        pairs = shared.filter(near & possible).groupBy("_text_id", "_term_id", "_size", "_term_size").agg(
            F.count("*").alias("_seen"), F.max("_place").alias("_place"), F.max("_term_place").alias("_term_place")
        )
        pairs = pairs.filter(F.col("_seen") + behind - 1 >= least_shared(size, other, threshold)).select("_text_id", "_term_id", "_size")
        whole = pairs.join(keys.select("_text_id", "tokens"), "_text_id")
        whole = whole.join(self._lookup("terms", self.terms.drop("term")), "_term_id")
        both = F.size(F.array_intersect("tokens", "_term_tokens"))
        similarity = both / (size + other - both)
        return whole.select("_text_id", "_term_id", similarity.alias("similarity")).filter(F.col("similarity") >= threshold)


def ngram_search(
    texts: DataFrame, ids: Sequence[str], text: str, dictionary: DataFrame | GramIndex, n: int = LOCATION_N, threshold: float = THRESHOLD
) -> DataFrame:
    """Dictionary terms similar to each text: `ids, term, similarity`, shared grams by all grams.

    Each distinct text is searched once, through a `GramIndex` of the dictionary, which may be given ready. Two texts whose
    sizes differ by more than the threshold allows cannot be similar, so long texts leave before they are cut into grams;
    neither that nor the index drops a result.
    """
    index = dictionary if isinstance(dictionary, GramIndex) else GramIndex(dictionary, n, threshold)
    asked = texts.select(*[F.col(i) for i in ids], F.lower(text).alias("_text"))
    keys = index.keys(asked, "_text")
    found = index.named(index.matches(keys)).join(keys.select("_text_id", "_text"), "_text_id").select("_text", "term", "similarity")
    return asked.join(found, "_text").select(*ids, "term", "similarity")


#: Similarities that `fuzzy_field` asks for, one after the other, before the threshold itself.
BOUNDS = (0.8, 0.6, 0.4)


def fuzzy_field(
    parsed: DataFrame, dictionary: DataFrame | GramIndex, n: int = LOCATION_N, threshold: float = THRESHOLD, page: str = "page_id"
) -> DataFrame:
    """Per page the element whose whole text is most like a dictionary term, with that term.

    `parsed` holds `nodes` and `page_text`; ties go to the first element, then to the first term. Pages repeat their labels,
    so each distinct text is searched once, and best matches come first: a page that has a match above a bound is done, as
    all its matches above that bound are known, and only the other pages are asked for less similar terms.
    """
    index = dictionary if isinstance(dictionary, GramIndex) else GramIndex(dictionary, n, threshold)
    texts = F.transform(
        "nodes", lambda e: F.struct(e["node_id"].alias("node_id"), e["tag"].alias("tag"), F.lower(node_text(e)).alias("text"))
    )
    rows = parsed.select(page, F.inline(texts)).filter(index.similar_size(F.col("text")))
    rows = cut_lineage(rows)  # read for the distinct texts and again for their elements
    keys = index.keys(rows, "text")
    rows = cut_lineage(rows.join(keys.select("text", "_text_id"), "text").drop("text"))
    done = []
    for bound in (*[b for b in BOUNDS if b > threshold], threshold):
        wanted = keys if not done else keys.join(rows.select("_text_id").distinct(), "_text_id", "left_semi")
        alike = index.named(index.matches(wanted, bound))
        top = alike.groupBy("_text_id").agg(F.min_by(F.struct("term", "similarity"), F.struct(-F.col("similarity"), "term")).alias("_top"))
        scored = rows.join(top, "_text_id").select(page, "node_id", "tag", "_top.*")
        best = F.min_by(F.struct("node_id", "tag", "term", "similarity"), F.struct(-F.col("similarity"), "node_id"))
        done.append(cut_lineage(scored.groupBy(page).agg(best.alias("_best")).select(page, "_best.*")))
        rows = cut_lineage(rows.join(done[-1].select(page), page, "left_anti"))
        if rows.isEmpty():
            break
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found
