"""Main text of pages by deducing the template of each host from equivalence classes of tokens.

The tokens of a page are its elements, named by their path, and the texts of its blocks. The occurrence vector of a token says
how often it stands on each page of a host; tokens with the same vector are one class. Every class that stands on at least `SUPPORT` of
the distinct pages with elements is part of the template, so an odd page does not end it. A class on fewer pages tells an optional
part of the template where it holds a named element and texts within it: whenever the element stands, it says the same, as a notice on
some of the pages does. If the texts of such a class are half of the text of its pages, they are copies of an article and stay.
Classes nest as their paths do: an element stands wherever a token within it does. Among the classes of elements that stand once on each of their pages, the innermost
one around the text that is no menu, notice or advert holds the slots. Names of elements choose within it: an article, or what is
named like one, is taken if it holds at least half of that text, so a teaser never stands for the story beside it, and all
articles count. The texts of the template go from the pages they stand on; what is left, in page order, is the main text.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import arrow_schema, map_batches, small_batches
from gleaner.operators.joins import lookup_join
from gleaner.session import cut_lineage

#: Distinct pages on which a text stands at least to be template text; fewer pages do not tell a template from an article.
LEAST_PAGES = 5
#: Share of the distinct pages of a host that a class stands on at least.
SUPPORT = 0.5
#: Share of the text of a host that the innermost element around it must hold, where no name tells.
SHARE = 0.8
#: Path steps that name a token; deeper elements are named by their first steps.
STEPS = 40

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)""")
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""")
_NAME = re.compile(r"[a-z]+")
_RAW = frozenset("script style noscript template textarea iframe noembed noframes xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split()
)
# Elements that are never part of an article.
_ASIDE = frozenset("head title script style noscript template nav aside footer form button select textarea iframe svg object dialog menu".split())
# Whole class, id and role names that propose what is not the article.
_ASIDE_NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice
    notices notification popup modal newsletter subscribe signup sidebar widget menu nav navbar navigation breadcrumb breadcrumbs
    masthead topbar header footer comment comments disqus replies respond share sharing social related recommended pagination pager
    toolbar""".split()
)
#: Of these, names that also tell as a part of a name, and of an article element too: what is within is no part of the article
#: unless the page has no other text.
_NEVER_NAMES = frozenset(
    """ad ads advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr popup modal newsletter comment
    comments disqus replies respond""".split()
)
#: First parts of a name that turn its meaning round, as in has-sidebar or no-comments.
_TURNS = frozenset("has have no not with without is".split())
_ARTICLE_NAMES = frozenset("article main content post entry story".split())
# Start tags that end an open element of the listed kinds.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("ul ol dl table article section div body td th nav aside footer header main form".split())


def names_of(attributes: str) -> list[str]:
    """Names in the class, id and role of a start tag, in lower case."""
    out: list[str] = []
    if attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            if name.lower() in ("class", "id", "role"):
                out.extend(html.unescape(value).lower().strip("\"'").split())
    return out


class Page:
    """Elements and blocks of a page.

    `elements` counts element paths. `blocks` holds (path, text) of each block outside of what is never part of an article; a
    path ends with a slash. `named` holds the paths of the elements named as an article, by how well they tell.

    A name of `_ASIDE_NAMES` only proposes that an element is no part of the article. It goes unless the article named on the page
    is found nowhere but in it, or it holds more than half of the text of the article named, or of the page where none is; one of
    `_NEVER_NAMES` goes unless all text is in it.
    """

    def __init__(self, source: str):
        self.elements: Counter[str] = Counter()
        self.blocks: list[tuple[str, str]] = []
        self.named: dict[int, set[str]] = {}
        self._stack: list[tuple[str, str, bool, tuple[int, ...]]] = []
        self._words: list[str] = []
        self._at: tuple[str, tuple[int, ...]] = ("", ())
        self._found: list[tuple[str, str, tuple[int, ...]]] = []
        self._telling: list[tuple[int, str, tuple[int, ...]]] = []
        self._proposed: list[bool] = []
        place, n = 0, len(source)
        while place < n:
            start = source.find("<", place)
            if start < 0:
                self._text(source[place:])
                break
            if start > place:
                self._text(source[place:start])
            place = self._markup(source, start)
        self._flush()
        self._settle()

    def _settle(self) -> None:
        """Drop the blocks of the elements that are no part of the article by name."""
        total = sum(len(text) for _, text, _ in self._found)
        held = self._held(self._found)
        kept = {k for k, n in held.items() if n == total}
        never = {k for k, sure in enumerate(self._proposed) if sure} - kept
        telling = [t for t in self._telling if never.isdisjoint(t[2])]
        free = [t for t in telling if kept.issuperset(t[2])]
        if telling and not free:
            kept.update(min(telling, key=lambda t: t[0])[2])
            free = [t for t in telling if kept.issuperset(t[2])]
        best = min((rank for rank, _, _ in free), default=None)
        regions = tuple(path for rank, path, _ in free if rank == best)
        found = [b for b in self._found if never.isdisjoint(b[2])]
        within = [b for b in found if regions and b[0].startswith(regions)] or found
        total = sum(len(text) for _, text, _ in within)
        kept.update(k for k, n in self._held(within).items() if 2 * n > total)
        self.blocks = [(path, text) for path, text, proposals in found if kept.issuperset(proposals)]
        for rank, path, proposals in telling:
            if kept.issuperset(proposals):
                self.named.setdefault(rank, set()).add(path)

    @staticmethod
    def _held(blocks: list[tuple[str, str, tuple[int, ...]]]) -> Counter[int]:
        """Letters of the blocks within each proposed element."""
        held: Counter[int] = Counter()
        for _, text, proposals in blocks:
            for k in proposals:
                held[k] += len(text)
        return held

    def letters(self, regions: tuple[str, ...]) -> int:
        return sum(len(text) for path, text in self.blocks if path.startswith(regions))

    def regions(self, around: str | None) -> tuple[str, ...]:
        """The elements that hold the article: the best named ones with half of the text of the others and of `around`."""
        options = [tuple(sorted(self.named[rank])) for rank in sorted(self.named)]
        most = max([self.letters(o) for o in options], default=0)
        if around in self.elements:
            most = max(most, self.letters((around,)))
            options.append((around,))
        return next((o for o in options if 2 * self.letters(o) >= most), ("/",))

    def _text(self, text: str) -> None:
        if not (self._stack and self._stack[-1][2]):
            if not self._words:
                self._at = (self._stack[-1][1], self._stack[-1][3]) if self._stack else ("/", ())
            self._words.append(html.unescape(text))

    def _flush(self) -> None:
        if self._words:
            text = " ".join("".join(self._words).split())
            if text:
                self._found.append((self._at[0], text, self._at[1]))
            self._words = []

    def _markup(self, source: str, start: int) -> int:
        """Take the markup at `start`; the place after it."""
        if source.startswith("<!--", start):
            end = source.find("-->", start + 4)
            return len(source) if end < 0 else end + 3
        if source.startswith(("<!", "<?"), start):
            end = source.find(">", start)
            return len(source) if end < 0 else end + 1
        m = _TAG.match(source, start)
        if not m:
            self._text("<")
            return start + 1
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        tag = tag.lower()
        if tag not in _INLINE:
            self._flush_at_break()
        if closing:
            self._close(tag)
        else:
            self._open(tag, attributes)
            if tag in _RAW and not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, m.end())
                self._close(tag)
                if not end:
                    return len(source)
                close = source.find(">", end.end())
                return len(source) if close < 0 else close + 1
        return m.end()

    def _flush_at_break(self) -> None:
        if self._words:
            self._flush()

    def _open(self, tag: str, attributes: str) -> None:
        if tag not in _INLINE and tag not in _VOID:
            self._end(("p",))
            if tag in _ENDS:
                self._end(_ENDS[tag])
        whole = names_of(attributes)
        words = [set(_NAME.findall(name)) for name in whole]
        names = set().union(*words)
        above, aside, proposals = self._stack[-1][1:] if self._stack else ("/", False, ())
        inside = any(step.startswith(("article", "main")) for step in above.split("/"))
        aside = aside or tag in _ASIDE or tag == "header" and not inside
        never = _never_named(whole)
        if tag not in ("html", "body", "main") and (never or tag != "article" and not _ASIDE_NAMES.isdisjoint(whole)):
            proposals += (len(self._proposed),)
            self._proposed.append(never)
        label = ".".join([tag, *sorted(names)[:2]])
        path = above + label + "/" if above.count("/") <= STEPS else above
        self.elements[path] += 1
        if not aside:
            # A name that tells of something beside the article, as has-sidebar, tells of no article.
            tells = set().union(*[w for w in words if not w & _ASIDE_NAMES])
            rank = 0 if tag == "article" else 1 if tag == "main" or "main" in tells else 2 if tells & _ARTICLE_NAMES else 3
            if rank < 3:
                self._telling.append((rank, path, proposals))
        if tag not in _VOID and not attributes.rstrip().endswith("/"):
            self._stack.append((tag, path, aside, proposals))

    def _end(self, tags: tuple[str, ...]) -> None:
        """End the innermost open element of `tags` within its scope."""
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i][0] in tags:
                del self._stack[i:]
                return
            if self._stack[i][0] in _SCOPE:
                return

    def _close(self, tag: str) -> None:
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i][0] == tag:
                del self._stack[i:]
                return

    def text(self, around: str | None, template: frozenset[str]) -> str:
        """Texts of the slots within the article, or of the whole page where nothing tells what holds it."""
        regions = self.regions(around)
        return " ".join([t for path, t in self.blocks if path.startswith(regions) and text_token(path, t) not in template])


def _never_named(names: list[str]) -> bool:
    for name in names:
        parts = _NAME.findall(name)
        if parts and parts[0] not in _TURNS and not _NEVER_NAMES.isdisjoint(parts):
            return True
    return False


def text_token(path: str, text: str) -> str:
    return "#" + hashlib.blake2b(f"{path}\0{text}".encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


def host_of(url: Column) -> Column:
    """Host of a url, in lower case; a url without one is its own host of null."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def named_part(path: str) -> str:
    """The innermost element on a path that has a class, id or role; empty if none has."""
    end = path.rfind("/", 0, path.rfind(".") + 1) if "." in path else -1
    return path[: path.index("/", end + 1) + 1] if end >= 0 else ""


TOKENS = "host string, token string, part string, vector long, pages long, once long, chars long, around long"


def templates(pages: DataFrame) -> DataFrame:
    """(host, region, template): the path of the innermost element around the text, null if none has support, and template texts.

    Pages of a host with equal html count as one, so copies of an article do not make it a template; pages without elements do not count.
    Vectors are compared by sums of hashes of page and count, so a host is never gathered: each batch sums the vectors of its
    pages, and the shuffle adds up one row per host, token and batch.
    """
    arrow = arrow_schema(pages.sparkSession, TOKENS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, str, str], list[int]] = {}
            for host, page_id, source in zip(*[batch[c].to_pylist() for c in ("host", "page_id", "html")]):
                page = Page(source)
                if not page.elements:
                    continue
                counts = Counter(page.elements)
                chars: Counter[str] = Counter()
                parts: dict[str, str] = {}
                for path, text in page.blocks:
                    token = text_token(path, text)
                    counts[token] += 1
                    chars[token] += len(text)
                    parts[token] = named_part(path)
                    for i, c in enumerate(path):
                        if c == "/":
                            chars[path[: i + 1]] += len(text)
                # The empty token stands on every page and carries the pages of the host.
                counts[""] = 1
                around = sum(len(text) for _, text in page.blocks)
                for token, n in counts.items():
                    mark = int.from_bytes(hashlib.blake2b(f"{page_id}:{n}".encode(), digest_size=7).digest(), "little")
                    row = found.setdefault((host, token, parts.get(token, "")), [0, 0, 0, 0, 0])
                    row[0] = (row[0] + mark) & ((1 << 56) - 1)
                    row[1] += 1
                    row[2] += n == 1
                    row[3] += chars[token]
                    row[4] += around
            columns = [*zip(*found), *zip(*found.values())] if found else [[]] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)

    copies = pages.groupBy("host", F.xxhash64("html").alias("mark")).agg(F.count("*").alias("n"), F.min("page_id").alias("first")).filter("n > 1")
    marked = lookup_join(pages.withColumn("mark", F.xxhash64("html")), cut_lineage(copies.drop("n")), ["host", "mark"])
    distinct = marked.filter("first is null or page_id = first").select("host", "page_id", "html")
    sums = distinct.mapInArrow(run, TOKENS).groupBy("host", "token").agg(
        F.max("part").alias("part"),
        F.pmod(F.sum(F.col("vector") % F.lit(1 << 40)), F.lit(1 << 40)).alias("vector"),
        F.sum("pages").alias("pages"),
        F.sum("once").alias("once"),
        F.sum("chars").alias("chars"),
        F.sum("around").alias("around"),
    )
    # Texts that stand on fewer pages leave first.
    sums = cut_lineage(sums.filter("token not like '#%' or pages >= " + str(LEAST_PAGES)))
    whole = sums.filter("token = ''").select("host", F.col("pages").alias("_pages"))
    supported = F.col("pages") >= SUPPORT * F.col("_pages")
    tokens = sums.join(whole, "host").filter((F.col("token") != "") & (supported | (F.col("pages") >= LEAST_PAGES)))
    element = ~F.col("token").startswith("#")
    enough = element & supported & (F.col("once") == F.col("pages")) & (F.col("chars") >= SHARE * F.col("around"))
    best = F.struct(F.length("token").alias("length"), F.col("token").alias("path"))
    classes = tokens.groupBy("host", "vector", "pages", "_pages").agg(
        F.max(F.when(enough, best)).alias("best"),
        F.collect_list(F.when(~element, F.struct("token", "part"))).alias("texts"),
        F.collect_list(F.when(element, F.col("token"))).alias("elements"),
        (2 * F.coalesce(F.sum(F.when(~element, F.col("chars"))), F.lit(0)) < F.max("around")).alias("beside"),
    )
    texts = F.filter("texts", lambda t: supported | F.col("beside") & F.array_contains("elements", t["part"]))
    classes = classes.select("host", "best", F.transform(texts, lambda t: t["token"]).alias("texts"))
    found = classes.filter("best is not null or size(texts) > 0").groupBy("host").agg(F.max("best").alias("best"), F.flatten(F.collect_list("texts")).alias("template"))
    return found.select("host", F.col("best.path").alias("region"), "template")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row.

    Pages are read twice and never shuffled while the templates, a row per host, are small enough to be broadcast by
    measure. A null or empty html has no text, however long a html is, it is read whole, and repeated rows come out repeated. A
    null or relative url belongs to one host without a name. A page without the element around the text of its host's pages is
    read by its own article, or whole; an empty table gives no rows.
    """
    small_batches(pages.sparkSession)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    known = cut_lineage(templates(rows))

    def extract(batch: pa.RecordBatch) -> dict[str, list]:
        sets: dict[tuple, frozenset[str]] = {}
        texts = []
        for source, region, template in zip(*[batch[c].to_pylist() for c in ("html", "region", "template")]):
            key = tuple(template or ())
            texts.append(Page(source).text(region, sets.setdefault(key, frozenset(key))))
        return {"page_id": batch["page_id"], "url": batch["url"], "text": texts}

    kind = dict(pages.dtypes)["page_id"]
    return map_batches(lookup_join(rows, known, ["host"]), extract, f"page_id {kind}, url string, text string")
