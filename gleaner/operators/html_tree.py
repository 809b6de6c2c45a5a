"""One html page to a flat list of elements. Small helper of `elements`; runs inside an Arrow batch.

Elements are kept in document order, so the subtree of an element is the run of ids `node_id..last_id`,
and its text and html are runs of the page text and of the normalised page html.
"""

from __future__ import annotations

from hashlib import blake2b
from html import escape
from html.parser import HTMLParser

# Fixed values from the HTML standard: elements without content, and which open element a start tag ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset(("script", "style"))
BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
CELL_WALL = frozenset(("table", "td", "th", "caption", "button", "html"))
ENDS = {
    "li": (("li",), frozenset(("ul", "ol", "menu")) | CELL_WALL),
    "dt": (("dt", "dd"), frozenset(("dl",)) | CELL_WALL),
    "dd": (("dt", "dd"), frozenset(("dl",)) | CELL_WALL),
    "tr": (("tr",), frozenset(("table", "html"))),
    "td": (("td", "th"), frozenset(("tr", "table", "html"))),
    "th": (("td", "th"), frozenset(("tr", "table", "html"))),
    "thead": (("thead", "tbody", "tfoot"), frozenset(("table", "html"))),
    "tbody": (("thead", "tbody", "tfoot"), frozenset(("table", "html"))),
    "tfoot": (("thead", "tbody", "tfoot"), frozenset(("table", "html"))),
    "option": (("option",), frozenset(("select", "datalist", "html"))),
    "optgroup": (("option", "optgroup"), frozenset(("select", "html"))),
    "body": (("head",), frozenset(("html",))),
    **{tag: (("p",), CELL_WALL) for tag in BLOCKS},
}
# An end tag cannot close an element of a higher rank.
RANK = {"div": 1, "td": 2, "th": 2, "tr": 3, "thead": 4, "tbody": 4, "tfoot": 4, "table": 5, "head": 6, "body": 6, "html": 7}


class PageTree(HTMLParser):
    """Parallel lists, one entry per element; see `elements.NODE_FIELDS` for their meaning."""

    def __init__(self, page: str, signatures: bool = False):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.last, self.depth, self.ord, self.tag_ord = [], [], [], [], [], []
        self.attrs, self.texts, self.children = [], [], []
        self.text_start, self.text_len, self.html_start, self.html_chars, self.html_len = [], [], [], [], []
        self.lead: list[str | None] = []
        self.text, self.html, self.breaks = [], [], []
        self.outside: list[str] = []
        self._text_pos = self._html_pos = self._ascii_pos = 0
        self._open: list[int] = []
        self._open_tags: dict[str, int] = {}
        self._after_text = False
        self._signed = signatures
        self.feed(page)
        self.close()
        while self._open:
            self._end()

    def updatepos(self, i: int, j: int) -> int:
        """Line numbers are not needed."""
        return j

    # The whole page is fed at once, so a construct that does not end runs to the end of the page. Saying so
    # keeps the parser from trying again at every `<` inside it.

    def parse_starttag(self, i: int) -> int:
        return self._to_end(super().parse_starttag(i))

    def parse_endtag(self, i: int) -> int:
        return self._to_end(super().parse_endtag(i))

    def parse_comment(self, i: int, report: int = True) -> int:
        return self._to_end(super().parse_comment(i, report))

    def parse_html_declaration(self, i: int) -> int:
        return self._to_end(super().parse_html_declaration(i))

    def parse_pi(self, i: int) -> int:
        return self._to_end(super().parse_pi(i))

    def _to_end(self, k: int) -> int:
        return len(self.rawdata) if k < 0 else k

    def _emit(self, piece: str) -> None:
        self.html.append(piece)
        self._html_pos += len(piece)
        self._ascii_pos += len(piece) if piece.isascii() else len(piece.encode("ascii", "xmlcharrefreplace"))

    def _end(self) -> None:
        i = self._open.pop()
        self._open_tags[self.tag[i]] -= 1
        if self.tag[i] not in VOID:
            self._emit(f"</{self.tag[i]}>")
        self.last[i] = len(self.tag) - 1
        self.text_len[i] = self._text_pos - self.text_start[i]
        self.html_chars[i] = self._html_pos - self.html_start[i]
        self.html_len[i] = self._ascii_pos - self.html_len[i]
        self._after_text = False

    def _close_implied(self, tag: str) -> None:
        ended, wall = ENDS[tag]
        if not any(self._open_tags.get(name) for name in ended):
            return
        for at in range(len(self._open) - 1, -1, -1):
            name = self.tag[self._open[at]]
            if name in ended:
                while len(self._open) > at:
                    self._end()
                return
            if name in wall:
                return

    def handle_starttag(self, tag, attrs):
        if tag in ENDS:
            self._close_implied(tag)
        i, parent = len(self.tag), self._open[-1] if self._open else -1
        values: dict[str, str] = {}
        for name, value in attrs:
            values.setdefault(name, value or "")
        same = self.children[parent].get(tag, 0) if parent >= 0 else 0
        self.tag.append(tag)
        self.parent.append(parent)
        self.depth.append(len(self._open))
        self.ord.append(sum(self.children[parent].values()) if parent >= 0 else 0)
        self.tag_ord.append(same + 1)
        self.attrs.append(values)
        self.texts.append([])
        self.children.append({})
        self.lead.append(None)
        self.text_start.append(self._text_pos)
        self.html_start.append(self._html_pos)
        self.html_len.append(self._ascii_pos)
        for column in (self.last, self.text_len, self.html_chars):
            column.append(0)
        if parent >= 0:
            self.children[parent][tag] = same + 1
        inside = "".join(f' {k}="{escape(v, quote=False).replace(chr(34), "&quot;")}"' for k, v in values.items())
        self._emit(f"<{tag}{inside}>")
        self._open.append(i)
        self._open_tags[tag] = self._open_tags.get(tag, 0) + 1
        self._after_text = False
        if tag in VOID:
            self._end()

    def handle_endtag(self, tag):
        if not self._open_tags.get(tag):
            return
        rank = RANK.get(tag, 0)
        for at in range(len(self._open) - 1, -1, -1):
            name = self.tag[self._open[at]]
            if name == tag:
                while len(self._open) > at:
                    self._end()
                return
            if RANK.get(name, 0) > rank:
                return

    def handle_comment(self, data):
        self._after_text = False

    def handle_data(self, data):
        if not self._open:
            self.outside.append(data)
            return
        i = self._open[-1]
        if self._after_text:
            self.texts[i][-1] += data
        else:
            self.texts[i].append(data)
            self.breaks.append(self._text_pos)
        if not self.children[i]:
            self.lead[i] = (self.lead[i] or "") + data
        self.text.append(data)
        self._text_pos += len(data)
        self._emit(data if self.tag[i] in RAW_TEXT else escape(data, quote=False))
        self._after_text = True

    def paths(self) -> list[str]:
        out: list[str] = []
        for i, (tag, parent) in enumerate(zip(self.tag, self.parent)):
            several = parent >= 0 and self.children[parent][tag] > 1
            out.append((out[parent] if parent >= 0 else "") + f"/{tag}" + (f"[{self.tag_ord[i]}]" if several else ""))
        return out

    def signatures(self) -> list[int]:
        """64-bit hash of what makes two elements the same: tag, attributes and text before the first child."""
        return [
            int.from_bytes(blake2b(repr((t, sorted(a.items()), x)).encode(), digest_size=8).digest(), "big", signed=True)
            for t, a, x in zip(self.tag, self.attrs, self.lead)
        ]

    def roots(self) -> list[int]:
        return [i for i, parent in enumerate(self.parent) if parent < 0]


def without_elements(fragment: str, bad: frozenset[str]) -> str | None:
    """Normalised html of a fragment without the bad subtrees; None when nothing of it is left.

    A fragment of several pieces is wrapped as a page parser would: bare text in a paragraph, blocks in a
    div, anything else in a span.
    """
    tree = PageTree(fragment)
    bare = any(not piece.isspace() for piece in tree.outside)
    if not tree.tag and not bare:
        return None
    if len(tree.roots()) != 1 or bare:
        wrapper = "p" if not tree.tag else "div" if BLOCKS & set(tree.tag) else "span"
        tree = PageTree(f"<{wrapper}>{fragment}</{wrapper}>")
    if tree.tag[0] in bad:
        return None
    page, out, at, i = "".join(tree.html), [], 0, 0
    while i < len(tree.tag):
        if tree.tag[i] in bad:
            out.append(page[at : tree.html_start[i]])
            at = tree.html_start[i] + tree.html_chars[i]
            i = tree.last[i] + 1
        else:
            i += 1
    return "".join(out) + page[at:]
