"""HTML as trees of blocks: what the wrappers of ``wrapper_html`` are inferred from.

Only tags that begin or end a block make nodes; text with inline markup is one run.  The rules
follow the HTML standard where pages are commonly broken: void and raw-text elements, implied
end tags, unclosed and stray tags, comments and quoted attributes that hold ``>``.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

# The HTML standard's element classes.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text up to their end tag.
RAW_TAGS = frozenset("iframe noembed noframes script style textarea title xmp".split())
#: Never text of a page, wherever they stand.
SILENT_TAGS = frozenset("audio button canvas datalist iframe noembed noframes noscript object script select style svg template textarea title video".split())
#: Blocks that are never part of the main text.
OUTSIDE_TAGS = frozenset("aside dialog footer form head header menu nav search".split())
#: A start tag ends these open elements, up to the nearest of the second ones.
IMPLIED_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "thead", "tbody", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Words of a class, id or role that name what isn't main text.
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs captcha comment comments commentlist complementary consent contentinfo cookie cookies "
    "copyright disclaimer disqus footer gdpr header legal login masthead menu modal nav navbar navigation navi newsletter notice overlay pager pagination popup privacy promo "
    "promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar tracking "
    "widget widgets".split())

#: Deeper blocks belong to the deepest one that is counted.
MAX_DEPTH = 128

_TOKEN = re.compile(
    r"""<!--(?:.*?(?:-->|\Z)|>)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^'">])*+)>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for t in RAW_TAGS}
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")


@lru_cache(maxsize=1 << 14)
def attributes(raw: str) -> tuple[str, bool]:
    """The words of class, id and role, put in order, and whether the element is hidden."""
    names, hidden = [], False
    for name, value in _ATTRIBUTE.findall(raw):
        name, value = name.lower(), unescape(value.strip("\"'"))
        if name in ("class", "id", "role", "itemprop"):
            names += [re.sub(r"\d+", "0", w) for w in value.split()]
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            hidden = True
    return " ".join(sorted(set(names)))[:96], hidden


@lru_cache(maxsize=1 << 14)
def outside_words(names: str) -> bool:
    """Whether a class, id or role says that this isn't main text."""
    return any(w.lower() in OUTSIDE_WORDS for w in _WORDS.findall(names))


class Block:
    """A node: a label (tag and names), and in order its blocks and runs of text."""

    __slots__ = ("tag", "names", "kids")

    def __init__(self, tag: str, names: str = ""):
        self.tag, self.names, self.kids = tag, names, []

    @property
    def label(self) -> str:
        return f"{self.tag} {self.names}" if self.names else self.tag


class Text:
    """A run of text with white space turned into single spaces, and how much of it is links."""

    __slots__ = ("text", "linked")
    label = "#"

    def __init__(self, text: str, linked: int):
        self.text, self.linked = text, linked


class _Builder:
    def __init__(self):
        self.root = Block("html")
        self.open: list[Block] = [self.root]
        self.extra: dict[str, int] = {}  # open blocks past MAX_DEPTH
        self.run: list[str] = []
        self.linked, self.links = 0, 0

    def text(self, raw: str) -> None:
        piece = unescape(raw) if "&" in raw else raw
        if self.links:
            self.linked += len(piece.strip())
        self.run.append(piece)

    def flush(self) -> None:
        if self.run:
            text = " ".join("".join(self.run).split())
            if text:
                self.open[-1].kids.append(Text(text, min(self.linked, len(text))))
            self.run, self.linked = [], 0

    def start(self, tag: str, names: str) -> None:
        self.flush()
        self.links = 0
        if tag in ("html", "body") and any(b.tag == tag for b in self.open):
            return
        if tag == "hr":
            return
        if self.open[-1].tag in ("p", "head") or (tag in HEADINGS and self.open[-1].tag in HEADINGS):
            self.open.pop()
        ends, until = IMPLIED_ENDS.get(tag, ((), ()))
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in ends:
                del self.open[k:]
                break
            if self.open[k].tag in until or not ends:
                break
        if tag == "body" and len(self.open) > 1:
            del self.open[1:]
        if len(self.open) >= MAX_DEPTH:
            self.extra[tag] = self.extra.get(tag, 0) + 1
            return
        block = Block(tag, names)
        self.open[-1].kids.append(block)
        self.open.append(block)

    def end(self, tag: str) -> None:
        self.flush()
        if tag in ("html", "body"):
            return
        if self.extra.get(tag):
            self.extra[tag] -= 1
            return
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag or (tag in HEADINGS and self.open[k].tag in HEADINGS):
                del self.open[k:]
                self.links = 0
                return


def parse(html: str | None) -> Block:
    """The tree of a page's blocks; an empty one for a null or empty page."""
    html = html or ""
    b, at, silent, depth = _Builder(), 0, None, 0
    while True:
        m = _TOKEN.search(html, at)
        upto = m.start() if m else len(html)
        if upto > at and silent is None:
            b.text(html[at:upto])
        if m is None:
            break
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag, ends = tag.lower(), bool(m["end"] or m["end2"])
        if silent is not None and ends and tag in BLOCK_TAGS and silent not in BLOCK_TAGS and silent not in SILENT_TAGS and any(x.tag == tag for x in b.open):
            silent = None  # an unclosed inline element ends with its block
        if silent is not None:  # inside an element without text: wait for its end
            if tag == silent and not (m["attrs"] or m["attrs2"] or "").endswith("/"):
                depth += -1 if ends else 1
                if depth == 0:
                    silent = None
            elif tag in RAW_TAGS and not ends:
                found = _RAW_END[tag].search(html, at)
                at = found.end() if found else len(html)
            continue
        if ends:
            if tag == "br":
                b.text(" ")
            elif tag == "a":
                b.links = 0
            elif tag in BLOCK_TAGS:
                b.end(tag)
            continue
        raw = m["attrs"] if m["tag"] else m["attrs2"]
        names, hidden = attributes(raw) if raw else ("", False)
        if tag in RAW_TAGS:
            found = _RAW_END[tag].search(html, at)
            at = found.end() if found else len(html)
        elif tag == "br":
            b.text(" ")
        elif tag in VOID_TAGS and tag != "hr":
            continue
        elif tag in SILENT_TAGS or hidden or (tag not in BLOCK_TAGS and names and outside_words(names)):
            if tag in BLOCK_TAGS:
                b.flush()
            if not raw.endswith("/"):
                silent, depth = tag, 1
        elif tag in BLOCK_TAGS:
            b.start(tag, names)
        elif tag == "a":
            b.links = 1
    b.flush()
    return b.root
