"""Main text of HTML pages by wrappers: union-free regular expressions inferred for each host.

A page is a stream of block tags and runs of text, nested by its tags (``markup``).  A wrapper is
a union-free expression over such streams: a sequence of elements, groups and text slots, each of
them optional or repeated where pages differ.  Inference aligns streams two at a time:

* runs of equal neighbours, and of equal sequences of up to ``PERIOD`` items, become repeated groups;
  a sequence that one side has as a group is looked for in the other side;
* of items with equal tags those are aligned whose content is most alike, so plain ``div``s keep apart;
* text against text stays a constant if equal, else becomes a slot;
* a mismatch of tags makes what only one side has optional;
* content of more than ``MAX_ITEMS`` items becomes a repeated group of optional items, one for each
  label, which is still union-free and bounds the wrapper whatever the pages are.

Each task aligns the pages of its split into one wrapper for each host; three rounds of salted
grouping align these into one, so a host with a third of all pages costs one small wrapper a task.
The pages themselves aren't shuffled for it.  In a host's wrapper, places of menus, headers,
footers, sidebars, notices, adverts, forms and comments are known by tag, class, id or role; the
main text is the wrapper's articles, else its main element, else the element that holds most of
the host's text that varies and isn't links.  What remains of the wrapper is its boundary between main
text and the rest, a few hundred bytes, joined to the pages by host; every page is then aligned
to it and its blocks of main text are kept in page order.

Null and empty pages give an empty text.  A page without a place that the wrapper names is judged
by a wrapper of its own.  Pages without a host in their url are one host.  Repeated pages are
pages of their own (copies don't make a text constant unless all pages are copies of one).  Very long
pages are parsed whole.  Elements nested deeper than ``markup.MAX_DEPTH`` belong to the last one
counted.  An empty table gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epicentre.llm.common import slices, written
from epicentre.llm.markup import HEADINGS, OUTSIDE_TAGS, Block, Text, outside_words, parse

#: Longest sequence that is looked for as a repeated group.
PERIOD = 4
#: Items of one element's content, and labels of a group of optional items, and nodes of a wrapper.
MAX_ITEMS, MAX_LABELS, MAX_NODES = 48, 64, 3000
#: Nodes of what is joined to the pages.
MAX_BOUNDARY = 300
#: Wrappers that a task holds before it hands them on.
HELD_HOSTS, HELD_NODES = 2000, 200_000
#: Partial wrappers of a host meet in this many groups, then in fewer, then in one.
SALTS = (4096, 64, 1)

#: Share of an element's main text that one of its blocks must hold to stand for it.
MOST = 0.6
#: A list or section with at least this share of links is a menu.
MENU = 0.9
#: Least share of a host's varying text that its articles (or main elements) must hold.
ENOUGH = 0.1

#: Least likeness of neighbours that are one repeated item.
ALIKE = 0.5
GROUP, ANY, SLOT, LINKS = "()", "(*)", "#", "@"
_CONTAINERS = frozenset("html body div section main article center table tbody tr td".split())
_MENUS = frozenset("ul ol dl menu div section table nav".split())


# -- wrappers -------------------------------------------------------------------------
class Node:
    """An item of a wrapper: label, optional, repeated, content; of a slot: its texts' sizes, links and checksum."""

    __slots__ = ("label", "optional", "repeated", "kids", "chars", "linked", "same", "_shape")

    def __init__(self, label: str, kids: list[Node] | None = None, optional: bool = False, repeated: bool = False, chars: int = 0, linked: int = 0, same: int = 0):
        self.label, self.kids, self.optional, self.repeated = label, kids or [], optional, repeated
        self.chars, self.linked, self.same = chars, linked, same  # same: 0 if the texts differ
        self._shape: frozenset | None = None

    @property
    def shape(self) -> frozenset:
        """Labels of the content, and whether its text is links."""
        if self._shape is None:
            slots = list(_slots(self))
            links = sum(x.linked for x in slots) >= MENU * max(1, sum(x.chars for x in slots))
            self._shape = frozenset([x.label for x in _spread(self.kids)] + [LINKS] * links)
        return self._shape

    def packed(self) -> list:
        flags = self.optional + 2 * self.repeated
        return [SLOT, flags, self.chars, self.linked, self.same] if self.label == SLOT else [self.label, flags, [k.packed() for k in self.kids]]

    def size(self) -> int:
        return 1 + sum(k.size() for k in self.kids)


def unpacked(x: list) -> Node:
    optional, repeated = bool(x[1] & 1), bool(x[1] & 2)
    return Node(SLOT, None, optional, repeated, *x[2:]) if x[0] == SLOT else Node(x[0], [unpacked(k) for k in x[2]], optional, repeated)


def _merged(a: Node, b: Node) -> Node:
    """One item for two of the same label."""
    kids = _aligned(a.kids, b.kids) if a.kids or b.kids else []
    return Node(a.label, kids, a.optional or b.optional, a.repeated or b.repeated, a.chars + b.chars, a.linked + b.linked, a.same if a.same == b.same else 0)


def _optional(n: Node) -> Node:
    return n if n.optional else Node(n.label, n.kids, True, n.repeated, n.chars, n.linked, n.same)


def _repeat(items: list[Node]) -> Node:
    """Items of one label as one repeated item."""
    one = items[0]
    for x in items[1:]:
        one = _merged(one, x)
    return Node(one.label, one.kids, all(x.optional for x in items), True, one.chars, one.linked, one.same)


def _group_label(labels: Iterable[str]) -> str:
    return GROUP[0] + "\t".join(labels) + GROUP[1]


def likeness(label_a: str, shape_a: frozenset, label_b: str, shape_b: frozenset) -> float:
    """0 for other labels; 1 for the same one, of containers the share of their content's labels that both have."""
    if label_a != label_b:
        return 0.0
    tag, names = _tag(label_a)
    if tag not in _CONTAINERS or not (shape_a or shape_b):
        return 1.0
    shared = len(shape_a & shape_b) / len(shape_a | shape_b)
    if (LINKS in shape_a) != (LINKS in shape_b):
        shared /= 2
    return max(shared, 0.01 if names else 0.0)


def _like(a: Node, b: Node) -> float:
    if a.label != b.label or _tag(a.label)[0] not in _CONTAINERS:
        return float(a.label == b.label)
    return likeness(a.label, a.shape, b.label, b.shape)


def _sequences(items: list[Node], p: int, wanted: str | None = None) -> list[Node]:
    """Sequences of ``p`` items that repeat themselves (or that are wanted) as groups."""
    out, i, n = [], 0, len(items)

    def again(i: int, k: int) -> bool:
        return k + p <= n and all(_like(items[i + x], items[k + x]) >= ALIKE for x in range(p))

    while i < n:
        times, name = 1, _group_label(x.label for x in items[i : i + p])
        if wanted in (None, name):
            while again(i, i + times * p):
                times += 1
        if i + p <= n and (times > 1 or name == wanted):
            runs = [Node(name, items[i + k * p : i + (k + 1) * p]) for k in range(times)]
            out.append(_repeat(runs) if times > 1 else runs[0])
            i += times * p
        else:
            out.append(items[i])
            i += 1
    return out


def folded(items: list[Node]) -> list[Node]:
    """Repeated neighbours and sequences as repeated items; bounded content."""
    if any(x.label == ANY for x in items):
        return [_any(items)]
    out: list[Node] = []
    i = 0
    while i < len(items):
        k = i + 1
        while k < len(items) and _like(items[k - 1], items[k]) >= ALIKE:
            k += 1
        out.append(items[i] if k == i + 1 else _repeat(items[i:k]))
        i = k
    for p in range(2, PERIOD + 1):
        if len(out) >= 2 * p:
            out = _sequences(out, p)
    return out if len(out) <= MAX_ITEMS else [_any(out)]


def _spread(items: list[Node]) -> Iterator[Node]:
    for x in items:
        if x.label.startswith("("):
            yield from _spread(x.kids)
        else:
            yield x


def _any(items: list[Node]) -> Node:
    """A repeated group of optional items, one for each label; of tags only, if there are very many labels."""
    found: dict[str, Node] = {}
    for x in _spread(items):
        found[x.label] = _merged(found[x.label], x) if x.label in found else x
    if len(found) > MAX_LABELS:
        tags: dict[str, Node] = {}
        for x in found.values():
            tag = x.label.split(" ")[0]
            plain = Node(tag, x.kids, x.optional, x.repeated, x.chars, x.linked, x.same)
            tags[tag] = _merged(tags[tag], plain) if tag in tags else plain
        found = tags
    return Node(ANY, [Node(k, x.kids, True, True, x.chars, x.linked, x.same) for k, x in sorted(found.items())], True, True)


def matched(m: int, n: int, like) -> list[tuple[int, int]]:
    """Places of the common subsequence with the greatest sum of ``like(i, j)``, equal beginnings and ends first."""
    out, tail, i = [], [], 0
    while i < m and i < n and like(i, i) == 1:
        out.append((i, i))
        i += 1
    while m > i and n > i and like(m - 1, n - 1) == 1:
        m, n = m - 1, n - 1
        tail.append((m, n))
    if i < m and i < n:
        best = [[0.0] * (n - i + 1) for _ in range(m - i + 1)]
        pair = [[like(i + x, i + y) for y in range(n - i)] for x in range(m - i)]
        for x in range(m - i - 1, -1, -1):
            for y in range(n - i - 1, -1, -1):
                best[x][y] = max(best[x + 1][y], best[x][y + 1], best[x + 1][y + 1] + pair[x][y])
        x = y = 0
        while x < m - i and y < n - i:
            if pair[x][y] and best[x][y] == best[x + 1][y + 1] + pair[x][y]:
                out.append((i + x, i + y))
                x, y = x + 1, y + 1
            elif best[x][y] == best[x + 1][y]:
                x += 1
            else:
                y += 1
    return out + tail[::-1]


def _regrouped(a: list[Node], b: list[Node]) -> list[Node]:
    """``a`` with the sequences that ``b`` has as groups made groups."""
    for x in b:
        if x.label.startswith("(") and x.label != ANY and all(y.label != x.label for y in a):
            a = _sequences(a, len(x.kids), x.label)
    return a


def _aligned(a: list[Node], b: list[Node]) -> list[Node]:
    """The content that covers both contents."""
    if any(x.label == ANY for x in (*a, *b)):
        return [_any([*a, *b])]
    a, b = _regrouped(a, b), _regrouped(b, a)
    la, lb = [x.label for x in a], [x.label for x in b]
    if la == lb and len(set(la)) == len(la):
        return [_merged(x, y) for x, y in zip(a, b, strict=True)]
    out, i, j = [], 0, 0
    for x, y in [*matched(len(a), len(b), lambda i, j: _like(a[i], b[j])), (len(a), len(b))]:
        out += [_optional(n) for n in a[i:x]]
        out += [_optional(n) for n in b[j:y]]
        if x < len(a):
            out.append(_merged(a[x], b[y]))
        i, j = x + 1, y + 1
    return folded(out)


def _cut(n: Node, depth: int) -> Node:
    """The wrapper without what lies deeper; its texts are one slot."""
    if n.label == SLOT:
        return n
    if depth == 0 and n.kids:
        slots = list(_slots(n))
        return Node(n.label, [Node(SLOT, None, True, True, sum(s.chars for s in slots), sum(s.linked for s in slots))], n.optional, n.repeated)
    return Node(n.label, [_cut(k, depth - (not n.label.startswith("("))) for k in n.kids], n.optional, n.repeated)


def _slots(n: Node) -> Iterator[Node]:
    if n.label == SLOT:
        yield n
    for k in n.kids:
        yield from _slots(k)


def bounded(n: Node) -> Node:
    depth = 24
    while n.size() > MAX_NODES and depth:
        n, depth = _cut(n, depth), depth - 1
    return n


def wrapper_of(block: Block) -> Node:
    """The wrapper of one page."""
    kids = []
    for k in block.kids:
        if isinstance(k, Text):
            kids.append(Node(SLOT, None, False, False, len(k.text), k.linked, zlib.crc32(k.text.encode("utf-8", "surrogatepass")) or 1))
        else:
            kids.append(wrapper_of(k))
    return Node(block.label, folded(kids))


def joined(a: Node, b: Node) -> Node:
    """The wrapper that covers what two wrappers cover."""
    return bounded(_merged(a, b))


# -- which places are main text ----------------------------------------------------------
def _tag(label: str) -> tuple[str, str]:
    tag, _, names = label.partition(" ")
    return tag, names


def _is_main(label: str, tag: str) -> bool:
    t, names = _tag(label)
    return t == tag or (tag == "main" and "main" in names.split()) or (tag == "article" and "articleBody" in names.split())


@lru_cache(maxsize=1 << 14)
def _outside(label: str) -> int:
    """2 if the tag says that this isn't main text, 1 if a name does."""
    tag, names = _tag(label)
    return 2 if tag in OUTSIDE_TAGS else 1 if names and tag != "body" and outside_words(names) else 0


class _Judge:
    """Marks the places of a wrapper; ``keep`` holds the ids of the nodes whose text is main text."""

    def __init__(self, wrapper: Node):
        self.wrapper = wrapper
        self.out: set[int] = set()
        self.varies = True
        if not self._mass(wrapper):
            self.varies = False  # nothing but copies: constants are all there is
        self.total = self._mass(wrapper)
        self._mark(wrapper, False)
        self.containers = self._containers()
        self.menus = {id(n) for c in self.containers for n in self._menus(c, c)}

    def _mass(self, n: Node) -> int:
        if id(n) in self.out:
            return 0
        if n.label == SLOT:
            return max(0, n.chars - n.linked) if not (self.varies and n.same) else 0
        return sum(self._mass(k) for k in n.kids)

    def _has_main(self, n: Node) -> bool:
        return any(k.label != SLOT and (((_is_main(k.label, "article") or _is_main(k.label, "main")) and not _outside(k.label)) or self._has_main(k)) for k in n.kids)

    def _mark(self, n: Node, inside: bool) -> None:
        """``inside`` an article, a header is left its headings."""
        for k in n.kids:
            if k.label == SLOT or k.label.startswith("("):
                self._mark(k, inside)
                continue
            tag, _ = _tag(k.label)
            bad = _outside(k.label)
            if bad and self._has_main(k):
                bad = 0
            if bad == 1 and not inside and 2 * self._mass(k) > self.total:
                bad = 0  # most of the host's text: the name says something else
            if bad and inside and (tag == "header" or "header" in k.label.split()) and any(_tag(x.label)[0] in HEADINGS for x in _spread(k.kids)):
                self._only_headings(k)
            elif bad:
                self.out.add(id(k))
            else:
                self._mark(k, inside or _is_main(k.label, "article"))

    def _only_headings(self, n: Node) -> None:
        for k in n.kids:
            if k.label.startswith("("):
                self._only_headings(k)
            elif _tag(k.label)[0] not in HEADINGS:
                self.out.add(id(k))

    def _named(self, n: Node, tag: str) -> list[Node]:
        found = []
        for k in n.kids:
            if id(k) in self.out or k.label == SLOT:
                continue
            found += [k] if not k.label.startswith("(") and _is_main(k.label, tag) else self._named(k, tag)
        return found

    def _containers(self) -> list[Node]:
        held = self._mass(self.wrapper)
        for tag in ("article", "main"):
            found = self._named(self.wrapper, tag)
            if found and sum(map(self._mass, found)) >= ENOUGH * held:
                return found
        n = self.wrapper
        while True:
            blocks = [k for k in _spread(n.kids) if k.label != SLOT and id(k) not in self.out and _tag(k.label)[0] in _CONTAINERS]
            best = max(blocks, key=self._mass, default=None)
            if best is None or best.repeated or not self._mass(best) or self._mass(best) < MOST * self._mass(n):
                return [n]
            n = best

    def _menus(self, n: Node, container: Node) -> Iterator[Node]:
        for k in n.kids:
            if k.label == SLOT or id(k) in self.out:
                continue
            slots = list(_slots(k))
            if _tag(k.label)[0] in _MENUS and len(slots) and sum(s.linked for s in slots) >= MENU * max(1, sum(s.chars for s in slots)):
                yield k
            else:
                yield from self._menus(k, container)

    def boundary(self) -> list:
        """[label, repeated, kept, content, shape]: the wrapper down to where main text and the rest part.

        The shape is there where siblings have the same label.
        """
        chosen = {id(c) for c in self.containers}

        def pack(n: Node, kept: bool, twin: bool = False) -> list:
            if id(n) in self.out or id(n) in self.menus:
                kept = False
                kids = []
            else:
                kept = kept or id(n) in chosen
                labels = [k.label for k in _spread(n.kids)]
                kids = [pack(k, kept, labels.count(k.label) > 1) for k in n.kids]
            if all(k[2] == kept and not k[3] for k in kids):
                kids = []
            shape = sorted(n.shape)[:MAX_LABELS] if twin and _tag(n.label)[0] in _CONTAINERS else []
            return [n.label, int(n.repeated), int(kept), kids, shape]

        out = pack(self.wrapper, False)
        depth = 16
        while _count(out) > MAX_BOUNDARY and depth:
            out, depth = _shallow(out, depth), depth - 1
        return out


def _count(b: list) -> int:
    return 1 + sum(map(_count, b[3]))


def _shallow(b: list, depth: int) -> list:
    return [*b[:3], [_shallow(k, depth - 1) for k in b[3]], b[4]] if depth else [*b[:2], int(b[2] or any(k[2] for k in b[3])), [], b[4]]


def boundary_of(wrapper: Node) -> list:
    return _Judge(wrapper).boundary()


# -- a page against its host's wrapper --------------------------------------------------------
def _texts(block: Block) -> Iterator[str]:
    """All text but that of blocks which are known not to be main text."""
    for k in block.kids:
        if isinstance(k, Text):
            yield k.text
        elif not _outside(k.label):
            yield from _texts(k)


def _shape(k: Block | Text) -> frozenset:
    """As a wrapper's node has it."""
    if isinstance(k, Text) or k.tag not in _CONTAINERS:
        return frozenset()
    chars, linked, todo = 0, 0, [k]
    while todo:
        for x in todo.pop().kids:
            if isinstance(x, Text):
                chars, linked = chars + len(x.text), linked + x.linked
            else:
                todo.append(x)
    return frozenset([x.label for x in k.kids] + [LINKS] * (linked >= MENU * max(1, chars)))


def _places(kids: list, items: list) -> list:
    """For each of a page's items the wrapper's item that it is aligned to, or None."""
    if len(items) == 1 and items[0][0] == ANY:
        by_label = {x[0]: x for x in items[0][3]}
        return [by_label.get(k.label) or by_label.get(k.label.split(" ")[0]) for k in kids]
    flat: list = []

    def spread(xs):
        for x in xs:
            if x[0].startswith("("):
                spread(x[3])
            else:
                flat.append(x)

    spread(items)
    grouped = any(x[0].startswith("(") for x in items)
    by_label: dict[str, list] = {}
    for x in flat:
        by_label.setdefault(x[0], []).append(x)
    if grouped or all(len(x) == 1 for x in by_label.values()):  # one place for a label, or the first that a group gives it
        return [by_label[k.label][0] if k.label in by_label else None for k in kids]
    # neighbours that are alike are one item where the wrapper repeats it
    shapes = [_shape(k) for k in kids]
    places = [(x[0], frozenset(x[4])) for x in flat]
    runs: list[int] = []
    run_of = []
    for i, k in enumerate(kids):
        repeats = any(x[1] for x in by_label.get(k.label, ()))
        if not i or not repeats or likeness(k.label, shapes[i], kids[i - 1].label, shapes[i - 1]) < ALIKE:
            runs.append(i)
        run_of.append(len(runs) - 1)
    pairs = dict(matched(len(runs), len(flat), lambda r, j: likeness(kids[runs[r]].label, shapes[runs[r]], *places[j])))
    return [flat[pairs[r]] if r in pairs else (by_label.get(k.label) or [None])[0] for k, r in zip(kids, run_of, strict=True)]


def _kept(block: Block, place: list | None, kept: bool, met: list) -> Iterator[str]:
    """Texts of a page's block that its place in the wrapper keeps."""
    if place is not None:
        kept = bool(place[2])
        if kept:
            met.append(True)
        if not place[3]:
            if kept:
                yield from _texts(block)
            return
    elif not kept:
        return
    places = _places(block.kids, place[3]) if place is not None else [None] * len(block.kids)
    for k, at in zip(block.kids, places, strict=True):
        if isinstance(k, Text):
            if bool(at[2]) if at is not None else kept:
                met.append(True)
                yield k.text
        elif at is not None or not _outside(k.label):
            yield from _kept(k, at, kept, met)


def main_text(page: Block, boundary: list) -> str:
    """The page's blocks of main text, joined by empty lines."""
    met: list = []
    texts = list(_kept(page, boundary, False, met))
    if not met:  # no place of the wrapper's main text is in this page
        texts = list(_kept(page, boundary_of(wrapper_of(page)), False, met))
    return "\n\n".join(texts)


# -- the operator -----------------------------------------------------------------------------
def host_of(url: Column) -> Column:
    """The lower-cased host of a url, without user and port; empty if there is none."""
    found = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(found, F.lit(""))


_WRAPPERS = "host string, wrapper string"


def _wrapper_rows(found: dict[str, Node]) -> pa.RecordBatch:
    rows = [(h, json.dumps(w.packed(), ensure_ascii=True, separators=(",", ":"))) for h, w in found.items()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=["host", "wrapper"])


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper for each host of a split."""
    held: dict[str, Node] = {}
    nodes = 0
    for batch in slices(batches, "html"):
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            one = bounded(wrapper_of(parse(html)))
            before = held.get(host)
            held[host] = joined(before, one) if before is not None else one
            nodes += 0 if before is not None else held[host].size()
            if len(held) > HELD_HOSTS or nodes > HELD_NODES:
                yield _wrapper_rows(held)
                held, nodes = {}, 0
    if held:
        yield _wrapper_rows(held)


def _met(rows: list[str]) -> Node:
    one, *rest = [unpacked(json.loads(w)) for w in sorted(rows)]
    for w in rest:
        one = joined(one, w)
    return one


def _align_some(key: tuple, rows: pa.Table) -> pa.Table:
    return pa.Table.from_batches([_wrapper_rows({key[0].as_py(): _met(rows["wrapper"].to_pylist())})])


def _align_all(key: tuple, rows: pa.Table) -> pa.Table:
    boundary = boundary_of(_met(rows["wrapper"].to_pylist()))
    return pa.table({"host": [key[0].as_py()], "boundary": [json.dumps(boundary, separators=(",", ":"))]})


def boundaries(pages: DataFrame) -> DataFrame:
    """host, boundary: the wrapper of each host's pages (host, html), down to where main text begins and ends."""
    found = pages.select("host", "html").mapInArrow(_infer, _WRAPPERS)
    for n in SALTS[:-1]:
        salt = F.pmod(F.xxhash64("wrapper"), F.lit(n)).alias("salt")
        found = found.groupBy("host", salt).applyInArrow(_align_some, _WRAPPERS)
    return written(found.groupBy("host").applyInArrow(_align_all, "host string, boundary string"), "wrappers")


@lru_cache(maxsize=1 << 10)
def _boundary(packed: str) -> list:
    return json.loads(packed)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        pages = zip(batch.column("html").to_pylist(), batch.column("boundary").to_pylist(), strict=True)
        texts = [main_text(parse(html), _boundary(b)) if html else "" for html, b in pages]
        keep = [i for i, n in enumerate(batch.schema.names) if n not in ("html", "boundary")]
        yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], pa.array(texts, pa.string())], names=[*[batch.schema.names[i] for i in keep], "text"])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text: the main text of every page."""
    d = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    d = d.join(boundaries(d), "host").select("page_id", "url", "html", "boundary")
    kinds = {f.name: f.dataType.simpleString() for f in d.schema.fields}
    return d.mapInArrow(_extracted, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


def page_texts(pages: DataFrame) -> DataFrame:
    """op12: the main text of every page and its code points."""
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))


#: The given pages have one article each, of headings and paragraphs, with inline ``b`` and ``br`` and no other
#: blocks; their character references are those of an escaped text, some of them cut short.
PAGE_TEXTS_SQL = r"""
WITH a AS (SELECT row_number() OVER () AS rid, page_id, url,
    regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?b>', '', 'g'), '<br>', ' ', 'g') AS body FROM pages),
b AS (SELECT rid, unnest(regexp_split_to_array(body, '</?(?:h1|p)>')) AS t, generate_subscripts(regexp_split_to_array(body, '</?(?:h1|p)>'), 1) AS i FROM a),
c AS (SELECT rid, i, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(t, '&quot;', '"'), '&#x27;', chr(39)), '&lt;', '<'), '&gt;', '>'),
    '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS t FROM b),
d AS (SELECT rid, string_agg(t, chr(10) || chr(10) ORDER BY i) AS text FROM c WHERE t <> '' GROUP BY rid)
SELECT page_id, url, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars FROM a LEFT JOIN d USING (rid)
"""
