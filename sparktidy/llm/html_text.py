"""Main text of web pages by wrapper induction.

Pages become trees of block elements; runs of equal siblings are one node, so a tree is as large as
the layout, not as the text.  The commonest tree of a host is its reference.  Every page of the host
is aligned with it by simple tree matching, and over all pages of the host each aligned node is
counted: texts that most pages repeat at one node are template, nodes whose text is mostly links are
menus, and the element that holds most text (``article``, ``main`` or the body) is the slot of the
content.  The wrapper so learnt is applied to each page, aligned once more: template goes, the varying
slots stay.  What elements or their class, id and role name as menu, header, footer, sidebar, notice,
advert, form or comments is never content.

Copies of a page are counted once.  A page without host, or alone on its host, goes by its own elements.
Trees are compared whole, whatever their size and depth.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Generator, Iterator, Sequence
from functools import lru_cache
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sparktidy.llm._frames import bounded
from sparktidy.llm.url_filter import host_and_path
from sparktidy.workspace import stage

NODES = math.inf  # of a tree that are numbered and compared: all
NARROW = 6000  # pairs of nodes up to which trees are matched one by one, and not by rows
CACHED = 1 << 16  # characters of two trees up to which many alignments are remembered
REMEMBERED = 1 << 21  # weights of pairs of subtrees in one alignment
REPEATED = 0.6  # of the pages of a host at a node make a text template, outside an article
REPEATED_INSIDE = 0.95  # the same within the content element, of EIGHT pages at least
LEAST, LEAST_INSIDE = 3, 8  # pages
LINKS = 0.66  # share of linked text that makes a node a menu
SLOT = 0.3  # share of the text that makes an element the content of a host

# Elements whose text stands in a line of its own (fixed values of the HTML standard).
BLOCKS = frozenset(
    """address article aside blockquote body br button caption center col colgroup dd details dialog dir div dl dt
    fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main
    menu nav noframes ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead
    title tr ul""".split()
)
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
# Elements that are never main text.
OUTSIDE = frozenset(
    """applet aside audio button canvas datalist dialog embed footer form frame frameset head iframe input map menu
    meter nav noframes noscript object optgroup option output progress script search select style svg template
    textarea title video""".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
# Words in class, id or role that name what is not main text.
NAMED = frozenset(
    """ad ads adbox adslot adsense advert adverts advertisement advertisements advertising banner banners breadcrumb
    breadcrumbs comment comments commentlist consent contentinfo cookie cookies copyright disclaimer disqus
    dropdown footer footers gdpr header headers login masthead menu menus menubar modal nav navbar navigation
    newsletter notice notices notification overlay pager pagination paywall popup promo promos promotion promotions
    related recommended recommendations replies responses share sharing sidebar sidebars signup skip social sponsor
    sponsored sponsors subscribe subscription toolbar topbar trending complementary
    announcement alert reactions respond searchbox searchform""".split()
)
OF_CONTENT = frozenset("article content entry post story".split())  # an article header is content
REMARKS = frozenset("ad ads advert advertisement comment comments promo related sponsored teaser teasers replies".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>=]*+(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')?+[^>=]*+)*+)(?:>|\Z)|([^<]++|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*+)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"']++))|(\bhidden\b)")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_NEGATED = re.compile(r"^(?:has|with|no|without|is|js)[-_]")
_PLAIN = re.compile("[;,()]")
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_IN_HEAD = frozenset("base basefont bgsound head html link meta noscript script style template title".split())
_WALL = frozenset("article aside body button caption div fieldset footer form header html main nav section table td th".split())


@lru_cache(4096)
def _named(tag: str, names: str) -> bool:
    """Whether class, id and role name an element as something other than main text."""
    if tag in ("html", "body", "main"):
        return False
    for name in names.split():
        if _NEGATED.match(name):
            continue
        words = [w.lower() for w in _WORD.findall(name)]
        if tag == "article":
            if REMARKS.intersection(words):
                return True
        elif hit := NAMED.intersection(words):
            if hit <= {"header", "headers", "banner"} and OF_CONTENT.intersection(words):
                continue
            return True
    return False


@lru_cache(4096)
def _attributes(text: str) -> tuple[str, str, bool]:
    """Names from class, id and role; the first class; whether the element is hidden or the main one."""
    names, first, hidden, main = [], "", False, False
    for key, a, b, c, bare in _ATTRIBUTE.findall(text):
        value, key = a or b or c, key.lower()
        if bare or key == "hidden":
            hidden = True
        elif key in ("class", "id", "role"):
            names.append(unescape(value))
            if key == "class" and value.split():
                first = value.split()[0]
            main |= key == "role" and value == "main"
        elif key == "itemprop":
            main |= value == "articleBody"
        elif key == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
    return " ".join(names), first, "hidden" if hidden else "main" if main else ""


class Block:
    """Text of one line: where it stands, and how much of it is linked."""

    __slots__ = ("inside", "linked", "node", "parts")

    def __init__(self, node: int, inside: str):
        self.node, self.inside, self.parts, self.linked = node, inside, [], 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


class _Element:
    """An open element; ``owner`` is the block that it belongs to, itself if it is one."""

    __slots__ = ("children", "inside", "label", "links", "node", "out", "owner", "tag")

    def __init__(self, tag: str, out: bool = False, inside: str = "", links: bool = False, owner: "_Element | None" = None, label: str = "", node: int = 0):
        self.tag, self.out, self.inside, self.links, self.children = tag, out, inside, links, []
        self.owner, self.label, self.node = owner or self, label, owner.node if owner else node


class Page:
    """The blocks of a page, and its folded tree as ``skeleton`` with the node of each block."""

    def __init__(self, html: str):
        root = _Element("")
        stack, self.blocks, self.elements = [root], [], [root]
        current: Block | None = None
        at, end = 0, len(html)
        while at < end:
            m = _TOKEN.match(html, at)
            at = m.end()
            close, tag, attributes, text = m.groups()
            if text is not None:
                top = stack[-1]
                if top.out or (current is None and text.isspace()):
                    continue
                if current is None:
                    current = Block(top.node, top.inside)
                    self.blocks.append(current)
                text = unescape(text) if "&" in text else text
                current.parts.append(text)
                if top.links:
                    current.linked += len(text.strip())
                continue
            if tag is None:  # a comment or a declaration
                continue
            tag = tag.lower()
            if tag in BLOCKS:
                current = None
            if close:
                self._close(stack, tag)
                continue
            self._imply(stack, tag)
            if tag in VOID:
                continue
            top = stack[-1]
            names, first, special = _attributes(attributes) if "=" in attributes or "hidden" in attributes else ("", "", "")
            # the header of an article holds its headline
            out = top.out or special == "hidden" or tag in OUTSIDE or (tag == "header" and not top.inside) or (names != "" and _named(tag, names))
            inside = top.inside
            if not out and inside != "article":
                inside = "article" if tag == "article" else "main" if tag == "main" or special == "main" else inside
            if tag in BLOCKS:
                label = _PLAIN.sub("_", re.sub("[0-9]+", "0", f"{tag}.{first}" if first else tag))
                element = _Element(tag, out, inside, top.links, None, label, len(self.elements))
                self.elements.append(element)
                if not top.out:
                    top.owner.children.append(element)
            else:
                element = _Element(tag, out, inside, top.links or tag == "a", top.owner)
            stack.append(element)
            if tag in RAW:
                found = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                if found or not attributes.endswith("/"):
                    at = found.start() if found else end
        self.skeleton, self.place = _fold(root)

    @staticmethod
    def _close(stack: list[_Element], tag: str) -> None:
        """An end tag; one of an inline element or a paragraph closes no container."""
        weak = tag not in BLOCKS or tag == "p"
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag == tag:
                del stack[depth:]
                return
            if weak and stack[depth].tag in _WALL:
                return

    @staticmethod
    def _imply(stack: list[_Element], tag: str) -> None:
        """End tags that a start tag implies."""
        if tag not in _IN_HEAD:
            for depth in range(1, min(4, len(stack))):
                if stack[depth].tag == "head":
                    del stack[depth:]
                    break
        if tag not in BLOCKS:
            return
        if tag in _CLOSES:
            ended, wall = _CLOSES[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in wall:
                    break
                if stack[depth].tag in ended:
                    del stack[depth:]
                    break
        elif tag not in ("br", "hr"):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    del stack[depth:]
                    break
                if stack[depth].tag in _WALL or stack[depth].tag == "li":
                    break


def _fold(root: _Element) -> tuple[str, dict[int, int]]:
    """The whole tree with runs of equal siblings as one node, in brackets, and the node of each element.

    Nodes are numbered in order from 0.
    """
    shape: dict[int, int] = {}
    known: dict[tuple[str, tuple[int, ...]], int] = {}
    order, stack = [], [root]
    while stack:
        e = stack.pop()
        order.append(e)
        stack.extend(e.children)
    for e in reversed(order):
        parts: list[int] = []
        for c in e.children:
            if not parts or parts[-1] != shape[id(c)]:
                parts.append(shape[id(c)])
        shape[id(e)] = known.setdefault((e.label, tuple(parts)), len(known))
    # number the folded tree from the top
    place: dict[int, int] = {}
    queue: deque[tuple[list[_Element], int]] = deque([([root], -1)])
    lines: list[str] = []
    while queue:
        same, parent = queue.popleft()
        number = len(lines)
        for e in same:
            place[e.node] = number
        lines.append(f"{parent}:{same[0].label}")
        runs: list[list[_Element]] = []
        # equal siblings have equal children, so runs of all of them go together
        for e in same:
            at, last = -1, None
            for c in e.children:
                if shape[id(c)] != last:
                    at, last = at + 1, shape[id(c)]
                    if at == len(runs):
                        runs.append([])
                runs[at].append(c)
        queue.extend((run, number) for run in runs)
    return ";".join(lines), place


def _children(skeleton: str) -> tuple[list[str], list[list[int]]]:
    labels, children = [], []
    for i, line in enumerate(skeleton.split(";")):
        parent, _, label = line.partition(":")
        labels.append(label)
        children.append([])
        if i:
            children[int(parent)].append(i)
    return labels, children


def align(a: str, b: str) -> tuple[int, ...]:
    """Simple tree matching: for each node of ``a`` the node of ``b`` in a largest ordered matching, or -1."""
    return (_align_small if len(a) + len(b) <= CACHED else _align_large)(a, b)


@lru_cache(512)
def _align_small(a: str, b: str) -> tuple[int, ...]:
    return _matched(a, b)


@lru_cache(16)
def _align_large(a: str, b: str) -> tuple[int, ...]:
    return _matched(a, b)


def _matched(a: str, b: str) -> tuple[int, ...]:
    if a == b:
        return tuple(range(a.count(";") + 1))
    return _match_narrow(a, b) if (a.count(";") + 1) * (b.count(";") + 1) <= NARROW else _Matching(a, b).nodes()


def _match_narrow(a: str, b: str) -> tuple[int, ...]:
    """The matching of small trees."""
    (la, ca), (lb, cb) = _children(a), _children(b)
    weight: dict[tuple[int, int], int] = {}

    def table(i: int, j: int) -> list[list[int]]:
        rows = [[0] * (len(cb[j]) + 1)]
        for x in ca[i]:
            row = [0]
            for k, y in enumerate(cb[j]):
                row.append(max(row[k], rows[-1][k + 1], rows[-1][k] + match(x, y)))
            rows.append(row)
        return rows

    def match(i: int, j: int) -> int:
        if la[i] != lb[j]:
            return 0
        if (i, j) not in weight:
            weight[i, j] = 1 + table(i, j)[-1][-1]
        return weight[i, j]

    out = [-1] * len(la)
    todo = [(0, 0)]
    while todo:
        i, j = todo.pop()
        if la[i] != lb[j]:
            continue
        out[i] = j
        rows, x, y = table(i, j), len(ca[i]), len(cb[j])
        while x and y:
            if rows[x][y] == rows[x - 1][y]:
                x -= 1
            elif rows[x][y] == rows[x][y - 1]:
                y -= 1
            else:
                x, y = x - 1, y - 1
                todo.append((ca[i][x], cb[j][y]))
    return tuple(out)


class _Matching:
    """The same matching for trees of any size and depth, a subtree of one against many of the other at a time.

    Equal subtrees of both trees are one shape.  The weight of two shapes is the size of the largest
    matching with both roots.  Tables of children are taken row by row, and for the way back through a
    table only each so many rows are kept.
    """

    def __init__(self, a: str, b: str):
        known: dict[tuple[str, tuple[int, ...]], int] = {}
        names: dict[str, int] = {}
        labels, sizes, kids = [], [], []
        self.children, self.shape = [], []
        for skeleton in (a, b):
            own, children = _children(skeleton)
            shape = [0] * len(own)
            for i in range(len(own) - 1, -1, -1):  # children have larger numbers
                key = own[i], tuple(shape[c] for c in children[i])
                if (s := known.setdefault(key, len(known))) == len(labels):
                    labels.append(names.setdefault(own[i], len(names)))
                    sizes.append(1 + sum(sizes[c] for c in key[1]))
                    kids.append(key[1])
                shape[i] = s
            self.children.append(children)
            self.shape.append(np.array(shape))
        self.kids, self.label, self.size = kids, np.array(labels), np.array(sizes)
        self.count = np.array([len(k) for k in kids])
        self.first = np.cumsum(self.count) - self.count
        self.flat = np.array([c for k in kids for c in k], np.int64)
        self.memo: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.room = REMEMBERED

    def weights(self, u: int, others: np.ndarray) -> Generator:
        """Of shape ``u`` with each of the ascending ``others``; a step of :func:`_finish`."""
        out = (self.label[others] == self.label[u]).astype(np.int64)
        unlike = others != u
        out[~unlike] = self.size[u]
        if not self.kids[u]:
            return out
        deeper = np.flatnonzero((out > 0) & unlike & (self.count[others] > 0))
        if u in self.memo and len(deeper):
            seen, value = self.memo[u]
            at = np.minimum(np.searchsorted(seen, others[deeper]), len(seen) - 1)
            hit = seen[at] == others[deeper]
            out[deeper[hit]] = value[at[hit]]
            deeper = deeper[~hit]
        if not len(deeper):
            return out
        shapes = others[deeper]
        count = self.count[shapes]
        begin = np.cumsum(count) - count
        inner, where = np.unique(self.flat[np.arange(int(count.sum())) + np.repeat(self.first[shapes] - begin, count)], return_inverse=True)
        # shapes with about as many children share a table; a child that is not there has no weight
        groups = []
        for bits in np.unique(wide := np.frexp(count)[1]):
            rows = np.flatnonzero(wide == bits)
            column = np.arange(int(count[rows].max()))
            at = np.where(column < count[rows, None], where[np.minimum(begin[rows, None] + column, len(where) - 1)], len(inner))
            groups.append((rows, at, np.zeros((len(rows), len(column) + 1), np.int64)))
        for child in self.kids[u]:
            weight = np.append((yield self.weights(child, inner)), 0)
            for _, at, row in groups:
                _next_row(row, weight[at])
        total = np.empty(len(shapes), np.int64)
        for rows, _, row in groups:
            total[rows] = 1 + row[:, -1]
        out[deeper] = total
        if len(shapes) <= self.room:
            self.room -= len(shapes)
            if u in self.memo:
                shapes, total = np.append(self.memo[u][0], shapes), np.append(self.memo[u][1], total)
                order = np.argsort(shapes)
                shapes, total = shapes[order], total[order]
            self.memo[u] = shapes, total
        return out

    def _pairs(self, i: int, j: int) -> Iterator[tuple[int, int]]:
        """The matched children of two matched nodes, from the last."""
        (xs, ys), (a, b) = (self.children[0][i], self.children[1][j]), self.shape
        if a[i] == b[j]:
            yield from zip(xs, ys)
            return
        inner, where = np.unique(b[ys], return_inverse=True)

        def following(row: np.ndarray, x: int, columns: int) -> np.ndarray:
            row = row[: columns + 1].copy()
            _next_row(row[None], _finish(self.weights(int(a[xs[x]]), inner))[where[:columns]][None])
            return row

        step = math.isqrt(len(xs)) + 1
        row, kept = np.zeros(len(ys) + 1, np.int64), []
        for x in range(len(xs)):
            if x % step == 0:
                kept.append(row)
            row = following(row, x, len(ys))
        x, y = len(xs), len(ys)
        while x and y:
            start = (x - 1) // step * step
            rows = [kept[start // step]]
            for k in range(start, x):
                rows.append(following(rows[-1], k, y))
            while x > start and y:
                this, above = rows[x - start], rows[x - start - 1]
                if this[y] == above[y]:
                    x -= 1
                elif this[y] == this[y - 1]:
                    y -= 1
                else:
                    x, y = x - 1, y - 1
                    yield xs[x], ys[y]

    def nodes(self) -> tuple[int, ...]:
        out = [-1] * len(self.children[0])
        todo = [(0, 0)] if self.label[self.shape[0][0]] == self.label[self.shape[1][0]] else []
        while todo:
            i, j = todo.pop()
            out[i] = j
            if self.children[0][i] and self.children[1][j]:
                todo.extend(self._pairs(i, j))
        return tuple(out)


def _next_row(row: np.ndarray, weight: np.ndarray) -> None:
    """The next row of tables of largest matchings, in place."""
    np.maximum(row[:, 1:], row[:, :-1] + weight, out=row[:, 1:])
    np.maximum.accumulate(row, axis=1, out=row)


def _finish(steps: Generator):
    """The result of steps that wait for the results of others, however deep."""
    stack, value = [steps], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as done:
            stack.pop()
            value = done.value
    return value


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


_PARSED = pa.schema(
    [("host", pa.string()), ("skeleton", pa.string()), ("digest", pa.int64())]
    + [("blocks", pa.list_(pa.struct([("node", pa.int32()), ("hash", pa.int64()), ("chars", pa.int32()), ("linked", pa.int32()), ("inside", pa.string())])))]
)
_PARSED_DDL = "host string, skeleton string, digest bigint, blocks array<struct<node:int,hash:bigint,chars:int,linked:int,inside:string>>"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            page, blocks, digest = Page(html or ""), [], 0
            for b in page.blocks:
                if text := b.text:
                    h = _hash(text)
                    digest = (digest * 1_000_003 + h) % (1 << 62)
                    blocks.append({"node": page.place.get(b.node, -1), "hash": h, "chars": len(text), "linked": min(b.linked, len(text)), "inside": b.inside})
            rows.append({"host": host, "skeleton": page.skeleton, "digest": digest, "blocks": blocks})
        yield pa.RecordBatch.from_pylist(rows, _PARSED)


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the nodes of the reference in place of their own."""
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            to = align(row["skeleton"], row.pop("reference"))
            for b in row["blocks"]:
                b["node"] = to[b["node"]] if b["node"] >= 0 else -1
            row["skeleton"] = ""
        yield pa.RecordBatch.from_pylist(rows, _PARSED)


def induce(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(host, reference, slot, template, menus)``: one wrapper per host with at least two unlike pages."""
    host, _ = host_and_path(F.col(url).cast("string"))
    parsed = pages.select(host.alias("host"), F.col(html).cast("string").alias("html")).filter("host <> ''").mapInArrow(_describe, _PARSED_DDL)
    parsed = stage(parsed.dropDuplicates(["host", "skeleton", "digest"]), "pages")
    trees = parsed.groupBy("host", "skeleton").agg(F.count(F.lit(1)).alias("n"))
    # the commonest tree, the first of equal ones
    best = F.min(F.struct((-F.col("n")).alias("less"), "skeleton"))
    hosts = trees.groupBy("host").agg(best.alias("best"), F.sum("n").alias("pages")).filter("pages > 1")
    hosts = stage(hosts.select("host", F.col("best.skeleton").alias("reference"), "pages"), "references")
    aligned = parsed.join(bounded(hosts.select("host", "reference")), "host").mapInArrow(_aligned, _PARSED_DDL)
    blocks = stage(aligned.select("host", F.explode("blocks").alias("b")).select("host", "b.*"), "aligned")

    slots = blocks.groupBy("host").agg(*[F.sum(F.when(F.col("inside") == i, F.col("chars")).otherwise(0)).alias(i) for i in ("article", "main")], F.sum("chars").alias("chars"))
    enough = lambda i: F.col(i) >= SLOT * F.col("chars")
    slots = slots.select("host", F.when(enough("article"), "article").when(F.col("article") + F.col("main") >= SLOT * F.col("chars"), "main").otherwise("body").alias("slot"))
    known = blocks.filter("node >= 0")
    menus = known.groupBy("host", "node").agg(F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), F.max(F.col("inside") != "").alias("inside"))
    menus = menus.filter((F.col("linked") >= LINKS * F.col("chars")) & ~F.col("inside")).groupBy("host").agg(F.sort_array(F.collect_set("node")).alias("menus"))
    repeated = known.groupBy("host", "node", "hash").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("inside") != "").alias("inside"))
    repeated = repeated.filter(f"n >= {LEAST}").join(bounded(hosts.select("host", "pages")), "host")
    often = F.when(F.col("inside"), (F.col("n") >= REPEATED_INSIDE * F.col("pages")) & (F.col("n") >= LEAST_INSIDE)).otherwise(F.col("n") >= REPEATED * F.col("pages"))
    # a share of the pages at least, so not more than a few average pages hold
    template = repeated.filter(often).groupBy("host").agg(F.sort_array(F.collect_list(F.struct("node", "hash"))).alias("template"))
    out = hosts.select("host", "reference").join(slots, "host").join(template, "host", "left").join(menus, "host", "left")
    return stage(out, "wrappers")


def page_text(html: str, wrapper: dict | None) -> str:
    """The main text of one page under the wrapper of its host."""
    page = Page(html)
    slot, drop, menus, to = "", frozenset(), frozenset(), ()
    if wrapper:
        slot, to = wrapper["slot"], align(page.skeleton, wrapper["reference"])
        drop, menus = wrapper["drop"], wrapper["menus"]
    else:
        insides = {e.inside for e in page.elements}
        slot = "article" if "article" in insides else "main" if "main" in insides else "body"
    allowed = {"article": ("article",), "main": ("article", "main")}.get(slot)
    if allowed and not any(e.inside in allowed for e in page.elements):
        allowed = None  # a page of another make
    out = []
    for b in page.blocks:
        if (allowed and b.inside not in allowed) or not (text := b.text):
            continue
        own = page.place.get(b.node, -1)
        node = to[own] if to and own >= 0 else -1
        if node >= 0 and ((node in menus and not b.inside) or (drop and (node, _hash(text)) in drop)):
            continue
        out.append(text)
    return " ".join(out)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ready: dict[str, dict] = {}
    for batch in batches:
        texts = []
        for html, host, wrapper in zip(*[batch.column(c) for c in ("html", "host", "wrapper")]):
            own = None
            if wrapper.is_valid:
                if (own := ready.get(host.as_py())) is None:
                    if len(ready) > 256:
                        ready.clear()
                    raw = wrapper.as_py()
                    own = ready[host.as_py()] = {"slot": raw["slot"], "reference": raw["reference"], "drop": frozenset((t["node"], t["hash"]) for t in raw["template"] or ()), "menus": frozenset(raw["menus"] or ())}
            texts.append(page_text(html.as_py() or "", own))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])


def extract_text(pages: DataFrame, url: str = "url", html: str = "html", keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """``keep`` with ``text`` and ``n_chars`` (code points) of every page, whole.

    A null or empty page has an empty text, a null URL no host and so no wrapper; repeated rows each
    come out.  White space within a line becomes one space, lines are joined by one.  Other columns are
    left out; those of ``keep`` may not be named like the results.
    """
    if clash := {c.lower() for c in keep} & {"text", "n_chars"}:
        raise ValueError(f"columns named like results: {sorted(clash)}")
    wrappers = induce(pages, url, html)
    host, _ = host_and_path(F.col(url).cast("string"))
    rows = pages.select(F.struct(*keep).alias("row"), F.col(html).cast("string").alias("html"), host.alias("host"))
    packed = wrappers.select("host", F.struct("reference", "slot", "template", "menus").alias("wrapper"))
    joined = rows.join(bounded(packed), "host", "left").select("row", "html", "host", "wrapper")
    texts = joined.mapInArrow(_extract, StructType([rows.schema["row"], StructField("text", StringType())]))
    return texts.select("row.*", "text", F.length("text").cast("bigint").alias("n_chars"))
