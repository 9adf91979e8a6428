"""HTML extraction by layout-aware rendering.

A scanner cuts a page into tags and text, a tree builder adds the tags that the page implies (cells
end cells, items end items, a block ends a paragraph, a cell makes its row), and the renderer walks
the tree: visibility rules leave out what a reader does not see, blocks stand on lines of their own
with a blank line where their margins ask for one, lists have bullets or numbers and are indented, and
the cells of a table are aligned in columns.

Scale: one narrow pass over the pages, nothing shuffled; memory is one page's tree.  Builder and
renderer keep stacks of their own, so nesting depth has no limit.  The scanner reads a page once, also
where quotes and tags are left open: what it has looked for in vain it does not look for again.  The builder knows where
the open elements of each tag stand, so an end tag costs the same however many others are open.

Defined cases: null html counts as empty; unclosed tags end with the page, stray end tags are ignored;
a "<" that begins no tag is text, and so is a tag that no ">" ends; a quote that is not closed within a tag
is a letter; a head without end tag ends at the first text or element that cannot stand
in it; what stands in a row beside its cells comes before the table; text of math and svg and all options are shown; pages of any length are rendered whole; repeated rows each get a row.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict, deque
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose content is text up to their own end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that are never shown.
UNSEEN = frozenset("head title script style template noscript iframe noembed noframes object audio video canvas datalist meta link base".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table ul caption tr td th thead tbody tfoot option optgroup".split())
#: Never shown within svg and math, whose other text is.
FOREIGN_UNSEEN = frozenset("desc metadata defs symbol annotation annotation-xml".split())
#: What can stand in a head; anything else ends it.
IN_HEAD = frozenset("html head title style script meta link base noscript template noframes basefont bgsound".split())
#: Blocks with a blank line above and below.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl table blockquote pre figure fieldset".split())
ENDS_P = BLOCK - frozenset("body html td th tr thead tbody tfoot caption option optgroup".split())
#: An opening tag first ends the open elements named, but not beyond the fence.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
_NAME = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)", re.DOTALL)
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_HIDES = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.IGNORECASE)
_BLANK = re.compile(r"[ \t\n\r\f]+")
BREAK = object()


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.kids = tag, attrs, []


def _attributes(s: str) -> dict[str, str]:
    if not s or s.isspace() or s == "/":
        return {}
    out: dict[str, str] = {}
    for name, value in _ATTR.findall(s):
        out.setdefault(name.lower(), unescape(value[1:-1] if value[:1] in "\"'" and value else value))
    return out


class TagEnds:
    """Where tags end, found in one pass over a page whatever it leaves open.

    A ">" within quotes does not end a tag.  A quote that is never closed counts as a letter.  If no ">"
    outside quotes follows a tag, quotes count as letters from there on, and if none follows at all the
    tag is text; each is remembered, so that no later tag looks again.
    """

    def __init__(self, html: str):
        self.html, self.quotes, self.last = html, {'"', "'"}, html.rfind(">")

    def find(self, at: int) -> int:
        """The place of the ">" of a tag whose name ends at at, or -1."""
        if at > self.last:
            return -1
        first = at
        while self.quotes:
            m = _STOP.search(self.html, at)
            if m is None:
                self.quotes.clear()
                break
            if m[0] == ">":
                return m.start()
            at = m.end()
            if m[0] in self.quotes:
                close = self.html.find(m[0], at)
                if close < 0:
                    self.quotes.discard(m[0])
                else:
                    at = close + 1
        return self.html.find(">", first)


def parse(html: str) -> Node:
    """The page's tree under a root, with implied tags."""
    root = Node("#root", {})
    stack, at, n = Stack(root), 0, len(html)
    ends = TagEnds(html)
    while at < n:
        m = end = None
        if html[at] == "<":
            if html[at + 1 : at + 2] in ("!", "?"):
                at = _MARKUP.match(html, at).end()
                continue
            m = _NAME.match(html, at)
            end = ends.find(m.end()) if m else -1
        if m is None or end < 0:
            stop = html.find("<", at + 1)
            s, at = (html[at:], n) if stop < 0 else (html[at:stop], stop)
            if stack.top.tag == "head" and not s.isspace():
                stack.pop()
            stack.top.kids.append(unescape(s))
            continue
        tag, inside, at = m[2].lower(), html[m.end() : end], end + 1
        if m[1]:
            _close(stack, tag)
            continue
        if stack.top.tag == "head" and tag not in IN_HEAD:
            stack.pop()
        if tag in ENDS_P:
            _end(stack, {"p"}, {"td", "th", "table", "caption", "button", "#root"})
        if tag in IMPLIED:
            _end(stack, *IMPLIED[tag])
        if tag in ("td", "th") and stack.top.tag in ("table", "thead", "tbody", "tfoot"):
            row = Node("tr", {})
            stack.top.kids.append(row)
            stack.push(row)
        node = Node(tag, _attributes(inside))
        if tag in FOREIGN_UNSEEN and stack.last(("svg", "math")):
            node.attrs["hidden"] = ""
        stack.top.kids.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
            body, at = (html[at : end.start()], end.end()) if end else (html[at:], n)
            if tag == "textarea":
                node.kids.append(unescape(body))
            continue
        if not inside.endswith("/") or tag in BLOCK:
            stack.push(node)
    return root


class Stack:
    """The open elements, and where those of each tag stand among them, so that none is looked for element by element."""

    def __init__(self, root: Node):
        self.nodes, self.places = [root], defaultdict(list)

    @property
    def top(self) -> Node:
        return self.nodes[-1]

    def push(self, node: Node) -> None:
        self.places[node.tag].append(len(self.nodes))
        self.nodes.append(node)

    def pop(self) -> None:
        self.cut(len(self.nodes) - 1)

    def cut(self, k: int) -> None:
        """Closes all elements from the k-th on."""
        for node in self.nodes[k:]:
            self.places[node.tag].pop()
        del self.nodes[k:]

    def last(self, tags: Iterable[str]) -> int:
        """The place of the innermost open element named, 0 if there is none."""
        return max((own[-1] for own in map(self.places.get, tags) if own), default=0)


def _end(stack: Stack, tags: set[str], fence: set[str]) -> None:
    """Closes the outermost open element named, if it is above the fence."""
    low = stack.last(fence)
    above = [own[k] for own in map(stack.places.get, tags) if own and (k := bisect_right(own, low)) < len(own)]
    if above:
        stack.cut(min(above))


#: Elements that an end tag inside a cell closes across it.
_ACROSS = {"table", "tr", "thead", "tbody", "tfoot", "body", "html", "div", "section", "article", "main"}


def _close(stack: Stack, tag: str) -> None:
    at = stack.last((tag,))
    if at and (tag in _ACROSS or at >= stack.last(("table", "td", "th"))):
        stack.cut(at)


def seen(node: Node) -> bool:
    a = node.attrs
    return not (node.tag in UNSEEN or a and ("hidden" in a or node.tag == "input" or _HIDES.search(a.get("style", ""))))


def _flow(parts: Iterable) -> tuple[int, list[str], int]:
    """(margin above, lines, margin below) of inline text, breaks and blocks in order."""
    lines: list[str] = []
    above = below = 0
    text: list[str] = []

    def flush() -> None:
        nonlocal below
        if not text:
            return
        run = ["".join(x) for x in _split_breaks(text)]
        text.clear()
        got = [_BLANK.sub(" ", x).strip(" ") for x in run]
        while got and not got[-1]:
            got.pop()
        if not any(got):
            return
        if lines:
            lines.extend([""] * below)
        below = 0
        lines.extend(got)

    for p in map(_plain, parts):
        if isinstance(p, tuple):
            flush()
            if not p[1]:
                continue
            if lines:
                lines.extend([""] * max(below, p[0]))
            else:
                above = p[0]
            lines.extend(p[1])
            below = p[2]
        else:
            text.append(p)
    flush()
    return above, lines, below


def _split_breaks(text: list) -> list[list[str]]:
    out: list[list[str]] = [[]]
    for x in text:
        if x is BREAK:
            out.append([])
        else:
            out[-1].append(x)
    return out


def _table(rows: list[list[list[str]]]) -> list[str]:
    """Lines of a table whose cells are lists of lines: columns aligned, two spaces apart."""
    width = [0] * max(map(len, rows), default=0)
    for row in rows:
        for c, cell in enumerate(row):
            width[c] = max(width[c], max(map(len, cell), default=0))
    out = []
    for row in rows:
        for k in range(max((len(c) for c in row), default=0)):
            out.append("  ".join((cell[k] if k < len(cell) else "").ljust(width[c]) for c, cell in enumerate(row)).rstrip())
    return out


def _finish(node: Node, parts: deque) -> list | deque:
    """What an element gives its parent, from what its children gave it."""
    tag = node.tag
    if tag == "br":
        return [BREAK]
    if tag == "pre":
        text = "".join("\n" if x is BREAK else x if isinstance(x, str) else "\n".join(_plain(x)[1]) for x in parts).strip("\n")
        return [(1, text.split("\n"), 1)] if text.strip() else []
    if tag in ("ul", "ol", "menu", "dir"):
        lines, number = [], int(node.attrs.get("start", "1")) if node.attrs.get("start", "1").isdigit() else 1
        for p in parts:
            if isinstance(p, tuple) and len(p) == 4 and p[3] != "row":
                mark = f"{number}. " if tag == "ol" else "- "
                number += 1
                lines += [(mark if k == 0 else " " * len(mark)) + x if x else x for k, x in enumerate(p[1] or [""])] if p[1] else []
            else:
                lines += _flow([p])[1]
        return [(1, lines, 1)] if lines else []
    if tag == "li":
        above, lines, below = _flow(parts)
        return [(0, lines, 0, "li")]
    if tag in ("td", "th"):
        return [(0, _flow(parts)[1], 0, "cell")]
    if tag == "tr":
        cells = [p[1] for p in parts if isinstance(p, tuple) and len(p) == 4 and p[3] == "cell"]
        rest = [p for p in parts if not (isinstance(p, str) and p.isspace() or isinstance(p, tuple) and len(p) == 4 and p[3] == "cell")]
        # What is beside the cells stands before the table.
        return [*map(_plain, rest), (0, cells, 0, "row")] if cells else rest
    if tag in ("thead", "tbody", "tfoot"):
        return [p for p in parts if not (isinstance(p, str) and p.isspace())]
    if tag == "table":
        lines, rows = [], []
        loose: list = []
        for p in parts:
            if isinstance(p, tuple) and len(p) == 4 and p[3] == "row":
                rows.append(p[1])
            elif not (isinstance(p, str) and p.isspace()):
                loose.append(p)
        lines = _flow(loose)[1] + _table(rows)
        return [(1, lines, 1)] if any(lines) else []
    if tag == "optgroup" and node.attrs.get("label"):
        return [(0, [node.attrs["label"], *_flow(parts)[1]], 0)]
    if tag == "text":  # each stands at its own place in a picture
        return [(0, _flow([_plain(p) for p in parts])[1], 0)]
    if tag == "dd":
        above, lines, below = _flow(parts)
        return [(0, ["  " + x if x else x for x in lines], 0)]
    if tag == "blockquote":
        _, lines, _ = _flow(parts)
        return [(1, ["  " + x if x else x for x in lines], 1)]
    if tag in BLOCK or tag == "#root":
        above, lines, below = _flow([_plain(p) for p in parts])
        own = 1 if tag in SPACED else 0
        return [(max(own, above), lines, max(own, below))]
    return parts


def _plain(p: object) -> object:
    """Items, rows and cells outside their list or table are blocks."""
    if isinstance(p, tuple) and len(p) == 4:
        return (0, _table([p[1]]) if p[3] == "row" else p[1], 0)
    return p


def render(html: str | None) -> str:
    """All visible text of a page, laid out."""
    if not html:
        return ""
    root = parse(html)
    todo: list = [(root, iter(root.kids), deque())]
    while True:
        node, kids, parts = todo[-1]
        for kid in kids:
            if isinstance(kid, str):
                parts.append(kid)
            elif seen(kid):
                todo.append((kid, iter(kid.kids), deque()))
                break
        else:
            todo.pop()
            done = _finish(node, parts)
            if not todo:
                return "\n".join(done[0][1]) if done else ""
            above = todo[-1][2]
            # The longer one of the two takes the other in, so a chain of inline elements copies no part at each level.
            if done is parts and len(done) > len(above):
                done.extendleft(reversed(above))
                todo[-1] = (*todo[-1][:2], done)
            else:
                above.extend(done)


def extract(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, text) of every row of pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = pa.array([render(b.column(1)[k].as_py()) for k in range(len(b))], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), text], ["page_id", "text"])

    return pages.select(F.col(key).cast("long").alias("page_id"), F.col(html).cast("string").alias("html")).mapInArrow(run, "page_id long, text string")
