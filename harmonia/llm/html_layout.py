"""Operator 8: HTML extraction by layout-aware rendering.

A tree builder with implied end tags reads the page; a renderer walks the
tree and emits all visible text: blocks are separated by line breaks,
paragraph-like blocks by a blank line, list items carry bullets or numbers
with indentation, preformatted text keeps its spacing, and the cells of a
table are padded to common column widths.

Cases: null or empty HTML gives empty text; unclosed and stray tags are
repaired like in a browser; repeated rows are rendered alike; other columns
are ignored; no rows: no rows.  Depth is unbounded (no recursion).
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from harmonia.llm.common import sql_type

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
#: Fixed values of the HTML standard: element classes of the tree builder.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noframes iframe xmp".split())
UNSEEN = frozenset("head script style template noscript title iframe noframes object audio video canvas datalist desc metadata annotation annotation-xml".split())
#: Elements that may stand in a head; any other one ends it.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title head html".split())
TABLE_PARTS = frozenset("thead tbody tfoot".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure".split())
BLOCK = SPACED | frozenset("html body address article aside dd details div dt fieldset figcaption footer form header hgroup "
                           "hr legend li main menu nav section summary tr thead tbody tfoot caption center option".split())
#: An opening tag closes these open elements, as far as the listed scope.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}), "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
HOLDS = frozenset("template noscript".split())
CLOSES_P = BLOCK - frozenset("option tr thead tbody tfoot caption html body legend".split()) | {"hr"}
P_SCOPE = frozenset("button td th caption table html".split())
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
SPACE = re.compile(r"[ \t\n\f\r]+")


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.kids = tag, attrs, []


def build_tree(page: str) -> Node:
    """Elements and texts of a page; end tags are implied where they are missing."""
    root = Node("", {})
    stack, at, size = [root], 0, len(page)

    def close(tags: set, scope: set) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                if len(tags) < 3:  # one element of its kind; table parts go on outwards
                    return
            elif stack[i].tag in scope:
                return

    while at < size:
        m = TOKEN.search(page, at)
        end = m.start() if m else size
        if end > at:
            if stack[-1].tag == "head" and page[at:end].strip():
                stack.pop()
            stack[-1].kids.append(htmllib.unescape(page[at:end]))
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in ("td", "th", "table") and tag not in ("tr", "table", "tbody", "thead", "tfoot"):
                    break  # a stray end tag does not reach out of a cell
            continue
        if tag not in IN_HEAD:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "head":
                    del stack[i:]
                    break
                if stack[i].tag not in IN_HEAD or stack[i].tag in HOLDS:
                    break
        if tag in CLOSES_P:
            close({"p"}, P_SCOPE)
        if tag in CLOSES:
            close(*CLOSES[tag])
        attrs = {k.lower(): a or b or c for k, a, b, c in ATTR.findall(m[3])} if m[3].strip(" /") else {}
        node = Node(tag, attrs)
        stack[-1].kids.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            node.kids.append(htmllib.unescape(page[at:stop.start() if stop else size]))
            at = stop.end() if stop else size
        elif tag not in VOID:
            stack.append(node)
    return root


def visible(node: Node) -> bool:
    a = node.attrs
    return not (node.tag in UNSEEN or "hidden" in a or node.tag == "input" or INVISIBLE.search(a.get("style") or ""))


class Page:
    """Text that is laid out line by line."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line = ""
        self.gap = 0        # line breaks owed before the next text
        self.indent = ""
        self.mark = ""      # bullet of a list item that has no text yet

    def text(self, t: str, pre: bool) -> None:
        if pre:
            for i, part in enumerate(t.split("\n")):
                if i:
                    self.newline()
                if part:
                    self.put(part)
            return
        t = SPACE.sub(" ", t)
        if not self.line or self.line.endswith(" ") or self.gap:
            t = t.lstrip(" ") if self.gap or not self.line or self.line.endswith(" ") else t
        if t:
            self.put(t)

    def put(self, t: str) -> None:
        if self.gap:
            if self.lines or self.line:
                self.newline()
                if self.gap > 1 and self.lines and self.lines[-1]:
                    self.lines.append("")
            self.gap = 0
        if not self.line:
            self.line = self.indent + self.mark
            if self.mark:
                self.indent += " " * len(self.mark)
                self.mark = ""
        self.line += t

    def newline(self) -> None:
        self.lines.append(self.line.rstrip(" "))
        self.line = ""

    def block(self, spaced: bool) -> None:
        self.gap = max(self.gap, 2 if spaced else 1)

    def done(self) -> str:
        if self.line:
            self.newline()
        return "\n".join(self.lines).strip("\n")


def _rows(table: Node) -> tuple[list[list[Node]], list[Node | str]]:
    """Rows of cells of a table, and what stands in it outside of cells.

    A bare cell belongs to an implied row; other elements of a table are
    searched for rows, and as a whole stand before the table if they have none.
    """
    rows, stray, above = [], [], _above_cells(table)
    todo: list = [(k, None) for k in reversed(table.kids)]
    loose = None  # the implied row that bare cells join
    while todo:
        k, row = todo.pop()
        if isinstance(k, str):
            if stray or k.strip():
                stray.append(k)
        elif not visible(k) or k.tag == "caption" and row is None:
            continue
        elif k.tag in ("td", "th"):
            if row is None:
                if loose is None:
                    rows.append(loose := [])
                row = loose
            row.append(k)
        elif k.tag == "tr":
            loose = None
            rows.append(own := [])
            todo.extend((x, own) for x in reversed(k.kids))
        elif k.tag in TABLE_PARTS:
            loose = None
            todo.extend((x, None) for x in reversed(k.kids))
        elif id(k) in above:
            todo.extend((x, row) for x in reversed(k.kids))
        else:
            stray.append(k)
    return rows, stray


def _above_cells(table: Node) -> set[int]:
    """Identities of the nodes below ``table`` that hold its rows or cells."""
    seen: list = [(table, None)]
    for node, _ in seen:
        if node is table or node.tag not in ("td", "th", "table"):
            seen.extend((k, node) for k in node.kids if isinstance(k, Node))
    out: set[int] = set()
    for node, parent in reversed(seen):
        if parent is not None and (node.tag in ("td", "th", "tr") or id(node) in out):
            out.add(id(parent))
    return out


def _aligned(rows: list[list[str]]) -> str:
    """Rows of padded cells; the lines of a cell stand below one another."""
    cells = [[c.split("\n") for c in r] for r in rows]
    width = [max(len(x) for r in cells if i < len(r) for x in r[i]) for i in range(max(map(len, cells)))]
    return "\n".join("  ".join((c[k] if k < len(c) else "").ljust(w) for c, w in zip(r, width)).rstrip()
                     for r in cells for k in range(max(map(len, r), default=0)))


def render(root: Node, depth: int = 0) -> str:
    """Visible text of a tree, laid out.  Nested tables render inside their cell, up to 50 deep."""
    page = Page()
    todo: list = [("open", root, False)]
    lists: list[list] = []
    while todo:
        what, x, pre = todo.pop()
        if what == "text":
            page.text(x, pre)
        elif what == "close":
            if x.tag in BLOCK:
                page.block(x.tag in SPACED and not (x.tag in ("ul", "ol") and len(lists) > 1))
            if x.tag in ("ul", "ol", "menu"):
                lists.pop()
            if x.tag == "li":
                page.indent, page.mark = page.indent[:pre], ""
        elif x.tag == "" or visible(x):
            tag = x.tag
            if tag == "br":
                if page.gap and (page.lines or page.line):
                    page.put("")
                page.newline() if page.line or page.lines else None
                continue
            if tag in ("hr", "wbr"):
                page.block(False) if tag == "hr" else None
                continue
            if tag == "img":
                if x.attrs.get("alt"):
                    page.text(x.attrs["alt"], False)
                continue
            if tag in BLOCK:
                page.block(tag in SPACED and not (tag in ("ul", "ol") and lists))
            if tag == "table" and depth < 50:
                for k in x.kids:
                    if isinstance(k, Node) and k.tag == "caption" and visible(k):
                        page.text(render(k, depth + 1), False)
                        page.block(False)
                cells, stray = _rows(x)
                if stray:  # shown before the table, as in a browser
                    before = Node("", {})
                    before.kids = stray
                    page.text(render(before, depth + 1), True)
                    page.block(False)
                rows = [[render(c, depth + 1) for c in r] for r in cells]
                if rows := [r for r in rows if any(r)]:
                    page.text(_aligned(rows), True)
                page.block(True)
                continue
            mark = len(page.indent)
            if tag in ("ul", "ol", "menu"):
                lists.append([tag, 0])
            elif tag == "li":
                if lists:
                    lists[-1][1] += 1
                page.mark = f"{lists[-1][1]}. " if lists and lists[-1][0] == "ol" else "- "
            if tag not in VOID:
                todo.append(("close", x, mark if tag == "li" else pre))
                inner = pre if tag == "" else pre or tag in ("pre", "textarea") or \
                    "white-space:pre" in (x.attrs.get("style") or "").replace(" ", "")
                todo.extend(("text", k, inner) if isinstance(k, str) else ("open", k, inner)
                            for k in reversed(x.kids))
        continue
    return page.done()


def extract(page: str | None) -> str:
    return render(build_tree(page)) if page else ""


def extract_pages(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """``page_id`` and the rendered ``text`` of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(p) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["page_id", "text"])

    return pages.select(page_id, html).mapInArrow(run, f"page_id {sql_type(pages, page_id)}, text string")
