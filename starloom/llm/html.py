"""HTML extraction by layout-aware rendering.

A tree builder reads the markup as browsers do where it matters for text: void
elements, raw text, implied end tags (p, li, dt, dd, option, table parts, head)
and implied rows. Visibility rules then drop what a reader can't see: head,
scripts, templates, closed dialogs and details, ``hidden``, and what inline styles
and the rules of style elements hide: ``display: none`` takes all that is in an element,
``visibility`` is inherited, so an element can show itself again (see ``css``). What
is left is written in order, all of it: blocks on lines of their own, paragraphs,
headings, lists and tables set off by a blank line, list items with bullets or
numbers and indented, preformatted text as it stands, and the cells of a table in
aligned columns.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_right
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import small_batches, text_of
from starloom.llm.css import Styles, Walk, on_screen

# Fixed values of HTML: element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head title script style template noscript iframe noembed noframes audio video canvas object datalist rp map".split())
IN_HEAD = frozenset("head title base link meta script style noscript template".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1
 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul
 xmp caption""".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir table pre xmp blockquote figure hr".split())
ENDS_P = BLOCK - frozenset("body html td th tr tbody thead tfoot caption option optgroup".split())
LISTS = frozenset("ul ol menu dir".split())
# An element that starts ends these open ones, unless one of the second kind stands between.
IMPLIED = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
} | {x: ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}) for x in ("thead", "tbody", "tfoot", "caption")}
TABLE_PARTS = frozenset("caption thead tbody tfoot tr td th".split())

#: Spans as browsers limit them. A table's columns are padded to at most ``PADDING`` times
#: the length of its text; where whole alignment would take more, the widest lines give way.
MOST_ACROSS, MOST_DOWN, PADDING = 1000, 65_534, 16

_TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)
 |<([a-zA-Z][^\s/>]*)((?:[^>"'=]|=\s*(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))|["'=])*)(?:>|\Z)""", re.S | re.X)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_SPACE = re.compile(r"[ \t\n\f\r]+")

class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.kids = tag, attrs, []


def build(markup: str) -> tuple[Node, Styles]:
    """The tree, and what style elements say of visibility. The places of the open
    elements are kept by tag, so no tag makes it walk the stack."""
    root, styles = Node("#root", {}), Styles()
    stack, opened = [root], {}

    def close(n: int) -> None:
        for x in stack[n:]:
            opened[x.tag].pop()
        del stack[n:]

    def innermost(tags) -> int:
        return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    def end_open(tags, until) -> None:
        """Close the open elements ``tags`` down to the next of ``until``."""
        fence = innermost(until)
        found = [p[k] for p in map(opened.get, tags) if p and (k := bisect_right(p, fence)) < len(p)]
        if found:
            close(min(found))

    def push(tag: str, attrs: dict) -> None:
        x = Node(tag, attrs)
        stack[-1].kids.append(x)
        if tag not in VOID:
            opened.setdefault(tag, []).append(len(stack))
            stack.append(x)

    at, size = 0, len(markup)
    while at < size:
        m = _TOKEN.search(markup, at)
        if m is None:
            stack[-1].kids.append(unescape(markup[at:]))
            break
        if m.start() > at:
            text = markup[at:m.start()]
            if opened.get("head") and not text.isspace():
                end_open({"head"}, ())
            stack[-1].kids.append(unescape(text) if "&" in text else text)
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if tag == "br":
                push("br", {})
            elif opened.get(tag):
                fences = () if tag == "table" else ("table",) if tag in BLOCK else ("td", "th", "table", "caption")
                if opened[tag][-1] >= innermost(fences):
                    close(opened[tag][-1])
        elif m[2]:
            tag = m[2].lower()
            attrs = {a[1].lower(): unescape(a[2] or a[3] or a[4] or "") for a in _ATTR.finditer(m[3])} if m[3] else {}
            if opened.get("head") and tag not in IN_HEAD:
                end_open({"head"}, ())
            if tag in ("html", "body") and opened.get(tag) or tag in TABLE_PARTS and not opened.get("table"):
                continue
            if tag in ENDS_P and opened.get("p"):
                end_open({"p"}, ("td", "th", "button", "caption", "object"))
            if tag in IMPLIED:
                end_open(*IMPLIED[tag])
            if tag in ("td", "th") and innermost(("tr",)) < innermost(("table",)):
                end_open(*IMPLIED["tr"])
                push("tr", {})
            push(tag, attrs)
            if tag in RAW:
                e = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(markup, at)
                text = markup[at:e.start() if e else size]
                at = e.start() if e else size
                stack[-1].kids.append(unescape(text) if tag in ("textarea", "title") else text)
                if tag == "style" and on_screen(attrs.get("media", "")):
                    styles.read(text)
                if e is None:
                    close(len(stack) - 1)
    return root, styles


def unseen(x: Node, parent: Node, said: dict) -> bool:
    """Whether an element and all in it have no place on the page."""
    a = x.attrs
    if x.tag in UNSEEN or x.tag == "dialog" and "open" not in a:
        return True
    if parent.tag == "details" and "open" not in parent.attrs and x.tag != "summary":
        return True
    return said.get("display", "hidden" in a)


def shown(x: Node) -> list:
    """The kids of an element that are on the page; of a closed select the chosen option."""
    if x.tag != "select":
        return x.kids
    own = [k for k in x.kids if isinstance(k, Node)]
    own = [o for k in own for o in ([g for g in k.kids if isinstance(g, Node)] if k.tag == "optgroup" else [k])]
    return ([k for k in own if "selected" in k.attrs] or own)[:1]


class Page:
    """Lines of a page or a cell, with the spacing of its blocks."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.gap = False
        self.indent: list[str] = []
        self.mark: str | None = None

    def put(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        if self.mark is not None:
            before, self.mark = "".join(self.indent[:-1]) + self.mark, None
        else:
            before = "".join(self.indent)
        self.lines.append((before + line).rstrip())

    def end_line(self, forced: bool = False) -> None:
        line = _SPACE.sub(" ", "".join(self.now)).strip(" ")
        self.now = []
        if line:
            self.put(line)
        elif forced and self.lines and self.lines[-1]:
            self.gap = True

    def space(self) -> None:
        self.end_line()
        self.gap = True


def _whole(text: str, most: int) -> int:
    """The number that a text begins with, as browsers read it; 1 if there is none."""
    m = re.match(r"[ \t\n\f\r]*\+?([0-9]+)", text)
    return 1 if m is None else min(int(m[1][-20:]) if len(m[1].lstrip("0")) < 10 else most, most)


class _Free:
    """The columns that no cell of an earlier row reaches down into, as gaps in order."""

    def __init__(self):
        self.starts, self.ends = [0], [1 << 60]
        self.held: list[tuple[int, int, int]] = []  # heap: (last row, first column, column behind)

    def first(self, c: int) -> int:
        """The first free column from ``c`` on."""
        i = bisect_right(self.ends, c)
        return max(c, self.starts[i])

    def take(self, a: int, z: int, last: int) -> None:
        """Hold what is free of a to z until the row ``last`` is done."""
        i = j = bisect_right(self.ends, a)
        left = []
        while j < len(self.starts) and self.starts[j] < z:
            s, e = self.starts[j], self.ends[j]
            heapq.heappush(self.held, (last, max(s, a), min(e, z)))
            left += [(x, y) for x, y in ((s, a), (z, e)) if x < y]
            j += 1
        self.starts[i:j], self.ends[i:j] = [x for x, _ in left], [y for _, y in left]

    def until(self, row: int) -> None:
        """Give back what was held up to a row before ``row``."""
        while self.held and self.held[0][0] < row:
            _, a, z = heapq.heappop(self.held)
            i = bisect_right(self.starts, a)
            j = i
            if i and self.ends[i - 1] == a:
                i, a = i - 1, self.starts[i - 1]
            if j < len(self.starts) and self.starts[j] == z:
                j, z = j + 1, self.ends[j]
            self.starts[i:j], self.ends[i:j] = [a], [z]


def table_lines(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Rows of (lines, colspan, rowspan) in aligned columns, two blanks between."""
    placed, free = [], _Free()
    for r, row in enumerate(rows):
        cells, c = [], 0
        for lines, across, down in row:
            c = free.first(c)
            cells.append((c, lines, across, down))
            c += across
        free.until(r + 1)
        for c, _, across, down in cells:
            if down > 1:
                free.take(c, c + across, r + down - 1)
        placed.append([cell[:3] for cell in cells])
    wide: dict[int, list[int]] = {}
    text = tall = 0
    for cells in placed:
        for c, lines, across in cells:
            if across == 1:
                wide.setdefault(c, []).extend(map(len, lines))
            text += sum(map(len, lines))
        tall += max((len(lines) for _, lines, _ in cells), default=0)
    used = sorted({c for cells in placed for c, _, _ in cells})
    full = {c: max(wide.get(c, ()), default=0) for c in used}
    # whole alignment unless it would blow the page up: then lines wider than ``most`` don't count
    most = max(full.values(), default=0)
    while most and tall * sum(min(x, most) + 2 for x in full.values()) > PADDING * text + 100_000:
        most //= 2
    place, x = {}, 0
    for c in used:
        place[c] = x
        x += (full[c] if full[c] <= most else max((n for n in wide[c] if n <= most), default=0)) + 2 if most else 0
    out = []
    for cells in placed:
        for k in range(max((len(lines) for _, lines, _ in cells), default=0)):
            parts, at = [], 0
            for c, lines, _ in cells:
                if k < len(lines) and lines[k]:
                    gap = max(place[c] - at, 2 if at else 0)
                    parts += [" " * gap, lines[k]]
                    at += gap + len(lines[k])
            out.append("".join(parts).rstrip())
    return out


def render(markup: str) -> str:
    """All visible text of a page."""
    root, styles = build(markup)
    walk = Walk(styles)
    pages, tables, lists = [Page()], [], []
    pre = 0
    todo: list[tuple] = [(root, None, True, True)]
    while todo:
        x, parent, enter, seen = todo.pop()
        page = pages[-1]
        if isinstance(x, str):
            if not seen or parent.tag == "details" and "open" not in parent.attrs:
                continue
            if pre:
                first, *more = x.split("\n")
                page.now.append(first)
                for line in more:
                    page.put("".join(page.now))
                    page.now = [line]
            else:
                page.now.append(x)
            continue
        tag = x.tag
        if enter:
            met = []
            if parent is not None:
                said, met = walk.at(tag, x.attrs) if styles.steps or "style" in x.attrs else ({}, [])
                if unseen(x, parent, said):
                    continue
                if said.get("visibility") is not None:  # inherited unless an element says otherwise
                    seen = not said["visibility"]
            if tag == "br":
                page.end_line(True)
                continue
            if seen and tag == "input" and x.attrs.get("type", "").lower() in ("submit", "button", "reset"):
                page.now.append(" " + x.attrs.get("value", "") + " ")
            if seen and tag == "q":
                page.now.append("“")
            if tag in BLOCK and tag not in ("td", "th"):
                page.space() if tag in SPACED and not (lists and tag in LISTS) else page.end_line()
            if tag == "hr":
                if seen:
                    page.put("---")
                page.gap = True
            elif tag in LISTS:
                lists.append([tag == "ol", _whole(x.attrs.get("start", ""), 10**8)])
            elif tag == "li":
                mark = "- "
                if lists and lists[-1][0]:
                    mark = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                page.mark = mark if seen else None
                page.indent.append(" " * len(mark))
            elif tag in ("blockquote", "dd"):
                page.indent.append("    ")
            elif tag in ("pre", "xmp"):
                pre += 1
                if x.kids and isinstance(x.kids[0], str):
                    x.kids[0] = x.kids[0].removeprefix("\n")
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th"):
                pages.append(Page())
            if tag not in VOID:
                walk.enter(met)
                todo.append((x, parent, False, seen))
                todo.extend((k, x, True, seen) for k in reversed(shown(x)))
            continue
        walk.leave()
        if seen and tag == "q":
            page.now.append("”")
        if tag in ("pre", "xmp"):
            if "".join(page.now).strip():
                page.put("".join(page.now))
            page.now = []
            pre -= 1
        if tag in ("td", "th"):
            page.end_line()
            pages.pop()
            tables[-1][-1].append((page.lines, _whole(x.attrs.get("colspan", ""), MOST_ACROSS), _whole(x.attrs.get("rowspan", ""), MOST_DOWN)))
            continue
        if tag in BLOCK:
            page.end_line()
            if tag == "table":
                for line in table_lines([r for r in tables.pop() if r]):
                    page.put(line)
            elif tag == "li":
                page.indent.pop()
                page.mark = None
            elif tag in ("blockquote", "dd"):
                page.indent.pop()
            elif tag in LISTS:
                lists.pop()
            if tag in SPACED and not (lists and tag in LISTS):
                page.gap = True
    pages[-1].end_line()
    return "\n".join(pages[-1].lines)


def _extract(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([render(t) for t in text_of(b.column(1))], pa.string())], names=["page_id", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, html; other columns are ignored) -> page_id, text, a row
    per row. Null and empty html give an empty text; null ids and repeated rows
    are rows like any other; empty table: empty result."""
    small_batches(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long"), "html").mapInArrow(_extract, "page_id long, text string")
