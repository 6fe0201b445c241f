"""HTML to the text a reader would see, laid out as blocks, lists and tables.

A tokenizer splits the page into tags and text in one pass. A tree builder adds what authors
leave out: a block ends an open paragraph, a list item, row, cell or option ends its
predecessor, an end tag closes what is open within it and is dropped if nothing matches.
Visibility rules cut scripts, styles, templates, the head, embedded media, and whatever is
hidden by attribute or inline style. Rendering collapses white space as a browser does, keeps
one blank line between paragraphs, headings, lists and tables, indents lists with bullets or
numbers, keeps preformatted text, and aligns the cells of a table in columns.

Defined results: a null or empty page has no text; text outside any tag is shown; unclosed
tags, comments and scripts end with the page; nesting may have any depth, but lines are indented
for ``DEEPEST`` levels of lists and quotes at most; a cell wider than ``WIDEST`` is wrapped within
its column unless it is the last of its row; a cell of several blocks has several lines, and a cell
of blanks none; columns in which no cell begins take no room.
"""

from __future__ import annotations

import html
import re
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxtrail.llm.shared import text_or_empty

DEEPEST, WIDEST = 200, 40

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe"}
UNSEEN = {
    "head", "script", "style", "template", "noscript", "title", "iframe", "object", "svg", "math", "audio",
    "video", "canvas", "datalist", "textarea", "noembed", "noframes",
}
SPACED = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "table", "blockquote", "pre", "figure", "fieldset"}
BLOCKS = SPACED | {
    "html", "body", "div", "section", "article", "aside", "header", "footer", "nav", "main", "address", "li", "dt",
    "dd", "form", "figcaption", "legend", "details", "summary", "hr", "center", "caption", "tr", "option", "menu",
}
#: What an opening tag closes, and the tags beyond which it doesn't look.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"caption", "tr", "thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"caption", "tr", "thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"caption", "tr", "thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()),
}
SCOPES = {"table", "td", "th", "caption", "template", "object", "html", "body"}
ENDS_PARAGRAPH = BLOCKS - {"html", "body", "caption", "tr", "option", "legend", "figcaption"}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>`]+)))?""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_SPACE = re.compile(r"[ \t\n\f\r]+")
_WHOLE = re.compile(r"[ \t\n\f\r]*\+?0*([0-9]+)")


@dataclass
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("text" | "open" | "close", name or text, attributes) in order; comments are left out."""
    at, n = 0, len(page)
    while at < n:
        start = page.find("<", at)
        if start < 0:
            yield "text", page[at:], ""
            return
        if start > at:
            yield "text", page[at:start], ""
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = n if end < 0 else end + 3
        elif page[start + 1 : start + 2] in ("!", "?"):
            end = page.find(">", start)
            at = n if end < 0 else end + 1
        else:
            closing = page.startswith("</", start)
            name = _NAME.match(page, start + 1 + closing)
            if not name:
                yield "text", "<", ""
                at = start + 1
                continue
            end = _tag_end(page, name.end())
            tag = name.group().lower()
            yield "close" if closing else "open", tag, page[name.end() : end]
            at = end + 1
            if not closing and tag in RAW:
                close = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
                stop = close.start() if close else n
                yield "text", page[at:stop], ""
                at = stop


def _tag_end(page: str, at: int) -> int:
    """Place of the > that ends a tag; those in quoted values don't."""
    while True:
        end = page.find(">", at)
        if end < 0:
            return len(page)
        quote = min((q for q in (page.find('="', at, end), page.find("='", at, end)) if q >= 0), default=-1)
        if quote < 0:
            return end
        close = page.find(page[quote + 1], quote + 2)
        if close < 0:
            return end
        at = close + 1


def build(page: str) -> Node:
    """The tree of a page, with implied end tags."""
    root = Node("#root")
    stack = [root]
    places: dict[str, list[int]] = {}  # of each open tag, so that no search walks a deep stack

    def close_to(depth: int) -> None:
        for node in stack[depth:]:
            places[node.tag].pop()
        del stack[depth:]

    def last(names: set[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def innermost(names: set[str], barrier: set[str]) -> int:
        at = last(names)
        return at if at >= last(barrier) else 0

    for kind, value, rest in tokens(page):
        if kind == "text":
            stack[-1].children.append(value if stack[-1].tag in RAW - {"textarea", "title"} else html.unescape(value))
            continue
        if kind == "open":
            names, barrier = CLOSES.get(value, (set(), set()))
            while names and (at := innermost(names, barrier)):
                close_to(at)
            if value in ENDS_PARAGRAPH and (at := innermost({"p"}, SCOPES | {"button"})):
                close_to(at)
            found = {m[0].lower(): html.unescape(m[1] or m[2] or m[3]) for m in _ATTRIBUTE.findall(rest)} if rest else {}
            node = Node(value, found)
            stack[-1].children.append(node)
            if value not in VOID and not (rest.endswith("/") and value in ("svg", "math")):
                places.setdefault(value, []).append(len(stack))
                stack.append(node)
        elif value == "br":
            stack[-1].children.append(Node("br"))
        elif value not in VOID:
            barrier = {"table"} if value in ("li", "p", "div", "span", "td", "th", "tr") and value != "table" else set()
            if at := innermost({value}, barrier):
                close_to(at)
    return root


def unseen(node: Node) -> bool:
    a = node.attributes
    return (
        node.tag in UNSEEN
        or "hidden" in a
        or (node.tag == "dialog" and "open" not in a)
        or (node.tag == "input")
        or bool(_HIDDEN.search(a.get("style", "")))
    )


@dataclass
class Indented:
    """Lines of a list item (with its mark) or of a quote, put together in the end."""

    mark: str
    lines: list[str | Indented]


def flat(lines: list[str | Indented]) -> list[str]:
    """Lines as text: a mark leads the first line, as many blanks the others that are not empty."""
    out: list[str] = []
    open_blocks = [(iter(lines), "")]
    lead: list[str] = []  # what goes before the first line of the blocks just begun
    solid = 0  # how much of it goes before an empty line as well: up to the last mark
    while open_blocks:
        items, indent = open_blocks[-1]
        item = next(items, None)
        if item is None:
            open_blocks.pop()
        elif isinstance(item, Indented):
            lead = lead or [indent]
            lead.append(item.mark)
            solid = len(lead) if item.mark.strip() else solid
            deeper = indent + " " * len(item.mark) if len(open_blocks) <= DEEPEST else indent
            open_blocks.append((iter(item.lines), deeper))
        else:
            out.append("".join(lead or [indent]) + item if item else "".join(lead[:solid]))
            lead, solid = [], 0
    return out


#: A step of the layout hands its parts to `finished` instead of calling them, and is sent what they return.
Step = Generator["Step", list, list]


def finished(step: Step) -> list:
    """What a step returns, with an explicit stack: pages may be nested deeper than calls."""
    steps, value = [step], None
    while steps:
        try:
            steps.append(steps[-1].send(value))
            value = None
        except StopIteration as end:
            steps.pop()
            value = end.value
    return value


class Page:
    """Lines of text with pending breaks: 1 ends a line, 2 leaves a blank one."""

    def __init__(self) -> None:
        self.lines: list[str | Indented] = []
        self.line = ""
        self.gap = 0
        self.space = False

    def block(self, gap: int) -> None:
        if self.line.strip():
            self.lines.append(self.line.rstrip())
            self.line, self.gap = "", 0
        self.line, self.space = "", False
        if self.lines:
            self.gap = max(self.gap, gap)

    def begin(self) -> None:
        if not self.line and self.lines and self.gap > 1:
            self.lines.append("")
        self.gap = 0 if not self.line else self.gap

    def inline(self, text: str) -> None:
        words = _SPACE.split(text)
        if len(words) > 1 and self.line and words[0] == "":
            self.space = True
        body = " ".join(w for w in words if w)
        if body:
            self.begin()
            self.line += (" " if self.space and self.line else "") + body
            self.space = False
        if len(words) > 1 and words[-1] == "":
            self.space = True

    def hard_break(self) -> None:
        self.begin()
        self.lines.append(self.line.rstrip())
        self.line, self.space, self.gap = "", False, 1

    def verbatim(self, lines: list[str | Indented]) -> None:
        self.begin()
        self.lines.extend(lines)

    def finish(self) -> list[str | Indented]:
        self.block(0)
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def lay_out(nodes: list[Node | str], page: Page) -> Step:
    for node in nodes:
        if isinstance(node, str):
            page.inline(node)
        elif unseen(node):
            continue
        elif node.tag == "br":
            page.hard_break()
        elif node.tag == "hr":
            page.block(1)
            page.verbatim(["---"])
            page.block(1)
        elif node.tag in BLOCKS:
            gap = 2 if node.tag in SPACED else 1
            page.block(gap)
            yield _block(node, page)
            page.block(gap)
        elif node.tag in ("td", "th"):
            page.inline(" ")
            yield lay_out(node.children, page)
            page.inline(" ")
        else:
            yield lay_out(node.children, page)


def _inside(nodes: list[Node | str]) -> Step:
    page = Page()
    yield lay_out(nodes, page)
    return page.finish()


def _block(node: Node, page: Page) -> Step:
    if node.tag in ("ul", "ol", "menu"):
        yield _list(node, page)
    elif node.tag == "table":
        page.verbatim((yield _table(node)))
    elif node.tag == "pre":
        text = _plain(node).expandtabs(8).strip("\n")
        page.verbatim([line.rstrip() for line in text.split("\n")] if text.strip() else [])
    elif node.tag in ("blockquote", "dd"):
        lines = yield _inside(node.children)
        page.verbatim([Indented("  ", lines)] if lines else [])
    elif node.tag == "details" and "open" not in node.attributes:
        yield lay_out([c for c in node.children if isinstance(c, Node) and c.tag == "summary"], page)
    else:
        yield lay_out(node.children, page)


def _list(node: Node, page: Page) -> Step:
    start = node.attributes.get("start", "1")
    number = int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1
    for child in node.children:
        if isinstance(child, str) or child.tag != "li":
            yield lay_out([child], page)
            continue
        if unseen(child):
            continue
        page.block(1)
        mark = f"{number}. " if node.tag == "ol" else "- "
        number += 1
        lines = yield _inside(child.children)
        if lines:
            page.verbatim([Indented(mark, lines)])


def _plain(node: Node) -> str:
    parts, left = [], [iter(node.children)]
    while left:
        child = next(left[-1], None)
        if child is None:
            left.pop()
        elif isinstance(child, str):
            parts.append(child)
        elif child.tag == "br":
            parts.append("\n")
        elif not unseen(child):
            left.append(iter(child.children))
    return "".join(parts)


def _rows(node: Node, section: int = 0) -> Iterator[tuple[int, Node]]:
    """Rows with the number of their section."""
    for i, child in enumerate(node.children, 1):
        if isinstance(child, Node) and not unseen(child):
            if child.tag == "tr":
                yield section, child
            elif child.tag in ("thead", "tbody", "tfoot"):
                yield from _rows(child, i)


def _span(cell: Node, name: str, least: int, most: int) -> int:
    found = _WHOLE.match(cell.attributes.get(name, "1"))
    return min(most, max(least, int(found[1][:6]))) if found else 1


def _wrapped(text: str) -> list[str]:
    """A line of a cell in lines of up to ``WIDEST`` characters; only longer words are broken, and
    all keep the indentation of the first, up to half the width."""
    if len(text) <= WIDEST:
        return [text]
    body = text.lstrip(" ")
    indent = text[: min(len(text) - len(body), WIDEST // 2)]
    room = WIDEST - len(indent)
    lines, line = [], ""
    for word in body.split(" "):
        if line and len(line) + 1 + len(word) > room:
            lines.append(line)
            line = word
        else:
            line = f"{line} {word}" if line else word
        if len(line) > room:
            parts = [line[i : i + room] for i in range(0, len(line), room)]
            lines += parts[:-1]
            line = parts[-1]
    return [indent + x for x in (*lines, line)]


def _table(node: Node) -> Step:
    """A table's caption and rows, cells padded to their columns; stray text comes first.

    A cell keeps the lines of its blocks, lists and tables; the row is as high as its highest cell.
    The last cell of a row, and so the only one of a layout table, is laid out like any block.
    """
    loose = [c for c in node.children if isinstance(c, str) or c.tag not in ("tr", "thead", "tbody", "tfoot", "colgroup", "col")]
    out = yield _inside(loose)
    grid: list[dict[int, list[str]]] = []
    above: list[tuple[int, int, int]] = []  # first column, end and last row of cells from rows above
    before = 0
    for number, (section, row) in enumerate(_rows(node)):
        # Cells end with their section.
        above = [a for a in above if a[2] >= number] if section == before else []
        before, new = section, []
        cells, column, passed = {}, 0, 0
        for cell in row.children:
            if isinstance(cell, str) and not cell.strip() or isinstance(cell, Node) and unseen(cell):
                continue
            while passed < len(above) and above[passed][0] <= column:
                column = max(column, above[passed][1])
                passed += 1
            inside = cell.children if isinstance(cell, Node) and cell.tag in ("td", "th") else [cell]
            lines = yield _inside(inside)
            lines = [x.rstrip() for x in flat(lines)]
            while lines and not lines[-1]:
                lines.pop()
            cells[column] = lines or [""]
            wide, high = (_span(cell, "colspan", 1, 1000), _span(cell, "rowspan", 0, 65534)) if isinstance(cell, Node) else (1, 1)
            if high != 1:  # 0 is all rows to come
                new.append((column, column + wide, number + (high or 1 << 31) - 1))
            column += wide
        above = sorted(above + new) if new else above
        grid.append(cells)
    place = {c: i for i, c in enumerate(sorted({c for cells in grid for c in cells}))}
    widths = [0] * len(place)
    laid = []
    for cells in grid:
        last = max(cells, default=-1)
        whole = lambda c, lines: lines if c == last else [x for line in lines for x in _wrapped(line)]  # noqa: B023, E731
        laid.append({place[c]: whole(c, lines) for c, lines in cells.items()})
        for c, lines in laid[-1].items():
            widths[c] = max(widths[c], *(len(x) for x in lines if len(x) <= WIDEST), 0)
    for cells in laid:
        for i in range(max(map(len, cells.values()), default=0)):
            last = max((c for c, lines in cells.items() if i < len(lines)), default=-1)
            at = lambda c: cells[c][i] if c in cells and i < len(cells[c]) else ""  # noqa: B023, E731
            line = "  ".join(at(c).ljust(widths[c]) for c in range(last + 1)).rstrip()
            if line or i:  # a row without text has no line, but its cells keep their blank ones
                out.append(line)
    return out


def render(page: str) -> str:
    return "\n".join(flat(finished(_inside(build(page).children))))


def extracted(pages: DataFrame, key: str = "page_id", column: str = "html") -> DataFrame:
    """key, text, n_lines and n_chars of every page."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [render(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, "text"])

    rows = pages.select(key, text_or_empty(column).alias("html"))
    kind = pages.schema[key].dataType.simpleString()
    found = rows.mapInArrow(of, f"{key} {kind}, text string")
    lines = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n")))
    return found.select(key, "text", lines.cast("long").alias("n_lines"), F.length("text").cast("long").alias("n_chars"))
