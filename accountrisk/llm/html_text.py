"""Visible text of HTML pages, laid out: tree building with implied tags, visibility rules, rendering.

The tree builder reads tags, closes what a tag implies closed (p, li, dt, dd, tr, td, th, option, the table parts),
and ignores end tags that match nothing. A quote opens an attribute's value only right after its equals sign.
Rendering leaves out what a browser does not show (head, scripts, styles, comments, ``hidden``, ``display:none``,
options not selected, what inherits ``visibility:hidden`` and does not override it; ``aria-hidden`` is shown), keeps block spacing (one empty line
around paragraphs, headings, lists and tables, none around other blocks), numbers and indents lists, aligns the
columns of tables, cells spanning rows included, and keeps white space in ``pre``.

Cases: null and empty html give an empty text; broken markup and unclosed tags never fail; nesting is kept on a
stack of its own, so deep nesting cannot overflow the call stack. Rows are independent; an extra column with the
name of the result column is replaced.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from unicodedata import combining, east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountrisk.llm.common import steps

# fixed values of the HTML language
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript iframe noembed noframes object audio video canvas datalist title".split())
SVG_UNSEEN = frozenset("defs desc metadata symbol clippath mask marker pattern".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr".split())
BLOCK = SPACED | frozenset(
    "html body address article aside dd details dialog div dt fieldset figcaption footer form header hgroup legend li main menu nav search section summary caption thead tbody tfoot tr".split()
)
#: A start tag closes these open elements, up to the nearest of the limits.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
P_ENDS = BLOCK - {"html", "body", "caption", "thead", "tbody", "tfoot", "tr"}
SCOPE = frozenset("table td th caption button object html".split())

#: An attribute: name, then perhaps an equals sign and a value; a quoted value without an end goes on to the end.
_VALUE = r"\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|(?![\"'])[^\s>]*+"
_TAG = re.compile(rf"<(?:!--(?:.*?--!?>|.*\Z)|[!?][^>]*>?|(/?)([A-Za-z][^\s/>]*)((?:[\s/]++|[^\s/>][^\s=/>]*+(?:\s*+=\s*+(?:{_VALUE}))?)*+)>?)", re.S)
_ATTRIBUTE = re.compile(r"([^\s/>][^\s=/>]*+)(?:\s*+=\s*+(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]*)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*([a-z]+)", re.I)
_SPACE = re.compile(r"[ \t\n\f\r]+")


class Node:
    __slots__ = ("name", "attributes", "children")

    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes, self.children = name, attributes, []


class Stack(list):
    """Open elements, with a count of each name, so that a search for a name that is not open costs nothing."""

    def __init__(self, root: Node):
        super().__init__([root])
        self.count: Counter[str] = Counter()

    def push(self, node: Node) -> None:
        self.append(node)
        self.count[node.name] += 1

    def cut(self, k: int) -> None:
        self.count.subtract(node.name for node in self[k:])
        del self[k:]


def attributes_of(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def tree_of(source: str) -> Node:
    """The element tree below a nameless root; text stands in ``children`` as strings."""
    root = Node("", {})
    stack = Stack(root)
    at = 0
    while at < len(source):
        tag = _TAG.search(source, at)
        text = source[at : tag.start()] if tag else source[at:]
        if text:
            stack[-1].children.append(html.unescape(text))
        if not tag:
            break
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if tag[1]:
            end_tag(stack, name)
            continue
        start_tag(stack, name)
        node = Node(name, attributes_of(tag[3]) if tag[3] else {})
        if name in SVG_UNSEEN and stack.count["svg"]:
            node.attributes["hidden"] = ""
        stack[-1].children.append(node)
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(source, at)
            inner = source[at : close.start()] if close else source[at:]
            node.children.append(inner)
            at = close.end() if close else len(source)
        elif name not in VOID:
            stack.push(node)
    return root


def start_tag(stack: Stack, name: str) -> None:
    """Close what the start tag implies closed, and add the parts of a table that it implies open."""
    if name in P_ENDS:
        close_up_to(stack, {"p"}, SCOPE)
    closes, limits = CLOSES.get(name, (set(), set()))
    while closes and close_up_to(stack, closes, limits | {"table"} if name in ("tr", "td", "th") else limits):
        pass
    if name in ("td", "th") and stack[-1].name in ("table", "thead", "tbody", "tfoot"):
        row = Node("tr", {})
        stack[-1].children.append(row)
        stack.push(row)


def close_up_to(stack: Stack, names: set[str], limits) -> bool:
    """Close the nearest open element of those names and all inside it, unless a limit stands between."""
    if not any(stack.count[n] for n in names):
        return False
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name in names:
            stack.cut(k)
            return True
        if stack[k].name in limits:
            return False
    return False


def end_tag(stack: Stack, name: str) -> None:
    if name == "p":
        close_up_to(stack, {"p"}, SCOPE)
    elif name == "br":
        stack[-1].children.append(Node("br", {}))
    elif name in ("td", "th", "tr", "li"):
        close_up_to(stack, {name}, {"table"} if name != "li" else {"ul", "ol", "menu", "table"})
    else:
        close_up_to(stack, {name}, {"td", "th"} if name not in ("table", "tr", "tbody", "thead", "tfoot", "html", "body") else set())


def is_hidden(node: Node) -> bool:
    a = node.attributes
    if node.name in UNSEEN or (node.name == "dialog" and "open" not in a):
        return True
    if node.name == "input":
        return a.get("type", "").lower() == "hidden"
    return bool(a) and ("hidden" in a or bool(_NO_DISPLAY.search(a.get("style", ""))))


def shows(node: Node, inherited: bool) -> bool:
    """Whether the text right below a node is visible, by its last ``visibility`` or else by what it inherits."""
    said = _VISIBILITY.findall(node.attributes.get("style", "")) if node.attributes else []
    for value in map(str.lower, reversed(said)):
        if value in ("visible", "initial"):
            return True
        if value in ("hidden", "collapse"):
            return False
        if value in ("inherit", "unset"):
            return inherited
    return inherited


def selected(select: Node) -> list[Node]:
    """The options a select shows: the chosen ones, of a drop-down the last chosen or else the first; all of a list box."""
    found, todo = [], [*reversed(select.children)]
    while todo:
        node = todo.pop()
        if isinstance(node, Node) and not is_hidden(node):
            if node.name == "option":
                found.append(node)
            else:
                todo += reversed(node.children)
    if "multiple" in select.attributes or number(select.attributes.get("size"), 1) > 1:
        return found
    return [o for o in found if "selected" in o.attributes][-1:] or [o for o in found if "disabled" not in o.attributes][:1]


class Layout:
    """Collects lines: inline text flows into the current line, blocks end it."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = False  # an empty line is due before the next text
        self.space = False  # a collapsed space is due before the next word
        self.prefix: list[str] = []  # per open list item or quote: indentation
        self.marker = ""

    def text(self, value: str) -> None:
        parts = _SPACE.split(value)
        for k, part in enumerate(parts):
            if k:
                self.space = True
            if part:
                if self.line and self.space:
                    self.line.append(" ")
                self.line.append(part)
                self.space = False

    def raw(self, value: str) -> None:
        first, *rest = value.split("\n")
        self.line.append(first)
        for x in rest:
            self.end_line(True)
            self.line.append(x)

    def end_line(self, even_empty: bool = False) -> None:
        text = "".join(self.line).rstrip(" \t")
        self.line, self.space = [], False
        if text or even_empty:
            self.put(text)

    def put(self, text: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        indent = "".join(self.prefix)
        if self.marker:
            indent = indent[: len(indent) - len(self.marker)] + self.marker
            self.marker = ""
        self.lines.append((indent + text).rstrip())

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.gap |= spaced


def width_of(text: str) -> int:
    return len(text) if text.isascii() else sum(0 if combining(c) else 2 if east_asian_width(c) in "WF" else 1 for c in text)


def number(text: str | None, default: int) -> int:
    try:
        return int(text) if text is not None else default
    except ValueError:
        return default


def aligned(rows: list[list[tuple[str, int]]]) -> list[str]:
    """Lines of a table whose cells are (text, columns spanned)."""
    widths: list[int] = []
    cells = [[(text.split("\n"), span) for text, span in row] for row in rows]
    for row in cells:
        column = 0
        for lines, span in row:
            widths += [0] * (column + span - len(widths))
            if span == 1:
                widths[column] = max(widths[column], *map(width_of, lines))
            column += span
    out = []
    for row in cells:
        for k in range(max((len(lines) for lines, _ in row), default=0)):
            column, parts = 0, []
            for lines, span in row:
                text = lines[k] if k < len(lines) else ""
                room = sum(widths[column : column + span]) + 3 * (span - 1)
                parts.append(text + " " * max(0, room - width_of(text)))
                column += span
            out.append(" | ".join(parts).rstrip())
    return out


def text_of(node: Node) -> str:
    """All text below a node, one after the other."""
    out, todo = [], [node]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            out.append(node)
        elif not is_hidden(node):
            todo += reversed(node.children)
    return "".join(out).strip()


def spanned(rows: list[list[tuple[str, int, int]]], ends: list[int]) -> list[list[tuple[str, int]]]:
    """Rows of (text, columns spanned) from (text, columns, rows spanned), with empty cells below those that span rows;
    no cell goes beyond the end of its section (a span of 0 rows goes up to it)."""
    below: dict[int, tuple[int, int]] = {}  # column: first row that is free again, column after the cell
    out = []
    for k, row in enumerate(rows):
        column, cells = 0, []
        for text, span, down in row:
            while column in below:
                cells.append(("", below[column][1] - column))
                column = below[column][1]
            end = min(ends[k], k + down) if down else ends[k]
            below |= {c: (end, column + span) for c in range(column, column + span) if end > k + 1}
            cells.append((text, span))
            column += span
        last = max((c for c, (end, _) in below.items()), default=-1)
        while column <= last:
            after = below[column][1] if column in below else column + 1
            cells.append(("", after - column))
            column = after
        out.append(cells)
        below = {c: x for c, x in below.items() if x[0] > k + 1}
    return out


def table_rows(table: Node, visible: bool = True) -> tuple[list[tuple], list[tuple], list[int], list[tuple]]:
    """(captions, rows, ends, rest) of a table, rows of its sections too, each node with whether its text is visible;
    ends are the numbers of the first rows beyond each row's section. The rest stands outside of cells, where a browser
    takes it out of the table."""
    captions, rows, parts, rest = [], [], [], []
    todo = [(c, visible, 0) for c in reversed(table.children)]
    sections = 0
    while todo:
        child, seen, part = todo.pop()
        name = child.name if isinstance(child, Node) else ""
        if name and is_hidden(child):
            continue
        if name == "tr":
            own = shows(child, seen)
            rows.append((child, own))
            parts.append(part)
            rest += [(c, own) for c in child.children if not (isinstance(c, Node) and c.name in ("td", "th"))]
        elif name == "caption":
            captions.append((child, shows(child, seen)))
        elif name in ("thead", "tbody", "tfoot"):
            sections += 1
            own = shows(child, seen)
            todo += [(c, own, sections) for c in reversed(child.children)]
        elif name != "colgroup":
            rest.append((child, seen))
    ends, end = [0] * len(rows), len(rows)
    for k in range(len(rows) - 1, -1, -1):
        if k + 1 < len(rows) and parts[k] != parts[k + 1]:
            end = k + 1
        ends[k] = end
    return captions, rows, ends, rest


#: Tables deeper than this in one another are laid out as blocks, with all their text.
TABLE_DEPTH = 8


def rendered(root: Node, depth: int = 0, visible: bool = True) -> str:
    """The visible text below a node. The walk keeps its own stack; only tables call themselves, for their cells."""
    layout = Layout()
    todo: list[tuple] = [("open", root, None, False, visible)]
    while todo:
        what, node, extra, pre, seen = todo.pop()
        if what == "close":
            if node.name in BLOCK:
                layout.block(node.name in SPACED and not (node.name in ("ul", "ol") and extra))
            if node.name in ("li", "blockquote", "dd") and layout.prefix:
                layout.prefix.pop()
                layout.marker = ""
            continue
        if isinstance(node, str):
            if seen:
                layout.raw(node) if pre else layout.text(node)
            continue
        if is_hidden(node):
            continue
        name = node.name
        seen = shows(node, seen)
        if name == "br":
            layout.end_line(True)
            continue
        if name == "hr":
            layout.block(True)
            continue
        if name in ("img", "input"):
            if seen:
                layout.text(node.attributes.get("alt" if name == "img" else "value", ""))
            continue
        if name == "textarea":
            value = html.unescape("".join(node.children))
            if seen:
                if layout.line and layout.space:
                    layout.line.append(" ")
                layout.space = False
                layout.raw(value[1:] if value.startswith("\n") else value)
            continue
        if name == "select":
            for k, option in enumerate(selected(node)):
                if k:
                    layout.text(" ")
                if shows(option, seen):
                    layout.text(option.attributes.get("label") or text_of(option))
            continue
        if name == "table" and depth < TABLE_DEPTH:
            layout.block(True)
            captions, rows, ends, rest = table_rows(node, seen)
            for c, own in captions:
                for line in rendered(Node("", {}) if not c.children else inner(c), depth + 1, own).split("\n"):
                    layout.put(line)
            cells = [
                [
                    (rendered(inner(c), depth + 1, shows(c, own)), max(1, min(1000, number(c.attributes.get("colspan"), 1))), max(0, min(65534, number(c.attributes.get("rowspan"), 1))))
                    for c in r.children
                    if isinstance(c, Node) and c.name in ("td", "th") and not is_hidden(c)
                ]
                for r, own in rows
            ]
            for line in aligned(spanned(cells, ends)):
                layout.put(line)
            todo += [("open", c, None, False, own) for c, own in reversed(rest)]
            layout.gap = True
            continue
        nested = name in ("ul", "ol") and extra == "item"
        if name in BLOCK:
            layout.block(name in SPACED and not nested)
        if name == "li":
            marker = extra if isinstance(extra, str) and extra not in ("item", "") else "- "
            layout.prefix.append(" " * len(marker))
            layout.marker = marker
        elif name in ("blockquote", "dd"):
            layout.prefix.append("> " if name == "blockquote" else "  ")
        elif name in ("td", "th", "text"):
            layout.text(" ")
        keep = pre or name == "pre"
        todo.append(("close", node, nested, pre, seen))
        count = number(node.attributes.get("start"), 1) if name == "ol" else 0
        opened = []
        for child in node.children:
            about = "item" if name == "li" else None
            if isinstance(child, Node) and child.name == "li":
                if name == "ol":
                    count = number(child.attributes.get("value"), count)
                    about = f"{count}. "
                    count += 1
                else:
                    about = "- "
            opened.append(("open", child, about, keep, seen))
        todo += reversed(opened)
    layout.end_line()
    while layout.lines and not layout.lines[-1]:
        layout.lines.pop()
    return "\n".join(layout.lines).lstrip("\n")


def inner(node: Node) -> Node:
    """The content of a node, without its own block rules."""
    out = Node("", {})
    out.children = node.children
    return out


def visible_text(source: str | None) -> str:
    return rendered(tree_of(source)) if source else ""


def extract_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with ``out_col``, the visible text of ``html_col``."""
    base = pages.drop(out_col).withColumn(html_col, F.col(html_col).cast("string"))
    at = base.columns.index(html_col)

    def run(batches):
        for batch in batches:
            for part in steps(batch, batch.schema.names[at]):
                text = pa.array([visible_text(x) for x in part.column(at).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, text], [*part.schema.names, out_col])

    return base.mapInArrow(run, base.withColumn(out_col, F.lit(None).cast("string")).schema)
