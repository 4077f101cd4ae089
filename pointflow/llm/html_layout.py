"""Layout-aware text of HTML pages.

A tokenizer reads a page once from left to right; whatever stands in it is some
token, so no page fails. A tree builder closes what the next tag implies to be closed (paragraphs, list
items, table rows and cells, the head), moves stray content out of tables, and
forgives end tags that match nothing. A renderer walks the tree without
recursion and writes all visible text: blocks on lines of their own, paragraphs
with a blank line between, list items with their markers and indents, tables
with aligned columns, preformatted text as it is.

Not visible: comments, head, script, style and the like, elements with `hidden`
or `display:none`, text under `visibility:hidden` unless an inner element is
visible again, closed `details` but for their summary, closed dialogs, and of
drawings (`svg`) all but the text of their labels, each on a line of its own.

Defined results: a NULL or empty page, and one without visible text, gives the
empty text. Cells wider than MAX_PAD letters are not padded, so that one long
cell does not widen every row. Repeated rows get equal results; other columns
are carried along.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointflow.llm.tables import free_name, need_text, text_slices

MAX_PAD = 200
MAX_SPAN = 1000
MAX_INDENT = 80
MAX_TABLES = 16
# letters up to which a line is padded so that its next cell is aligned
MAX_PLACE = 2000
COLUMN_GAP = "  "

# fixed values: element groups of the HTML standard
VOID = set("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = set("head title script style template noscript datalist iframe object audio video canvas".split())
# of a drawing these are not shown, and its text only within these
HIDDEN_IN_SVG = set("title desc defs metadata symbol clippath mask marker pattern lineargradient radialgradient".split())
SVG_TEXT = {"text", "foreignobject"}
HEAD_PARTS = set("base link meta title script style template noscript".split())
LINE_BLOCKS = set(
    "address article aside body center div dd details dialog dt fieldset figcaption figure footer form header hgroup"
    " html legend li main nav option optgroup search section summary".split()
)
SPACED_BLOCKS = set("blockquote caption dl h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul".split())
BLOCKS = LINE_BLOCKS | SPACED_BLOCKS
CLOSES_P = BLOCKS - {"body", "caption", "html", "legend", "option", "optgroup"}
TABLE_PARTS = set("table caption colgroup col thead tbody tfoot tr td th".split())
SECTIONS = {"thead", "tbody", "tfoot"}
# start tag: the open elements it closes, and those beyond which it does not look
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
    "td": ({"td", "th", "caption", "colgroup"}, {"tr", "table"}),
    "th": ({"td", "th", "caption", "colgroup"}, {"tr", "table"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}),
    **{s: ({"td", "th", "tr", "caption", "colgroup", *SECTIONS}, {"table"}) for s in SECTIONS},
}
# an end tag does not reach out of these
WALLS = {"table", "td", "th", "caption"}

# content that is text up to the own end tag, without and with character references
RAW = set("script style xmp iframe noembed noframes".split())
RAW_WITH_REFERENCES = {"textarea", "title"}

SPACE = re.compile(r"[ \t\n\f\r]+")
STYLE_NONE = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
STYLE_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b", re.I)
TAG_NAME = re.compile(r"[a-zA-Z][^ \t\n\f\r/>]*")
ATTRIBUTE = re.compile(r"""[ \t\n\f\r/]*([^ \t\n\f\r/>][^ \t\n\f\r/>=]*)(?:[ \t\n\f\r]*=[ \t\n\f\r]*("[^"]*"?|'[^']*'?|[^ \t\n\f\r>"'][^ \t\n\f\r>]*)?)?""")
TAG_END = re.compile(r"[ \t\n\f\r/]*>")
COMMENT_END = re.compile(r"--!?>")
RAW_END = {t: re.compile(rf"</{t}(?=[ \t\n\f\r/>])", re.I) for t in RAW | RAW_WITH_REFERENCES}
# numbers of references: leading zeros say nothing, and longer ones than these are no characters
ZEROS = re.compile(r"&#([xX]?)0+(?=[0-9a-fA-F])")
NO_CHARACTER = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{7,});?")


def references(text: str) -> str:
    """`text` with its character references resolved, however long their numbers are."""
    if "&" not in text:
        return text
    return unescape(NO_CHARACTER.sub("\ufffd", ZEROS.sub(r"&#\1", text)))


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def _attributes(html: str, at: int) -> tuple[dict[str, str], int]:
    """The attributes from a place within a tag on, and the place behind the tag; -1 if the page ends before."""
    found: dict[str, str] = {}
    while True:
        if end := TAG_END.match(html, at):
            return found, end.end()
        part = ATTRIBUTE.match(html, at)
        if not part:
            return found, -1
        value = part[2] or ""
        if value[:1] in ("'", '"'):
            if len(value) < 2 or value[-1] != value[0]:
                return found, -1
            value = value[1:-1]
        found.setdefault(part[1].lower(), references(value))
        at = part.end()


class TreeBuilder:
    """A tree of Node and text from the tags of a page, read in one pass."""

    def __init__(self):
        self.root = Node("", {})
        self.open = [self.root]
        # where each tag is open, so that deep trees are not searched
        self.places: defaultdict[str, list[int]] = defaultdict(list)

    def feed(self, html: str) -> None:
        at, n = 0, len(html)
        text_from = 0

        def flush(stop: int) -> None:
            if stop > text_from:
                self._text(references(html[text_from:stop]))

        while (here := html.find("<", at)) >= 0:
            following = html[here + 1 : here + 2]
            if following == "!" or following == "?" or html.startswith("</", here) and not TAG_NAME.match(html, here + 2):
                if html.startswith("</", here) and here + 2 == n:
                    break
                flush(here)
                at = text_from = self._skip(html, here)
                continue
            name = TAG_NAME.match(html, here + 1 + (following == "/"))
            if not name:
                at = here + 1
                continue
            flush(here)
            attrs, at = _attributes(html, name.end())
            if at < 0:
                return
            text_from = at
            tag = name[0].lower()
            if following == "/":
                self.end(tag)
                continue
            self.start(tag, attrs)
            if tag in RAW_END:
                end = RAW_END[tag].search(html, at)
                body = html[at : end.start() if end else n]
                if body:
                    self._text(references(body) if tag in RAW_WITH_REFERENCES else body)
                at = text_from = end.start() if end else n
        flush(n)

    @staticmethod
    def _skip(html: str, here: int) -> int:
        """The place behind a comment or declaration."""
        if html.startswith("<!--", here):
            if html.startswith((">", "->"), here + 4):
                return html.index(">", here) + 1
            end = COMMENT_END.search(html, here + 4)
            return end.end() if end else len(html)
        end = html.find(">", here)
        return end + 1 if end >= 0 else len(html)

    def _add(self, child: Node | str, tag: str = "") -> None:
        """Append to the innermost element; what a table cannot hold goes before the table."""
        top = self.open[-1]
        stray = top.tag in ("table", "tr", *SECTIONS) and tag not in TABLE_PARTS and tag not in HIDDEN
        if not stray:
            top.children.append(child)
            return
        at = self.places["table"][-1]
        siblings = self.open[at - 1].children
        place = next(i for i in range(len(siblings) - 1, -1, -1) if siblings[i] is self.open[at])
        siblings.insert(place, child)

    def _innermost(self, tags: Iterable[str]) -> int:
        return max((self.places[t][-1] for t in tags if self.places[t]), default=0)

    def _close(self, tags: set[str], walls: set[str]) -> None:
        """Close the outermost open element of `tags` that lies within the nearest of `walls`."""
        wall, found = self._innermost(walls), len(self.open)
        for tag in tags:
            places = self.places[tag]
            inside = bisect_right(places, wall)
            if inside < len(places):
                found = min(found, places[inside])
        self._cut(found)

    def _cut(self, at: int) -> None:
        while len(self.open) > at:
            self.places[self.open.pop().tag].pop()

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        if self.open[-1].tag == "head" and tag not in HEAD_PARTS:
            self._cut(len(self.open) - 1)
        if tag in CLOSES_P:
            self._close({"p"}, WALLS)
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
        if tag in TABLE_PARTS and tag != "table":
            table = self._innermost(["table"])
            if not table or self._innermost(["td", "th", "caption"]) > table:
                return
            if tag in ("td", "th") and self.open[-1].tag in ("table", *SECTIONS):
                self._push(Node("tr", {}))
        node = Node(tag, attrs)
        if tag in VOID:
            self._add(node, tag)
        else:
            self._push(node)

    def _push(self, node: Node) -> None:
        self._add(node, node.tag)
        self.places[node.tag].append(len(self.open))
        self.open.append(node)

    def end(self, tag: str) -> None:
        place = self._innermost([tag])
        if place and place >= self._innermost({"table"} if tag in TABLE_PARTS else WALLS):
            self._cut(place)

    def _text(self, data: str) -> None:
        blank = not data.strip(" \t\n\f\r")
        if self.open[-1].tag == "head" and not blank:
            self._cut(len(self.open) - 1)
        if blank and self.open[-1].tag in TABLE_PARTS - {"td", "th", "caption"}:
            return
        self._add(data)


class Flow:
    """Lines of text with pending breaks, indents and a list marker."""

    def __init__(self):
        self.lines: list[str] = []
        # the line so far: its parts, its last letter, and whether it has ink
        self.parts: list[str] = []
        self.last = ""
        self.ink = False
        self.gap = 0
        self.indents: list[str] = []
        self.width = 0
        self.marker: str | None = None

    def text(self, data: str, pre: bool) -> None:
        if pre:
            first, *more = data.split("\n")
            self._put(first)
            for line in more:
                self.line()
                self._put(line)
            return
        data = SPACE.sub(" ", data)
        if self.last in ("", " "):
            data = data.removeprefix(" ")
        self._put(data)

    def _put(self, data: str) -> None:
        if data:
            self.parts.append(data)
            self.last = data[-1]
            self.ink = self.ink or data.strip(" ") != ""

    def _clear(self) -> None:
        self.parts, self.last, self.ink = [], "", False

    def _flush(self) -> None:
        line = "".join(self.parts).rstrip(" ")
        self._clear()
        if self.gap == 2 and self.lines and self.lines[-1]:
            self.lines.append("")
        self.gap = 0
        indent = " " * min(self.width, MAX_INDENT)
        if self.marker is not None and line:
            indent = " " * min(self.width - len(self.indents[-1]), MAX_INDENT) + self.marker
            self.marker = None
        self.lines.append((indent + line).rstrip(" "))

    def indent(self, blanks: str) -> None:
        self.indents.append(blanks)
        self.width += len(blanks)

    def outdent(self) -> None:
        if self.indents:
            self.width -= len(self.indents.pop())
            self.marker = None

    def line(self) -> None:
        """End the line even if it is empty."""
        self._flush()

    def block(self, gap: int) -> None:
        """End the line if there is one; the next text comes on a new line (1) or after a blank one (2)."""
        if self.ink:
            self._flush()
        self._clear()
        self.gap = max(self.gap, gap)

    def add_lines(self, lines: list[str]) -> None:
        for line in lines:
            self._put(line)
            self._flush()

    def finish(self) -> list[str]:
        self.block(0)
        lines = self.lines
        while lines and not lines[-1]:
            lines.pop()
        start = next((i for i, line in enumerate(lines) if line), 0)
        return lines[start:]


class Grid:
    """Cells of a table by row and column, with spans."""

    def __init__(self):
        self.rows: list[list[tuple[int, int, list[str]]]] = []
        # columns that earlier rows reach down into, as (first, behind, rows left), in order
        self.taken: list[tuple[int, int, int]] = []
        self.next = 0

    def row(self) -> None:
        self.rows.append([])
        taken: list[tuple[int, int, int]] = []
        for a, b, left in sorted(self.taken):
            if left > 1 and taken and taken[-1][1:] == (a, left - 1):
                taken[-1] = (taken[-1][0], b, left - 1)
            elif left > 1:
                taken.append((a, b, left - 1))
        self.taken, self.next = taken, 0

    def cell(self, lines: list[str], across: int, down: int) -> None:
        if not self.rows:
            self.row()
        at = self.rows[-1][-1][0] + self.rows[-1][-1][1] if self.rows[-1] else 0
        earlier = self.taken
        while self.next < len(earlier) and earlier[self.next][0] <= at:
            at = max(at, earlier[self.next][1])
            self.next += 1
        self.rows[-1].append((at, across, lines))
        if down > 1:
            # the row that follows sees one row less; the own row has no place left of its end
            self.taken.append((at, at + across, down))

    def layout(self) -> list[str]:
        """Lines of aligned cells; a column in which no cell begins takes no room."""
        width: dict[int, int] = {}
        for row in self.rows:
            for at, across, lines in row:
                wide = min(MAX_PAD, max(map(len, lines), default=0)) if across == 1 else 0
                width[at] = max(width.get(at, 0), wide)
        columns = sorted(width)
        starts = [0]
        for c in columns:
            starts.append(starts[-1] + width[c] + len(COLUMN_GAP))
        out = []
        for row in self.rows:
            for k in range(max((len(lines) for _, _, lines in row), default=0)):
                parts, length = [], 0
                for at, _, lines in row:
                    part = lines[k] if k < len(lines) else ""
                    if part:
                        # a cell that is wider than its column pushes the next one on
                        place = starts[bisect_left(columns, at)]
                        aligned = place <= MAX_PLACE and (not length or length + len(COLUMN_GAP) <= place)
                        parts += [" " * (place - length) if aligned else COLUMN_GAP, part]
                        length += len(parts[-2]) + len(part)
                out.append("".join(parts).rstrip(" "))
        return out


def _span(node: Node, name: str) -> int:
    value = (node.attrs.get(name) or "").strip().lstrip("0")
    if not (value.isascii() and value.isdigit()):
        return 1
    return min(MAX_SPAN, int(value)) if len(value) < 5 else MAX_SPAN


def _marker(item: Node, lists: list[list]) -> str:
    if not lists or lists[-1][0] != "ol":
        return "- "
    value = (item.attrs.get("value") or "").strip()
    if re.fullmatch(r"-?[0-9]{1,9}", value):
        lists[-1][1] = int(value)
    number = lists[-1][1]
    lists[-1][1] += 1
    return f"{number}. "


def _unseen(node: Node, parent: Node) -> bool:
    if node.tag in HIDDEN or "hidden" in node.attrs or STYLE_NONE.search(node.attrs.get("style") or ""):
        return True
    if node.tag == "dialog" and "open" not in node.attrs:
        return True
    return parent.tag == "details" and "open" not in parent.attrs and node.tag != "summary"


class Renderer:
    """Visible text of a tree.

    `stack` holds a frame per open element: node, next child, preformatted,
    visible, and within a drawing whether text is shown (else None).
    """

    def __init__(self, root: Node):
        self.flows, self.grids, self.lists = [Flow()], [], []
        self.stack = [[root, 0, False, True, None]]

    def run(self) -> str:
        while self.stack:
            frame = self.stack[-1]
            node, at, pre, shown, label = frame
            if at == len(node.children):
                self.stack.pop()
                self._leave(node, label)
                continue
            frame[1] += 1
            child = node.children[at]
            if isinstance(child, str):
                closed = node.tag == "details" and "open" not in node.attrs
                if shown and not closed and label is not False:
                    self.flows[-1].text(child, pre)
            elif not _unseen(child, node) and not (label is not None and child.tag in HIDDEN_IN_SVG):
                if child.tag == "svg":
                    label = False
                elif label is False and child.tag in SVG_TEXT:
                    label = True
                said = STYLE_VISIBILITY.search(child.attrs.get("style") or "")
                shown = said[1].lower() == "visible" if said else shown
                self._enter(child, label)
                self.stack.append([child, 0, pre or child.tag in ("pre", "textarea"), shown, label])
        return "\n".join(self.flows[0].finish())

    def _gap(self, tag: str) -> int:
        # a list within an item follows its line without a blank one
        return 1 if tag in LINE_BLOCKS or tag in ("ul", "ol", "menu") and self.lists else 2

    def _enter(self, node: Node, label: bool | None) -> None:
        flow, tag = self.flows[-1], node.tag
        if tag == "br":
            flow.line()
        elif tag in BLOCKS:
            flow.block(self._gap(tag))
        elif label and tag in SVG_TEXT:
            flow.block(1)
        if tag in ("ul", "ol", "menu"):
            start = (node.attrs.get("start") or "1").strip()
            self.lists.append([tag, int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1])
        elif tag == "li":
            flow.marker = _marker(node, self.lists)
            flow.indent(" " * len(flow.marker))
        elif tag in ("dd", "blockquote"):
            flow.indent("  ")
        elif tag == "table":
            self.grids.append(Grid() if len(self.grids) < MAX_TABLES else None)
        elif self.grids and tag in ("tr", "td", "th", "caption"):
            if self.grids[-1] is None:
                flow.block(1)
            elif tag == "tr":
                self.grids[-1].row()
            else:
                self.flows.append(Flow())

    def _leave(self, node: Node, label: bool | None) -> None:
        tag = node.tag
        grid = self.grids[-1] if self.grids else None
        if tag in ("td", "th", "caption") and grid:
            lines = self.flows.pop().finish()
            if tag == "caption":
                self.flows[-1].add_lines(lines)
            else:
                grid.cell(lines, _span(node, "colspan"), _span(node, "rowspan"))
        elif tag == "table" and self.grids:
            self.grids.pop()
            if grid:
                self.flows[-1].add_lines(grid.layout())
        flow = self.flows[-1]
        if tag in BLOCKS:
            gap = self._gap(tag)
            if tag in ("ul", "ol", "menu"):
                self.lists.pop()
                gap = self._gap(tag)
            flow.block(gap)
        elif label and tag in SVG_TEXT or tag in ("tr", "td", "th") and self.grids and grid is None:
            flow.block(1)
        if tag in ("li", "dd", "blockquote"):
            flow.outdent()


def visible_text(html: str | None) -> str:
    if not html:
        return ""
    builder = TreeBuilder()
    builder.feed(html)
    return Renderer(builder.root).run()


def extract_text(pages: DataFrame, html: str = "html", extracted: str = "extracted") -> DataFrame:
    """Adds the visible text as `extracted`; a column of that name stays, and underscores go behind the new one's."""
    need_text(pages, html)
    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in text_slices(batches):
            yield pa.array([visible_text(t) for t in texts], pa.string())

    return pages.withColumn(free_name(pages, extracted), run(html))
