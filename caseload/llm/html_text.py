"""Layout-aware text of HTML pages.

A tree builder reads the tags, adds the implied ones (a list item ends the one
before it, a block ends a paragraph, cells get rows) and a renderer walks the
tree: hidden elements leave nothing, blocks stand on lines of their own with
blank lines where a browser leaves a margin, lists get markers and indents,
and the cells of a table are aligned in columns.  Both walk with a stack of
their own, so nesting may be as deep as it likes.  Of a drop-down list the
chosen option shows, of a drawing its text elements, of an object what stands
in for it; a visible child of an invisible element shows.

Each page is one row of one task; nothing is shuffled.

Edge cases: a null or empty page gives an empty text; a page of any length is
rendered whole; markup that breaks off ends where it breaks off, malformed
declarations are comments, numbers out of bounds count as the bound that the
HTML standard sets; repeated rows give equal texts; other columns, whatever
their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the HTML standard: which elements are void, never shown, blocks, or end others.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head title script style template noscript noembed noframes iframe canvas audio video annotation "
                   "annotation-xml datalist meta link base col colgroup input area map param source track".split())
SVG_UNSEEN = frozenset("title desc metadata defs symbol clippath mask pattern marker style script".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p "
                   "plaintext pre search section summary ul caption xmp".split())
MARGINS = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr menu ol p plaintext pre table ul dir xmp".split())
LISTS = frozenset("ul ol menu dir".split())
ENDS_PARAGRAPH = (BLOCKS | {"table"}) - frozenset("body html option optgroup caption legend".split())
ROWS = frozenset("tbody thead tfoot".split())
CELLS = frozenset("td th".split())
#: start tag -> (elements it ends, elements beyond which it does not look)
IMPLIED_ENDS = {
    "li": (frozenset(["li"]), LISTS),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (CELLS, frozenset(["tr", "table"])),
    "th": (CELLS, frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "tbody": (ROWS | {"tr", "caption", "colgroup"}, frozenset(["table"])),
    "thead": (ROWS | {"tr", "caption", "colgroup"}, frozenset(["table"])),
    "tfoot": (ROWS | {"tr", "caption", "colgroup"}, frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}
_BARRIERS = frozenset("table td th caption html template button object".split())
#: The largest spans and list numbers.
MOST_COLUMNS, MOST_ROWS, MOST_NUMBER = 1000, 65534, (1 << 31) - 1
PREFORMATTED = frozenset("pre textarea xmp plaintext".split())
_NUMBER = re.compile(r"[ \t\n\r\f]*([+-]?)0*([0-9]+)")
_REFERENCE_ZEROS = re.compile(r"&#0+(?=[0-9])")
_LONG_REFERENCE = re.compile(r"&#[0-9]{8,};?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
BULLET = "- "
GAP = "  "  # between columns


class _Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []


class TreeBuilder(HTMLParser):
    """The tree of a page below ``root``; text nodes are strings."""

    CDATA_CONTENT_ELEMENTS = ("script", "style", "xmp", "plaintext")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("html", {})
        self.open = [self.root]

    def _end(self, tags: frozenset, barriers: frozenset) -> None:
        """Close the innermost open element among ``tags`` unless a barrier lies before it."""
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k].tag
            if tag in tags:
                del self.open[k:]
                return
            if tag in barriers:
                return

    def _start(self, tag: str, attrs: dict) -> None:
        node = _Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("html", "body"):  # one body: the page itself
            return
        if tag in ENDS_PARAGRAPH:
            self._end(frozenset(["p"]), _BARRIERS)
        if tag in IMPLIED_ENDS:
            ends, barriers = IMPLIED_ENDS[tag]
            self._end(ends, barriers)
        here = self.open[-1].tag
        if tag in CELLS and here in ROWS | {"table"}:
            self._start("tr", {})
        if self.open[-1].tag == "head" and tag not in UNSEEN:
            self.open.pop()
        self._start(tag, dict(attrs))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "br":
            self._start("br", {})
        elif tag == "p" and not any(n.tag == "p" for n in self.open):
            self._start("p", {})
            self.open.pop()
        else:
            barriers = frozenset() if tag in ("table", "tr") or tag in ROWS else frozenset(["table"]) if tag in CELLS \
                else frozenset(["td", "th", "table", "caption"]) - {tag}
            self._end(frozenset([tag]), barriers)

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip():
            self.open.pop()
        self.open[-1].children.append(data)

    def set_cdata_mode(self, elem: str, **more) -> None:
        super().set_cdata_mode(elem, **more)
        if elem == "plaintext":  # nothing ends it
            self.interesting = re.compile("(?!)")

    def parse_html_declaration(self, i: int) -> int:
        """``<![`` starts a comment, but for character data in drawings and formulas."""
        if not self.rawdata.startswith("<![", i):
            return super().parse_html_declaration(i)
        if self.rawdata.startswith("<![CDATA[", i) and any(n.tag in ("svg", "math") for n in self.open):
            end = self.rawdata.find("]]>", i)
            self.handle_data(self.rawdata[i + 9:end] if end >= 0 else self.rawdata[i + 9:])
            return end + 3 if end >= 0 else len(self.rawdata)
        return self.parse_bogus_comment(i)

    def build(self, html: str) -> _Node:
        # no character has so large a number, and Python does not read one of thousands of digits
        self.feed(_LONG_REFERENCE.sub("\ufffd", _REFERENCE_ZEROS.sub("&#", html)))
        if self.cdata_elem in ("xmp", "plaintext"):
            self.handle_data(self.rawdata)
        if self.rawdata.startswith("<") or self.cdata_elem:
            self.rawdata = ""  # a tag or an unseen text that never ends
        self.close()
        return self.root


def _number(text: str | None, default: int, least: int, most: int) -> int:
    """The whole number that a text begins with, held within bounds."""
    found = _NUMBER.match(text or "")
    if not found:
        return default
    n = most if len(found[2]) > 12 else int(found[2])
    return min(max(-n if found[1] == "-" else n, least), most)


def _shown(node: _Node, visible: bool) -> tuple[bool, bool]:
    """(whether the element is there at all, whether its text is visible)."""
    there = node.tag not in UNSEEN and "hidden" not in node.attrs
    for part in (node.attrs.get("style") or "").lower().split(";"):
        name, _, value = part.partition(":")
        value = value.split("!")[0].strip()
        if name.strip() == "display":
            there = there and value != "none"
        elif name.strip() == "visibility":
            visible = visible if value == "inherit" else value not in ("hidden", "collapse")
    return there, visible


def _options(select: _Node) -> list:
    """What a list of options shows: all of them, or the text of the chosen one."""
    options, walk = [], [select]
    while walk:
        node = walk.pop()
        if node.tag == "option" and _shown(node, True)[0]:
            options.append(node)
        else:
            walk.extend(c for c in reversed(node.children) if not isinstance(c, str))
    if "multiple" in select.attrs or _number(select.attrs.get("size"), 1, 0, MOST_NUMBER) > 1:
        return options
    chosen = [o for o in options if "selected" in o.attrs][-1:] or [o for o in options if "disabled" not in o.attrs][:1]
    return [" ", *chosen[0].children, " "] if chosen else []


def width(text: str) -> int:
    """Columns that a text takes in a fixed-width display."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class _Flow:
    """Lines being written: the page, or a cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.words: list[str] = []  # of the open line, with their blanks
        self.margin = False  # a blank line is due before the next text
        self.indent = ""
        self.marker = ""  # of the list item that has no text yet

    def text(self, data: str, pre: bool) -> None:
        if pre:
            first, *rest = data.replace("\r\n", "\n").split("\n")
            self._add(first)
            for line in rest:
                self.newline(True)
                self._add(line)
            return
        data = _SPACE.sub(" ", data)
        if data.startswith(" ") and (not self.words or self.words[-1].endswith(" ")):
            data = data[1:]
        self._add(data)

    def _add(self, data: str) -> None:
        if data:
            self.words.append(data)

    def newline(self, always: bool = False) -> None:
        """End the open line; an empty one counts if ``always``."""
        line = "".join(self.words).rstrip(" \t\n")
        self.words = []
        if line or self.marker and always:
            self.put([line])
        elif always and self.lines and not self.margin:
            self.lines.append("")

    def put(self, lines: list[str]) -> None:
        """Finished lines, behind the due margin and the item's marker."""
        if self.margin and self.lines and self.lines[-1]:
            self.lines.append("")
        self.margin = False
        for line in lines:
            lead = self.indent
            if self.marker:
                lead = self.indent[:len(self.indent) - len(self.marker)] + self.marker
                self.marker = ""
            self.lines.append((lead + line).rstrip())

    def block(self, margin: bool) -> None:
        self.newline()
        self.margin |= margin

    def done(self) -> list[str]:
        self.newline()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


class _Table:
    """The cells of a table as they are rendered: (row, column, spans, lines)."""

    def __init__(self):
        self.row, self.column, self.cells, self.captions = -1, 0, [], []
        self.below: dict[int, int] = {}  # column -> first row that no cell from above reaches

    def next_row(self) -> None:
        self.row, self.column = self.row + 1, 0

    def add(self, attrs: dict, lines: list[str]) -> None:
        if self.row < 0:
            self.next_row()
        across = _number(attrs.get("colspan"), 1, 1, MOST_COLUMNS)
        down = _number(attrs.get("rowspan"), 1, 0, MOST_ROWS) or MOST_ROWS
        while self.below.get(self.column, 0) > self.row:
            self.column += 1
        if down > 1:
            for c in range(self.column, self.column + across):
                self.below[c] = max(self.below.get(c, 0), self.row + down)
        self.cells.append((self.row, self.column, across, lines))
        self.column += across

    def lines(self) -> list[str]:
        widths: dict[int, int] = {}
        for _, column, span, lines in sorted(self.cells, key=lambda c: c[2]):
            most = max(map(width, lines), default=0)
            filled = [widths[c] for c in range(column, column + span) if widths.get(c)]  # only these have gaps between them
            have, last = sum(filled) + len(GAP) * max(0, len(filled) - 1), column + span - 1
            widths.setdefault(last, 0)
            if most > have:
                new_gap = len(GAP) if filled and not widths[last] else 0
                widths[last] += max(1, most - have - new_gap)
        at, places = 0, {}
        for c in range(max(max(widths, default=-1), max((c for _, c, _, _ in self.cells), default=-1)) + 1):
            places[c] = at
            at += widths.get(c, 0) + (len(GAP) if widths.get(c, 0) else 0)
        out = [x for caption in self.captions for x in caption]
        rows: dict[int, list] = {}
        for row, column, _, lines in self.cells:
            rows.setdefault(row, []).append((places[column], lines))
        for row in sorted(rows):
            for k in range(max((len(lines) for _, lines in rows[row]), default=0)):
                line, used = "", 0
                for place, lines in rows[row]:
                    if k < len(lines) and lines[k]:
                        line += " " * (place - used) + lines[k]
                        used = max(place, used) + width(lines[k])
                out.append(line)
        return out


def render(root: _Node) -> str:
    """The visible text of a tree."""
    page = _Flow()
    flows, tables, lists = [page], [], []
    pre = 0
    # (node, whether it ends here, whether its text is visible, whether it is in a drawing)
    stack: list = [(root, False, True, False)]
    while stack:
        node, leaving, visible, drawing = stack.pop()
        flow = flows[-1]
        if isinstance(node, str):
            table = tables[-1] if tables else None
            blank_row = table and table[1] == len(flows) and not node.strip()  # between rows
            if visible and not drawing and not blank_row:
                flow.text(node, pre > 0)
            continue
        tag = node.tag
        if leaving:
            if tag in CELLS or tag == "caption":
                if tables and len(flows) > 1 and flows[-1] is not page:
                    lines = flows.pop().done()
                    if tag == "caption":
                        tables[-1][0].captions.append(lines)
                    else:
                        tables[-1][0].add(node.attrs, lines)
            elif tag == "table":
                flows[-1].block(True)
                lines = tables.pop()[0].lines()
                if lines:
                    flows[-1].put(lines)
                flows[-1].margin = True
            elif tag in LISTS:
                flow.block(len(lists) == 1)
                lists.pop()
            elif tag in ("li", "dd", "blockquote"):
                flow.block(tag == "blockquote")
                flow.indent, flow.marker = flow.indent[:len(flow.indent) - node.attrs.pop("\0", 0)], ""
            elif tag == "q":
                flow.text("”" * visible, False)
            elif tag in BLOCKS or tag == "\0text":
                flow.block(tag in MARGINS)
            if tag in PREFORMATTED:
                pre -= 1
            continue
        there, visible = _shown(node, visible)
        if not there or drawing and tag in SVG_UNSEEN:
            continue
        children = node.children
        if tag == "br":
            if visible and not drawing:
                flow.newline(True)
            continue
        if tag in ("img", "embed", "wbr"):
            continue
        if tag == "table":
            flow.block(True)
            tables.append((_Table(), len(flows)))
        elif tag == "tr" and tables:
            tables[-1][0].next_row()
        elif tag in CELLS or tag == "caption":
            if not tables:  # a cell of no table is a block
                node.tag = "div"
                flow.block(False)
            else:
                flows.append(_Flow())
        elif tag in LISTS:
            flow.block(not lists)
            lists.append(_number(node.attrs.get("start"), 1, -MOST_NUMBER, MOST_NUMBER) if tag == "ol" else None)
        elif tag in ("li", "dd", "blockquote"):
            flow.block(tag == "blockquote")
            lead = GAP
            if tag == "li":
                number = lists[-1] if lists else None
                if number is not None:
                    number = _number(node.attrs.get("value"), number, -MOST_NUMBER, MOST_NUMBER)
                lead = BULLET if number is None else f"{number}. "
                if number is not None:
                    lists[-1] = number + 1
                flow.marker = lead if visible else ""
            flow.indent += " " * len(lead)
            node.attrs["\0"] = len(lead)
        elif tag == "q":
            flow.text("“" * visible, False)
        elif tag in BLOCKS:
            flow.block(tag in MARGINS)
        elif drawing and tag in ("text", "foreignobject"):
            node.tag, drawing = "\0text", False
            flow.block(False)
        elif tag == "svg":
            drawing = True
        elif tag == "select":
            children = _options(node)
        if tag in PREFORMATTED:
            pre += 1
            if children and isinstance(children[0], str) and children[0].startswith("\n"):
                children = [children[0][1:], *children[1:]]
        if tag == "details" and "open" not in node.attrs:
            children = [c for c in children if not isinstance(c, str) and c.tag == "summary"][:1]
        stack.append((node, True, visible, drawing))
        stack.extend((c, False, visible, drawing) for c in reversed(children))
    return "\n".join(page.done())


def text_of(html: str | None) -> str:
    """The visible text of a page."""
    return render(TreeBuilder().build(html)) if html else ""


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [text_of(h.as_py()) for h in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                                 ["page_id", "url", "text"])

    fields = pages.select("page_id", "url", F.col("html").cast("string").alias("text")).schema
    return pages.select("page_id", "url", F.col("html").cast("string")).mapInArrow(run, fields)
