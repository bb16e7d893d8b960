"""The visible text of a web page, laid out as it would be seen: blocks apart, lists marked, table cells aligned."""

from __future__ import annotations

import re
from collections.abc import Callable
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changevault.llm.tasks import per_text

# How elements behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head title script style template noscript iframe object audio video canvas datalist "
                   "noframes select metadata annotation annotation-xml defs desc".split())
#: Blank lines around (2) or a new line (1).
BLOCKS = {tag: 2 for tag in "p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr fieldset".split()} | {
    tag: 1 for tag in "html body div section article main header footer nav aside address form li dt dd tr caption "
                      "figcaption details summary thead tbody tfoot legend menu dir center".split()}
#: A start tag ends these open elements, looked for no further out than the second set.
_P_ENDS = frozenset("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 "
                    "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li dt dd".split())
_CELL = frozenset({"td", "th", "caption", "table", "html", "button"})
IMPLIED = {
    "li": ({"li"}, frozenset({"ul", "ol", "menu", "dir"}) | _CELL),
    "dt": ({"dt", "dd"}, frozenset({"dl"}) | _CELL), "dd": ({"dt", "dd"}, frozenset({"dl"}) | _CELL),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, frozenset({"table"})),
    "td": ({"td", "th"}, frozenset({"tr", "table"})), "th": ({"td", "th"}, frozenset({"tr", "table"})),
    "option": ({"option"}, frozenset({"select", "datalist"})), "body": ({"head"}, frozenset({"html"})),
} | {tag: ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, frozenset({"table"}))
     for tag in ("thead", "tbody", "tfoot")}
#: What may stand in a head; any other start tag, or text, ends it.
_IN_HEAD = frozenset("head base basefont bgsound link meta title style script noscript template noframes html".split())
_HIDING = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
_CUT_OFF = re.compile("</?[A-Za-z]|<[!?]")
#: A column is widened up to this for alignment; longer cells stand whole and push what follows.
COLUMN = 40
# The most columns and rows a cell may span.
COLSPAN, ROWSPAN = 1000, 65534


class _Flow:
    """Lines of one stream of text: the page, or a cell of a table."""

    def __init__(self, lists: int = 0, span: tuple[int, int] = (1, 1)) -> None:
        self.parts: list[str] = []
        self.breaks, self.space, self.marker = 0, False, ""
        self.lists, self.span = lists, span  # lists around it; of a cell, the columns and rows it spans

    def apart(self, lines: int) -> None:
        self.breaks, self.space = max(self.breaks, lines), False

    def open(self, indent: str) -> None:
        if self.breaks or not self.parts:
            if self.parts:
                self.parts.append("\n" * self.breaks)
            self.parts.append(indent[:-2] + self.marker if self.marker else indent)
            self.breaks, self.marker = 0, ""
        elif self.space:
            self.parts.append(" ")
        self.space = False

    def text(self) -> str:
        return "".join(self.parts).strip("\n")


class _Table:
    """Rows of cells by column. A cell that spans rows keeps its columns taken in the rows below."""

    def __init__(self) -> None:
        self.rows: list[dict[int, list[str]]] = []
        self.taken: dict[int, int] = {}  # column -> how many rows below are taken

    def row(self) -> None:
        self.rows.append({c: [] for c, left in self.taken.items() if left})
        self.taken = {c: left - 1 for c, left in self.taken.items() if left}

    def cell(self, text: str, span: tuple[int, int]) -> None:
        row, column = self.rows[-1], 0
        while column in row:
            column += 1
        row[column] = [line.rstrip() for line in text.split("\n") if line.strip()]
        for c in range(column, column + span[0]):
            row.setdefault(c, [])
            if span[1] > 1:
                self.taken[c] = span[1] - 1

    def lines(self) -> list[str]:
        width: dict[int, int] = {}
        for row in self.rows:
            for c, cell in row.items():
                width[c] = max([width.get(c, 0), *(min(len(line), COLUMN) for line in cell)])
        out = []
        for row in self.rows:
            for i in range(max(map(len, row.values()), default=0)):
                cells = [row.get(c, []) for c in range(max(row) + 1)]
                out.append(" | ".join((cell[i] if i < len(cell) else "").ljust(width.get(c, 0)) for c, cell in enumerate(cells)).rstrip())
        return out


class Page(HTMLParser):
    """Builds the tree of open elements, with implied end tags, and lays text out as elements open and close."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # open elements, whether each hides what is in it, and whether text outside it was invisible
        self.stack: list[tuple[str, bool, bool]] = []
        self.open_count: dict[str, int] = {}
        self.hidden = self.pre = 0
        self.veiled = False
        self.flows, self.tables = [_Flow()], []
        self.lists: list[list] = []

    # the tree

    def end_head(self) -> None:
        if self.stack and self.stack[-1][0] == "head":
            self.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in _IN_HEAD:
            self.end_head()
        if tag in _P_ENDS and self.open_count.get("p"):
            self.end_to({"p"}, _CELL)
        if tag in IMPLIED:
            ends, scope = IMPLIED[tag]
            while self.end_to(ends, scope):
                pass
        if tag in ("td", "th") and self.open_count.get("table") and not self.inside("tr", "table"):
            self.push("tr", {})
        given = dict(attrs)
        self.push(tag, given)
        if tag in VOID:
            self.pop()

    def in_foreign(self) -> bool:
        """Whether SVG or MathML is being read, where CDATA sections and slashes that close count."""
        if not (self.open_count.get("svg") or self.open_count.get("math")):
            return False
        for name, *_ in reversed(self.stack):
            if name in ("svg", "math", "foreignobject", "annotation-xml"):
                return name in ("svg", "math")
        return False

    def parse_html_declaration(self, i: int) -> int:
        """``<![`` starts a comment up to the next ``>``, but a CDATA section in SVG and MathML."""
        if not self.rawdata.startswith("<![", i):
            return super().parse_html_declaration(i)
        if not (self.rawdata.startswith("<![CDATA[", i) and self.in_foreign()):
            return self.parse_bogus_comment(i)
        end = self.rawdata.find("]]>", i)
        self.handle_data(self.rawdata[i + 9:end if end >= 0 else len(self.rawdata)])
        return end + 3 if end >= 0 else len(self.rawdata)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing on elements that may have content
        if tag not in VOID and (tag in ("svg", "math") or self.in_foreign()):
            self.pop()

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
        elif tag == "p" and not self.open_count.get("p"):
            self.handle_starttag("p", [])
            self.pop()
        elif self.open_count.get(tag):
            self.end_to({tag}, frozenset() if tag in BLOCKS or tag in UNSEEN else _CELL - {tag})

    def inside(self, tag: str, scope: str) -> bool:
        for name, *_ in reversed(self.stack):
            if name in (tag, scope):
                return name == tag
        return False

    def end_to(self, tags: set[str], scope: frozenset[str]) -> bool:
        """Close the innermost of ``tags`` with all that is in it, unless an element of ``scope`` is met first."""
        if not any(self.open_count.get(t) for t in tags):
            return False
        for depth in range(len(self.stack) - 1, -1, -1):
            name = self.stack[depth][0]
            if name in tags:
                while len(self.stack) > depth:
                    self.pop()
                return True
            if name in scope:
                return False
        return False

    # the layout

    def push(self, tag: str, attrs: dict[str, str | None]) -> None:
        style = attrs.get("style") or ""
        hides = tag in UNSEEN or "hidden" in attrs or bool(_HIDING.search(style)) or (tag == "dialog" and "open" not in attrs)
        self.stack.append((tag, hides, self.veiled))
        for visibility in _VISIBILITY.findall(style):
            self.veiled = visibility.lower() != "visible"
        self.open_count[tag] = self.open_count.get(tag, 0) + 1
        self.hidden += hides
        if tag in ("pre", "textarea"):
            self.pre += 1
        if tag == "table":
            self.tables.append(_Table())
        elif tag in ("ul", "ol", "menu", "dir"):
            start = attrs.get("start") or "1"
            self.lists.append([tag == "ol", int(start) if re.fullmatch("-?[0-9]{1,9}", start) else 1])
        if self.hidden:
            return
        flow = self.flows[-1]
        if tag == "br":
            flow.apart(max(1, min(flow.breaks + 1, 2)))
        elif tag in ("td", "th") and self.tables:
            if not self.tables[-1].rows:
                self.tables[-1].row()
            spans = [attrs.get(name) or "1" for name in ("colspan", "rowspan")]
            columns, rows = (int(n) if re.fullmatch("[0-9]{1,9}", n) else 1 for n in spans)
            span = min(max(columns, 1), COLSPAN), min(rows or ROWSPAN, ROWSPAN)  # 0 rows: all that follow
            self.flows.append(_Flow(len(self.lists), span))
        elif tag == "tr" and self.tables:
            self.tables[-1].row()
        elif tag in BLOCKS:
            nested = tag in ("ul", "ol", "menu", "dir") and len(self.lists) > 1 + flow.lists
            flow.apart(1 if nested else BLOCKS[tag])
            if tag == "li":
                if self.lists and self.lists[-1][0]:
                    flow.marker = f"{self.lists[-1][1]}. "
                    self.lists[-1][1] += 1
                else:
                    flow.marker = "- "

    def pop(self) -> None:
        tag, hides, self.veiled = self.stack.pop()
        self.open_count[tag] -= 1
        seen = not self.hidden
        self.hidden -= hides
        if tag in ("pre", "textarea"):
            self.pre -= 1
        if tag in ("ul", "ol", "menu", "dir"):
            self.lists.pop()
        table = self.tables.pop() if tag == "table" else None
        if not seen:
            return
        if tag in ("td", "th") and self.tables and len(self.flows) > 1:
            cell = self.flows.pop()
            self.tables[-1].cell(cell.text(), cell.span)
            return
        flow = self.flows[-1]
        if table is not None:
            inner = len(self.flows) > 1  # a table in a cell goes on in the cell's line
            for line in table.lines():
                flow.breaks, flow.space = (0, True) if inner and flow.parts else (max(flow.breaks, 1), False)
                self.put(" ".join(line.split()) if inner else line)
        if tag in BLOCKS:
            nested = tag in ("ul", "ol", "menu", "dir") and len(self.lists) > flow.lists
            flow.apart(1 if nested else BLOCKS[tag])
            if tag == "li":
                flow.marker = ""

    def put(self, text: str) -> None:
        flow = self.flows[-1]
        flow.open("  " * min(len(self.lists) - flow.lists, 20))
        flow.parts.append(text)

    def handle_data(self, data: str) -> None:
        if data.strip():
            self.end_head()
        if self.hidden or self.veiled or self.open_count.get("svg") and not (self.open_count.get("text") or self.open_count.get("foreignobject")):
            return
        flow = self.flows[-1]
        if self.pre:
            for i, line in enumerate(data.split("\n")):
                if i:
                    flow.breaks = min(flow.breaks + 1, 2)
                if line.strip():
                    self.put(line.rstrip())
            return
        words = data.split()
        if data[:1].isspace():
            flow.space = True
        if words:
            self.put(" ".join(words))
            flow.space = data[-1].isspace()

    def finish(self) -> str:
        if _CUT_OFF.match(self.rawdata):
            self.rawdata = ""  # a page that ends inside a tag
        self.close()
        while self.stack:
            self.pop()
        return self.flows[0].text()


def render(html: str) -> str:
    """The visible text of one page."""
    page = Page()
    page.feed(html)
    return page.finish()


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` as (doc, text): each row and the visible text of its whole page.

    NULL and empty pages give empty text; broken markup of any depth is laid out as far as it goes; repeated rows give equal
    texts; an empty frame gives an empty frame. Columns of ``pages`` may have any name: they travel in ``doc``.

    Cells keep their blocks and lists as lines of their own; cells that span columns or rows keep those places free; a table
    in a cell goes on in the cell's line. So that layout stays in proportion to the text, columns are aligned up to
    ``COLUMN`` characters, longer cells push what follows in their row, lists are indented up to 20 levels, and several
    empty lines of preformatted text become one. No text is left out for these. Style sheets are not read.
    """
    def start() -> Callable[[list[str]], pa.Array]:
        return lambda pages: pa.array([render(p) for p in pages], pa.string())

    text = per_text(pages.sparkSession, start, "string", F.col(html_col))
    return pages.select(F.struct("*").alias("doc"), text.alias("text"))
