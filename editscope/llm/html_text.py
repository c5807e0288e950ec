"""Visible text of web pages, laid out: a tree builder with implied tags, visibility rules, and a renderer.

The builder closes what a new tag implies (paragraphs, list items, table parts) and ignores end tags that match nothing.
Visibility is inherited and can be set back by a child; what has no display takes its children along.
The renderer leaves out what a browser does not show and keeps all other text, also that of drawings, text areas, the
chosen option of a list, and the values and placeholders of buttons and fields. Labels that a browser makes up itself
(a submit button without a value) and copies by SVG's ``use`` are not made: blocks on lines of their own, blank lines
around paragraphs, headings, lists and tables, list marks with indentation, table cells in aligned columns.
Elements may be nested to any depth: the builder finds open elements by name, and the renderer keeps its own stack.
Style sheets are not applied: what only they would hide is text like any other.
"""

from __future__ import annotations

import re
from collections.abc import Generator, Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

# Element names of HTML and how they behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template title noscript iframe noembed noframes datalist object audio video canvas".split())
#: Input elements whose value is shown; those of the second group show their placeholder if the value is empty.
BUTTONS = frozenset("submit button reset".split())
FIELDS = frozenset("text search tel url email number".split())
OTHER_INPUTS = frozenset(
    "hidden password date month week time datetime-local range color checkbox radio file image".split()
) | BUTTONS | FIELDS
#: Parts of a drawing that are not drawn where they stand, or hold no text to draw.
SVG_HIDDEN = frozenset(
    "defs symbol clippath mask pattern marker lineargradient radialgradient filter desc metadata title style script".split()
)
SVG_TO_HTML = frozenset("foreignobject desc title".split())
#: Start tags that end a drawing, since they do not belong in it.
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr".split())
BLOCK = SPACED | frozenset(
    "html body div section article aside header footer nav main address form fieldset legend li dt dd figcaption "
    "details summary dialog center menu caption tr td th thead tbody tfoot option optgroup textarea foreignobject".split()
)
CLOSES_P = SPACED | frozenset(
    "div section article aside header footer nav main address form fieldset center details dialog menu figcaption".split()
)
#: A start tag closes the nearest of these, unless one of the second group stands between.
IMPLIED = {
    "li": ("li", "ul ol menu table"), "dt": ("dt dd", "dl table"), "dd": ("dt dd", "dl table"),
    "td": ("td th", "table"), "th": ("td th", "table"), "tr": ("tr", "table"),
    "thead": ("thead tbody tfoot caption", "table"), "tbody": ("thead tbody tfoot caption", "table"),
    "tfoot": ("thead tbody tfoot caption", "table"), "option": ("option", "select datalist"), "body": ("head", ""),
}
IMPLIED = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in IMPLIED.items()}
#: An end tag does not close what stands outside of these; that of a table part only stays inside its table.
SCOPE = frozenset("table td th caption html button".split())
TABLE_PARTS = frozenset("tr td th thead tbody tfoot caption".split())
HEAD_ONLY = frozenset("title meta link base style script noscript template".split())
WIDTH = 200  # lines of a cell that has others beside it are broken, at blanks if there are any, to this length

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
#: A declaration ends at a semicolon outside of quotes and parentheses.
_DECLARATION = re.compile(r"""(?:[^;"'(\\]|\\.?|"(?:[^"\\]|\\.)*"?|'(?:[^'\\]|\\.)*'?|\((?:[^()"']|"[^"]*"|'[^']*')*\)?)+""", re.S)
_ANY_PROPERTY = frozenset("inherit initial unset revert revert-layer".split())
#: Values that a browser takes; a declaration with another one does not count.
_VALUES = {
    "visibility": _ANY_PROPERTY | frozenset("visible hidden collapse".split()),
    "display": _ANY_PROPERTY | frozenset(
        "none contents block inline flow flow-root table flex grid ruby math list-item run-in inline-block inline-table "
        "inline-flex inline-grid table-row-group table-header-group table-footer-group table-row table-cell "
        "table-column-group table-column table-caption ruby-base ruby-text ruby-base-container ruby-text-container "
        "-webkit-box -webkit-inline-box -webkit-flex -webkit-inline-flex".split()
    ),
}
ROWS = frozenset("tr thead tbody tfoot".split())


def declared(style: str) -> dict[str, str]:
    """``display`` and ``visibility`` of a style attribute: the last valid declaration, important ones first."""
    found: dict[str, tuple[bool, str]] = {}
    for declaration in _DECLARATION.findall(_COMMENT.sub("", style.lower())):
        name, _, value = declaration.partition(":")
        name = name.strip()
        if name not in _VALUES:
            continue
        value, mark, rest = value.partition("!")
        words = ["unset"] if "var(" in value else value.split()
        if mark and rest.strip() != "important" or not words or not _VALUES[name].issuperset(words):
            continue
        if len(words) > 1 and (name == "visibility" or "none" in words):
            continue
        if mark or not found.get(name, (False, ""))[0]:
            found[name] = bool(mark), " ".join(words)
    return {name: value for name, (_, value) in found.items()}


class Node:
    """``sight`` is the visibility: visible, hidden or collapse; that of the parent unless the element has its own.
    ``drawing``: the children are elements of SVG."""

    __slots__ = ("tag", "attrs", "children", "sight", "display", "drawing")

    def __init__(self, tag: str, attrs: str = "", sight: str = "visible", drawing: bool = False):
        self.tag, self.attrs, self.children, self.sight, self.display = tag, attrs, [], sight, ""
        self.drawing = tag == "svg" or drawing and tag not in SVG_TO_HTML
        if not attrs:
            return
        style = self.get("style") or ""
        if drawing or tag == "svg":  # there, attributes of these names count as a style, before the others
            style = "".join(f"{name}:{self.get(name) or ''};" for name in _VALUES) + style
        if style:
            own = declared(style)
            self.display = own.get("display", "")
            if own.get("visibility", "") in ("visible", "hidden", "collapse"):
                self.sight = own["visibility"]
            elif own.get("visibility") == "initial":
                self.sight = "visible"

    def get(self, name: str) -> str | None:
        """An attribute's value; empty if it has none, None if it is not there."""
        if name not in self.attrs.lower():
            return None
        for m in _ATTR.finditer(self.attrs):
            if m[1].lower() == name:
                return unescape(next((v for v in m.groups()[1:] if v is not None), ""))
        return None


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("open", name, attributes) and ("close", name, ""), in one pass over the page."""
    at, end = 0, len(html)
    unclosed: set[str] = set()
    while at < end:
        less = html.find("<", at)
        if less < 0:
            yield "text", html[at:], ""
            return
        if less > at:
            yield "text", html[at:less], ""
        if html.startswith("<!--", less):
            stop = html.find("-->", less + 4)
            at = end if stop < 0 else stop + 3
            continue
        closing = html.startswith("/", less + 1)
        name = _NAME.match(html, less + 1 + closing)
        if not name:
            if html[less + 1 : less + 2] in ("!", "?", "/"):
                stop = html.find(">", less)
                at = end if stop < 0 else stop + 1
            else:
                yield "text", "<", ""
                at = less + 1
            continue
        # the tag ends at the first > outside of quotes; a quote without its partner counts as a plain character
        stop = seek = name.end()
        while True:
            stop = html.find(">", seek)
            if stop < 0:
                return  # the page ends inside a tag
            quotes = [(q, c) for c in "\"'" if c not in unclosed and 0 <= (q := html.find(c, seek, stop))]
            if not quotes:
                break
            q, c = min(quotes)
            partner = html.find(c, q + 1)
            if partner < 0:
                unclosed.add(c)
                continue
            seek = partner + 1
        tag = name[0].lower()
        at = stop + 1
        if closing:
            yield "close", tag, ""
            continue
        yield "open", tag, html[name.end() : stop]
        if tag in RAW:
            finish = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, at)
            inside = html[at : finish.start() if finish else end]
            if inside:
                yield "text", inside, ""
            at = finish.start() if finish else end


def _barrier(name: str) -> frozenset:
    if name == "table":
        return frozenset()
    return frozenset(["table"]) if name in TABLE_PARTS else SCOPE - {name}


def parse(html: str) -> Node:
    """The tree of a page. Missing html, head, body, tbody and tr are not made up; text stands where it is."""
    root = Node("html")
    stack = [root]
    places: dict[str, list[int]] = {}  # open elements by name, as places in the stack

    def push(node: Node) -> None:
        places.setdefault(node.tag, []).append(len(stack))
        stack.append(node)

    def pop() -> None:
        places[stack.pop().tag].pop()

    def top(names: frozenset) -> int:
        return max((places[name][-1] for name in names if places.get(name)), default=0)

    def pop_to(names: frozenset, barrier: frozenset) -> bool:
        place = top(names)
        if not place or place < top(barrier):
            return False
        while len(stack) > place:
            pop()
        return True

    for kind, name, attrs in tokens(html):
        if kind == "text":
            if len(stack) > 1 and stack[-1].tag == "head" and not name.isspace():
                pop()
            stack[-1].children.append(name)
        elif kind == "open":
            if name == "html":
                continue
            if stack[-1].tag == "head" and name not in HEAD_ONLY:
                pop()
            if stack[-1].drawing and (name in BREAKOUT or name == "font" and re.search(r"(?i)\b(?:color|face|size)\s*=", attrs)):
                while stack[-1].drawing:
                    pop()
            if name in ("input", "textarea", "select"):
                pop_to(frozenset(["select"]), SCOPE)
            elif name == "optgroup":
                pop_to(frozenset([name]), frozenset(["select"])) or pop_to(frozenset(["option"]), frozenset(["select"]))
            if name in CLOSES_P:
                pop_to(frozenset(["p"]), SCOPE)
            if name in IMPLIED:
                pop_to(*IMPLIED[name])
            drawing = stack[-1].drawing
            node = Node(name, attrs, stack[-1].sight, drawing)
            stack[-1].children.append(node)
            if name not in VOID and not (attrs.endswith("/") and (drawing or name in ("svg", "path"))):
                push(node)
        elif name == "br":
            stack[-1].children.append(Node("br", "", stack[-1].sight))
        elif name in VOID or name == "html":
            continue
        elif not pop_to(frozenset([name]), _barrier(name)) and name == "p":
            stack[-1].children.append(Node("p", "", stack[-1].sight))
    return root


def displayed(node: Node) -> bool:
    """Whether an element has a place on the page. Its text may still be out of sight, that of its children in sight."""
    if node.tag in HIDDEN or node.sight == "collapse" and node.tag in ROWS:
        return False
    if not node.attrs:
        return node.tag != "dialog"
    if node.get("hidden") is not None or node.tag == "input" and (node.get("type") or "").lower() == "hidden":
        return False
    if node.tag == "dialog" and node.get("open") is None:
        return False
    return node.display != "none"


def shown_value(node: Node) -> str:
    """The text that an input element shows by its attributes."""
    kind = (node.get("type") or "").lower()
    if kind not in OTHER_INPUTS:
        kind = "text"
    if kind in BUTTONS:
        return node.get("value") or ""
    return node.get("value") or node.get("placeholder") or "" if kind in FIELDS else ""


def _words(node: Node) -> str:
    """The text of an option."""
    parts, todo = [], [node]
    while todo:
        one = todo.pop()
        if isinstance(one, str):
            parts.append(unescape(one))
        elif one.tag != "script":
            todo += reversed(one.children)
    return " ".join("".join(parts).split())


def _options(node: Node) -> Iterator[tuple[Node, bool, int]]:
    """Groups and options of a select with whether they are disabled and how deep they are in groups."""
    todo = [(child, False, 0) for child in reversed(node.children)]
    while todo:
        child, off, level = todo.pop()
        if isinstance(child, str):
            continue
        no = off or child.get("disabled") is not None
        if child.tag in ("option", "optgroup"):
            yield child, no, level
        if child.tag != "option":
            group = child.tag == "optgroup"
            todo += [(c, no if group else off, level + group) for c in reversed(child.children)]


Step = Generator["Step", object, object]


def _run(step: Step) -> object:
    """Run a step and those that it yields, each before the one that yielded it goes on, on a stack of its own: pages may be
    nested deeper than functions may call."""
    stack, value = [step], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as done:
            stack.pop()
            value = done.value
    return value


def _select(node: Node, page: Page) -> None:
    """A closed list shows the option selected last, or else the first that is not disabled; an open one shows all."""
    size = node.get("size") or ""
    rows = list(_options(node))
    if node.get("multiple") is None and not (re.fullmatch("[0-9]{1,9}", size) and int(size) > 1):
        options = [(child, off) for child, off, _ in rows if child.tag == "option"]
        chosen = [child for child, _ in options if child.get("selected") is not None][-1:]
        for child in chosen or [child for child, off in options if not off][:1]:
            if node.sight == "visible":
                page.apart(child.get("label") or _words(child))
        return
    page.line()
    for child, _, level in rows:
        label = child.get("label") or ("" if child.tag == "optgroup" else _words(child))
        if label and displayed(child) and child.sight == "visible":
            outer, page.indent = page.indent, page.indent + "  " * level
            page.apart(label)
            page.line()
            page.indent = outer
    page.line()


def _drawing(node: Node, page: Page, inside: bool = False) -> Step:
    """The text elements of a drawing, apart from each other, and the pages in it."""
    for child in node.children:
        if isinstance(child, str):
            if inside and node.sight == "visible":
                page.text(child)
        elif child.tag in SVG_HIDDEN or not displayed(child):
            continue
        elif child.tag == "foreignobject":
            page.line()
            yield _render(child, page)
            page.line()
        elif child.tag == "text":
            page.blank = True
            yield _drawing(child, page, True)
            page.blank = True
        else:
            yield _drawing(child, page, inside)


class Page:
    """Lines of text. Runs of white space are one blank; a block asks for a line break, a spaced block for a blank line."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.blank = False  # a blank is due before the next word
        self.gap = 0
        self.indent = ""
        self.mark = ""  # stands before the next line instead of the last part of the indentation

    def text(self, value: str) -> None:
        parts = _SPACE.split(unescape(value) if "&" in value else value)
        for k, part in enumerate(parts):
            if k:
                self.blank = True
            if part:
                self.word(part)

    def apart(self, value: str) -> None:
        """Text with a blank on either side; it is a value, not source text."""
        for part in _SPACE.split(value):
            if part:
                self.blank = True
                self.word(part)
                self.blank = True

    def word(self, part: str) -> None:
        if not self.now:
            self._begin()
        elif self.blank:
            self.now.append(" ")
        self.blank = False
        self.now.append(part)

    def _begin(self) -> None:
        if self.gap > 1 and self.lines:
            self.lines.append("")
        self.gap = 0
        self.now.append(self.indent[: len(self.indent) - len(self.mark)] + self.mark)
        self.mark = ""

    def line(self, gap: int = 1) -> None:
        if self.now:
            self.lines.append("".join(self.now).rstrip(" "))
            self.now = []
        self.blank = False
        self.gap = max(self.gap, gap)

    def whole(self, value: str) -> None:
        """A line as it is, blanks and all."""
        self.line()
        self._begin()
        self.now.append(value)
        self.line()

    def empty(self) -> None:
        self.line()
        self.lines.append("")


def _render(node: Node, page: Page, preformatted: bool = False, number: list[int] | None = None) -> Step:
    for child in node.children:
        if isinstance(child, str):
            if node.sight != "visible":
                continue
            if preformatted:
                rows = unescape(child).replace("\r\n", "\n").split("\n")
                for k, row in enumerate(rows):
                    if k:
                        if page.now:
                            page.line()
                        else:
                            page.lines.append("")
                    if row:
                        if not page.now:
                            page._begin()
                        page.now.append(row)
            else:
                page.text(child)
            continue
        tag = child.tag
        if not displayed(child):
            continue
        if tag == "br":
            if page.now:
                page.line()
            elif page.lines and page.gap <= 1:
                page.gap = 2
        elif tag == "hr":
            page.line(2)
            if child.sight == "visible":
                page.whole("---")
            page.line(2)
        elif tag == "svg":
            yield _drawing(child, page)
        elif tag == "select":
            _select(child, page)
        elif tag == "input":
            if child.attrs and child.sight == "visible":
                page.apart(shown_value(child))
        elif tag == "textarea":
            page.line()
            if child.children and isinstance(child.children[0], str):
                child.children[0] = re.sub(r"\A\r?\n", "", child.children[0])
            if any(child.children):
                yield _render(child, page, True)
            elif child.sight == "visible":
                page.apart(child.get("placeholder") or "")
            page.line()
        elif tag == "table":
            page.line(2)
            for row in (yield _table(child)):
                page.whole(row) if row else page.empty()
            page.line(2)
        elif tag in ("ul", "ol", "menu"):
            page.line(1 if page.indent else 2)
            start = child.get("start") if tag == "ol" else None
            count = int(start) if start and re.fullmatch(r"-?[0-9]{1,9}", start) else 1
            yield _render(child, page, preformatted, [count] if tag == "ol" else None)
            page.line(1 if page.indent else 2)
        elif tag == "li":
            page.line()
            if node.tag == "ol" and number:
                mark, number[0] = f"{number[0]}. ", number[0] + 1
            else:
                mark = "- "
            outer, page.indent = page.indent, page.indent + " " * len(mark)
            if child.sight == "visible":
                page.mark = mark
            yield _render(child, page, preformatted)
            if page.mark == mark:  # an empty item
                page.mark = ""
            page.line()
            page.indent = outer
        elif tag in ("dd", "blockquote"):
            page.line(2 if tag == "blockquote" else 1)
            outer, page.indent = page.indent, page.indent + "  "
            yield _render(child, page, preformatted)
            page.line(2 if tag == "blockquote" else 1)
            page.indent = outer
        elif tag == "details" and child.get("open") is None:
            shown = Node("div")
            shown.children = [c for c in child.children if isinstance(c, Node) and c.tag == "summary"][:1]
            page.line()
            yield _render(shown, page, preformatted)
            page.line()
        elif tag in BLOCK:
            gap = 2 if tag in SPACED else 1
            page.line(gap)
            yield _render(child, page, preformatted or tag == "pre")
            page.line(gap)
        else:
            yield _render(child, page, preformatted)


def _cell(node: Node) -> Step:
    page = Page()
    yield _render(node, page)
    page.line()
    return page.lines


def _broken(lines: list[str]) -> list[str]:
    """Lines of at most ``WIDTH`` characters, broken at the last blank that fits, or else within the word."""
    out = []
    for line in lines:
        while len(line) > WIDTH:
            inside = len(line) - len(line.lstrip(" "))
            at = line.rfind(" ", inside, WIDTH + 1)
            out.append((line[:at] if at > 0 else line[:WIDTH]).rstrip(" "))
            line = line[at + 1 :].lstrip(" ") if at > 0 else line[WIDTH:]
        out.append(line)
    return out


def _rows(table: Node) -> Iterator[tuple[str, object]]:
    """Rows and captions of a table in order; text that stands loose in it comes before it, as in browsers."""
    todo = [(child, table.sight) for child in reversed(table.children)]
    while todo:
        child, sight = todo.pop()
        if isinstance(child, str):
            if sight == "visible" and child.strip():
                yield "loose", child
        elif not displayed(child):
            continue
        elif child.tag == "tr":
            yield "row", child
        elif child.tag in ("thead", "tbody", "tfoot"):
            todo += [(c, child.sight) for c in reversed(child.children)]
        elif child.tag in ("td", "th"):
            yield "cell", child
        elif child.tag not in ("col", "colgroup"):
            yield "loose", child


def _table(table: Node) -> Step:
    """Lines of a table: cells of a column start at the same place; a cell of several lines takes several lines."""
    loose = Node("div")
    grid: list[list[tuple[int, int, list[str]]]] = []  # rows of (column, span, lines)
    held: dict[int, int] = {}  # column -> rows for which a cell from above still holds it
    open_row: list | None = None

    def place(row: list, cell: Node) -> Step:
        column = row[-1][0] + row[-1][1] if row else 0
        while held.get(column, 0) > 0:
            column += 1
        spans = [cell.get("colspan"), cell.get("rowspan")] if cell.attrs else [None, None]
        wide, high = (min(int(s), 1000) if s and re.fullmatch("[0-9]{1,6}", s) and int(s) else 1 for s in spans)
        row.append((column, wide, (yield _cell(cell))))
        if high > 1:
            fresh.update({column + k: high for k in range(wide)})

    for kind, node in _rows(table):
        if kind == "loose":
            loose.children.append(node)
            continue
        if kind == "cell" and open_row is not None:
            yield place(open_row, node)
            continue
        fresh: dict[int, int] = {}
        row: list = []
        cells = [node] if kind == "cell" else []
        if kind == "row":
            for child in node.children:
                if isinstance(child, Node) and child.tag in ("td", "th"):
                    if displayed(child):
                        cells.append(child)
                elif isinstance(child, Node) or node.sight == "visible" and child.strip():
                    loose.children.append(child)
        for cell in cells:
            yield place(row, cell)
        grid.append(row)
        open_row = row if kind == "cell" else None
        held = {c: n - 1 for c, n in held.items() if n > 1}
        held.update({c: n - 1 for c, n in fresh.items()})
    if max((column for row in grid for column, _, _ in row), default=0):  # a table of one column has nothing to align
        grid = [[(column, span, _broken(lines)) for column, span, lines in row] for row in grid]
    widths: dict[int, int] = {}
    for row in grid:
        for column, span, lines in row:
            if span == 1:
                widths[column] = max(widths.get(column, 0), max(map(len, lines), default=0))
    out = (yield _cell(loose)) if loose.children else []
    used = sorted(widths)
    starts, at = {}, 0
    for column in range((used[-1] if used else 0) + 1):
        starts[column] = at
        if widths.get(column):
            at += widths[column] + 2
    for row in grid:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            line = ""
            for column, _, lines in row:
                if k < len(lines) and lines[k]:
                    place_ = starts.get(column, at)
                    line = line.ljust(place_) if len(line) < place_ or not line else line + "  "
                    line += lines[k]
            out.append(line.rstrip(" "))
    return out


def render(html: str | None) -> str:
    """The visible text of a page; empty for a null or empty page."""
    if not html:
        return ""
    page = Page()
    _run(_render(parse(html), page))
    page.line()
    return "\n".join(page.lines).strip("\n")


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the visible text in ``out``: one row out for each row in, a column of that name is replaced.

    Null and empty pages have empty text.
    """
    common.small_batches(pages.sparkSession)

    @F.pandas_udf(T.StringType())
    def text(html: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in html:
            yield pd.Series([render(h) for h in batch], dtype=object)

    return pages.withColumn(out, text.asNondeterministic()(F.col(html_col).cast("string")))


def op3_html(spark, sf_dir) -> DataFrame:
    """Visible text of every page."""
    pages = common.table(spark, sf_dir, "pages").select("page_id", "html")
    rows = extract(pages)
    return rows.select(
        "page_id", "text", F.length("text").cast("long").alias("n_chars"),
        F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
    )
