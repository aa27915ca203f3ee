"""Layout-aware rendering of HTML pages as text."""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.llm.cluster import sound_text, text_slices

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    # A quote opens a value only after an equals sign; where its end is missing, the tag ends at the next >.
    r"(?P<attrs>(?:[^>=]++|=[ \t\n\r\f]*+(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+)?)*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACE = re.compile(r"[ \t\n\r\f]+")
UNDISPLAYED = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)", re.I)

# Fixed values of the HTML standard: elements without content, with raw text, and what ends an open element.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes noscript".split())
UNSEEN = frozenset(
    "head script style title template noscript iframe noembed noframes object audio video canvas "
    "datalist colgroup".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre xmp table figure hr fieldset form".split())
BLOCKS = SPACED | frozenset(
    "html body div section article aside header footer main nav address li dt dd figcaption details summary "
    "legend tr caption thead tbody tfoot center menu dir hgroup option".split()
)
ENDS_PARAGRAPH = BLOCKS - frozenset("html body tr thead tbody tfoot caption option".split())
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, {"html"}),
}
#: Below a table, what may hold each of its parts; cells get a row of their own where there is none.
SECTIONS = frozenset("thead tbody tfoot".split())
TABLE_PARTS = {name: frozenset(["table"]) for name in ("caption", "colgroup", "col", *SECTIONS)}
TABLE_PARTS |= {"tr": SECTIONS | {"table"}, "td": SECTIONS | {"table", "tr"}, "th": SECTIONS | {"table", "tr"}}
BARE = SECTIONS | {"table", "tr"}
CELLS = frozenset("td th caption".split())
#: Tags that end math and svg, and the elements in these that hold HTML again.
FOREIGN = frozenset("svg math".split())
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol "
    "p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
HOLDS_HTML = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
#: Parts of svg that draw nothing where they stand.
UNDRAWN = frozenset("defs symbol clippath mask pattern marker metadata desc title style script".split())
SCOPES = frozenset("table td th caption button object template".split())
#: Elements nested deeper become siblings, as in browsers.
MAX_DEPTH = 512
#: A column of a table whose alignment would add more spaces than this isn't padded, so that a page can't fill the memory.
MAX_PADDING = 16 << 20
#: Fixed values of the HTML standard: the most columns and rows that a cell may span.
MAX_COLUMNS, MAX_ROWS = 1000, 65_534


class Node:
    __slots__ = ("attrs", "children", "name")

    def __init__(self, name: str, attrs: dict[str, str]) -> None:
        self.name, self.attrs, self.children = name, attrs, []


def parse(page: str) -> Node:
    """The element tree, with implied ends and rows; unclosed tags close at the end, stray ends are dropped.

    What stands in a table but in none of its cells goes before the table, and
    forms there hold nothing, as the HTML standard has it.
    """
    root = Node("html", {})
    stack = [root]
    at = 0
    size = len(page)
    while at < size:
        found = TOKEN.search(page, at)
        if not found:
            _add(stack, html.unescape(page[at:]))
            break
        if found.start() > at:
            _add(stack, html.unescape(page[at : found.start()]))
        at = max(found.end(), found.start() + 1)
        name = found["name"]
        if name is None:
            if page.startswith("<![CDATA[", found.start()) and _foreign(stack):
                end = page.find("]]>", found.start())
                _add(stack, page[found.start() + 9 : end if end >= 0 else size])
                at = end + 3 if end >= 0 else size
            continue
        name = name.lower()
        if found["close"]:
            _close(stack, name)
            continue
        raw = found["attrs"]
        attrs = {}
        if raw and not raw.isspace():
            attrs = {
                m[1].lower(): html.unescape(next((v for v in m.groups()[1:] if v is not None), ""))
                for m in reversed(list(ATTRIBUTE.finditer(raw)))
            }
        if name == "html":
            continue
        foreign = _foreign(stack)
        if foreign and name in ENDS_FOREIGN:
            del stack[foreign:]
            foreign = 0
        if not foreign:
            _imply_ends(stack, name)
        if name == "form" and stack[-1].name in BARE and _table(stack):
            continue
        node = Node(name, attrs)
        if foreign and stack[foreign].name == "math" and name in ("annotation", "annotation-xml"):
            attrs["hidden"] = ""
        _add(stack, node)
        if name in VOID or name == "colgroup" or (foreign and raw.endswith("/")):
            continue
        if name in RAW and not foreign:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            stop = end.start() if end else size
            if name == "textarea":
                node.children.append(html.unescape(page[at:stop]))
            elif name == "xmp":
                node.children.append(page[at:stop])
            at = end.end() if end else size
            continue
        if len(stack) < MAX_DEPTH or (name in TABLE_PARTS and stack[-1].name in TABLE_PARTS[name]):
            stack.append(node)
    return root


def _foreign(stack: list[Node]) -> int:
    """The place of the math or svg whose own content the next tag is, or 0."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name in FOREIGN:
            return k
        if stack[k].name in HOLDS_HTML:
            return 0
    return 0


def _table(stack: list[Node]) -> int:
    """The place of the innermost open table, or 0; templates are apart."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name == "table":
            return k
        if stack[k].name == "template":
            return 0
    return 0


def _add(stack: list[Node], child: Node | str) -> None:
    """Put a child into the open element, or before the table if that is a bare part of one."""
    holder = stack[-1]
    if holder.name in BARE and (at := _table(stack)):
        if isinstance(child, str):
            strayed = not (not child or child.isspace())
        else:
            strayed = holder.name not in TABLE_PARTS.get(child.name, ()) and child.name not in ("script", "style", "template")
        if strayed:
            stack[at - 1].children.insert(-1, child)
            return
    holder.children.append(child)


def _close(stack: list[Node], name: str) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name == name:
            del stack[k:]
            return
        if stack[k].name == "table" and name in TABLE_PARTS:
            return
        if stack[k].name in SCOPES and name not in ("table", "tr", "tbody", "thead", "tfoot", "html", "body"):
            return


def _imply_ends(stack: list[Node], name: str) -> None:
    if name in ENDS_PARAGRAPH:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name == "p":
                del stack[k:]
                break
            if stack[k].name in SCOPES:
                break
    if name in TABLE_PARTS and (at := _table(stack)):
        while len(stack) - 1 > at and stack[-1].name not in TABLE_PARTS[name]:
            stack.pop()
        if name in ("td", "th") and stack[-1].name != "tr":
            row = Node("tr", {})
            stack[-1].children.append(row)
            stack.append(row)
    elif name == "table" and (at := _table(stack)) and not any(x.name in CELLS for x in stack[at:]):
        del stack[at:]
    if name in CLOSED_BY:
        ended, within = CLOSED_BY[name]
        lowest = None
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in within:
                break
            if stack[k].name in ended:
                lowest = k
        if lowest is not None:
            del stack[lowest:]
    elif name in BLOCKS and name != "body" and stack[-1].name == "head":
        stack.pop()


def hidden(node: Node) -> bool:
    attrs = node.attrs
    return node.name in UNSEEN or (bool(attrs) and ("hidden" in attrs or bool(UNDISPLAYED.search(attrs.get("style", "")))))


def unveil(node: Node, seen: bool = True) -> None:
    """Take out text that inherits visibility: hidden; what is visible again inside stays."""
    kept: list[Node | str] = []
    for child in node.children:
        if isinstance(child, str):
            if seen:
                kept.append(child)
            continue
        found = VISIBILITY.findall(child.attrs.get("style", ""))
        unveil(child, found[-1].lower() == "visible" if found else seen)
        kept.append(child)
    node.children = kept


def chosen(select: Node) -> list[Node]:
    """The options that a select shows: all of a list box, else the one selected, the first by default."""
    options: list[Node] = []
    todo = list(reversed(select.children))
    while todo:
        child = todo.pop()
        if isinstance(child, Node) and not hidden(child):
            options += [child] if child.name == "option" else []
            todo += reversed(child.children)
    if "multiple" in select.attrs or _number(select.attrs.get("size"), 1) > 1:
        return options
    return ([x for x in options if "selected" in x.attrs][-1:] or options[:1]) if options else []


class Page:
    """Lines of text, a line in the making, and the blank lines that the next one wants before it."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0
        self.spaced = True

    def text(self, words: str) -> None:
        words = SPACE.sub(" ", words)
        if self.spaced and words[:1] == " ":
            words = words[1:]
        if words:
            self.line.append(words)
            self.spaced = words[-1] == " "

    def end_line(self, always: bool = False) -> None:
        line = "".join(self.line).rstrip(" ")
        self.line, self.spaced = [], True
        if line or always:
            self.put([line])

    def put(self, lines: list[str]) -> None:
        if self.lines and self.gap:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        self.lines.extend(lines)

    def space(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def finish(self) -> list[str]:
        self.end_line()
        return self.lines


def _render(node: Node, page: Page, pre: bool = False, depth: int = 0) -> None:
    for child in node.children:
        if isinstance(child, str):
            if not pre:
                page.text(child)
                continue
            first, *rest = child.replace("\r\n", "\n").split("\n")
            page.line.append(first)
            for more in rest:
                page.end_line(always=True)
                page.line.append(more)
            continue
        name = child.name
        if hidden(child):
            continue
        if name == "br":
            page.end_line(always=True)
        elif name == "hr":
            page.space(1)
        elif name in BLOCKS:
            page.space(1 if name in SPACED and not (depth and name in ("ul", "ol")) else 0)
            if name == "table":
                page.put(table_lines(child))
            elif name in ("ul", "ol", "menu", "dir"):
                _list(child, page, depth)
            elif name in ("blockquote", "dd"):
                inner = Page()
                _render(child, inner, pre, depth)
                if lines := inner.finish():
                    page.put([f"  {x}" if x else x for x in lines])
            elif name in ("pre", "xmp"):
                inner = Page()
                _render(child, inner, True, depth)
                lines = inner.finish()
                page.put(lines[1:] if lines and not lines[0] else lines)
            elif name == "details" and "open" not in child.attrs:
                short = Node("details", {})
                short.children = [c for c in child.children if isinstance(c, Node) and c.name == "summary"][:1]
                _render(short, page, pre, depth)
            else:
                _render(child, page, pre, depth)
            page.space(1 if name in SPACED and not (depth and name in ("ul", "ol")) else 0)
        elif name == "svg":
            _drawing(child, page, depth)
        elif name == "select":
            for option in chosen(child):
                page.text(" ")
                _render(option, page, pre, depth)
            page.text(" ")
        elif name in ("td", "th"):
            page.text(" ")
            _render(child, page, pre, depth)
        elif child.children:
            _render(child, page, pre, depth)


def _drawing(node: Node, page: Page, depth: int) -> None:
    """The words of text and HTML in a drawing."""
    for child in node.children:
        if isinstance(child, str) or hidden(child) or child.name in UNDRAWN or child.attrs.get("display") == "none":
            continue
        if child.name in ("text", "foreignobject"):
            page.text(" ")
            _render(child, page, False, depth)
            page.text(" ")
        else:
            _drawing(child, page, depth)


def _number(text: str | None, other: int, most: int = 1000) -> int:
    found = re.match(r"\s*(-?\d{1,9})", text or "")
    return min(int(found[1]), most) if found else other


def _list(node: Node, page: Page, depth: int) -> None:
    number = _number(node.attrs.get("start"), 1, 10**9) if node.name == "ol" else None
    for child in node.children:
        if isinstance(child, str):
            page.text(child)
            continue
        if hidden(child):
            continue
        page.end_line()
        inner = Page()
        holder = Node("li", {})
        holder.children = child.children if child.name == "li" else [child]
        _render(holder, inner, False, depth + 1)
        lines = inner.finish()
        if child.name != "li":
            page.put(lines)
            continue
        mark = "- " if number is None else f"{number}. "
        number = None if number is None else number + 1
        if lines:
            page.put([mark + lines[0], *[" " * len(mark) + x if x else x for x in lines[1:]]])


def _rows(node: Node) -> Iterator[Node]:
    for child in node.children:
        if isinstance(child, Node) and not hidden(child):
            if child.name == "tr":
                yield child
            elif child.name in ("thead", "tbody", "tfoot"):
                yield from _rows(child)


def table_lines(table: Node) -> list[str]:
    """Rows with their cells in aligned columns; spanning cells leave blank ones, and what stands outside cells comes first."""
    grid: list[dict[int, list[str]]] = []
    down: dict[int, int] = {}
    for row in _rows(table):
        cells: dict[int, list[str]] = {}
        column = 0
        lasting = {c: n - 1 for c, n in down.items() if n > 1}
        for cell in row.children:
            if not isinstance(cell, Node) or cell.name not in ("td", "th") or hidden(cell):
                continue
            while down.get(column, 0) > 0:
                column += 1
            inner = Page()
            _render(cell, inner)
            cells[column] = inner.finish()
            span = max(_number(cell.attrs.get("colspan"), 1, MAX_COLUMNS), 1)
            if (rows := max(_number(cell.attrs.get("rowspan"), 1, MAX_ROWS), 1)) > 1:
                lasting.update(dict.fromkeys(range(column, column + span), rows - 1))
            column += span
        down = lasting
        if any(cells.values()):
            grid.append(cells)
    width: dict[int, int] = {}
    for cells in grid:
        for c, lines in cells.items():
            width[c] = max([width.get(c, 0), *(len(x) for x in lines)])
    used = sorted(c for c in width if width[c])
    height = sum(max(len(x) for x in cells.values()) for cells in grid)
    pad = {c: width[c] if width[c] * height <= MAX_PADDING else 0 for c in used}
    out: list[str] = []
    loose = Page()
    for child in table.children:
        if isinstance(child, str):
            loose.text(child)
        elif child.name not in ("tr", "thead", "tbody", "tfoot") and not hidden(child):
            holder = Node("div", {})
            holder.children = [child]
            _render(holder, loose)
    out += loose.finish()
    for cells in grid:
        for k in range(max(len(x) for x in cells.values())):
            parts = [(cells.get(c) or [])[k : k + 1] for c in used]
            line = "  ".join((p[0] if p else "").ljust(pad[c]) for p, c in zip(parts, used, strict=True))
            out.append(line.rstrip(" "))
    return out


def render(page: str | None) -> str:
    """All visible text of a page: blocks on lines of their own, paragraphs and the like set off by a blank line."""
    if not page:
        return ""
    if sys.getrecursionlimit() < 12 * MAX_DEPTH:
        sys.setrecursionlimit(12 * MAX_DEPTH)
    tree = parse(page)
    if "visibility" in page.lower():
        unveil(tree)
    out = Page()
    _render(tree, out)
    lines = out.finish()
    while lines and not lines[-1]:
        lines.pop()
    return "\n".join(lines)


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, n_lines and text.

    Null and empty pages give an empty text of 0 lines. Broken markup is repaired,
    never refused; elements nested more than MAX_DEPTH deep become siblings.
    Repeated rows give repeated rows, other columns are ignored, and an empty
    table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "html"):
                texts = [render(x) for x in sound_text(part.column(1)).to_pylist()]
                lines = pa.array([x.count("\n") + 1 if x else 0 for x in texts], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lines, pa.array(texts, pa.string())], ["page_id", "n_lines", "text"]
                )

    source = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html"))
    kind = source.schema["page_id"].dataType.simpleString()
    return source.mapInArrow(run, f"page_id {kind}, n_lines int, text string")
