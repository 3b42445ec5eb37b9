"""Layout-aware text of HTML pages.

A small tree builder reads the tags, closes what a new tag implies closed, and leaves out what is not shown; a
renderer then sets blocks on lines of their own, paragraphs and headings apart by an empty line, list items
behind their marks and table cells in aligned columns.  All visible text is kept, in document order.

A table's cells lie in a grid by their colspan and rowspan; every cell starts where its column does, and a column is as
wide as its widest cell.  Lines of a cell that are longer than WRAP go on below, in their own column, so that a column
takes no more than that whatever it holds.  Formulas (math) and labels (svg) are text within their line; the labels of
a drawing stand apart by a space.  List items count as ``start``, ``value`` and ``reversed`` say; buttons show their
label.

Not shown: comments, head, script, style, template, noscript, objects' fallbacks, annotations of formulas, titles,
descriptions and definitions of drawings, closed dialogs, closed details but for their summary, and elements with
``hidden`` or a ``display: none``, at any depth.  ``visibility`` is inherited, and a visible element within an invisible
one is shown.  Both come from inline styles and from the page's own style sheets, as far as these name tags, classes and
ids of the element itself, in their order of specificity.

Edge cases: null and empty pages give empty text; markup may end or nest anyhow; elements nested deeper than
MAX_DEPTH, where browsers stop nesting too, are laid out as siblings at that depth, what they show kept; repeated rows and null ids give a row each;
further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
import sys
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halocline.llm.common import read_table, small_batches

#: Fixed value: the depth of nesting at which browsers' parsers stop; each level of lists is indented, so without an end the
#: text would grow with the square of the depth.
MAX_DEPTH = 512
# The most columns and rows that a cell may span in HTML.
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534
#: Characters of a line of a cell; longer ones are broken at a space, or within a word that is longer.
WRAP = 160

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript title iframe noembed noframes object audio video canvas datalist".split())
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr fieldset".split())
BLOCK = PARAGRAPH | frozenset("address article aside body center dd details dialog dir div dt figcaption footer form header hgroup html legend li main menu nav section summary tbody td tfoot th thead tr caption optgroup option".split())
#: Elements in which a slash closes a tag, as they are not HTML.
FOREIGN = frozenset({"svg", "math"})
UNSEEN_MATH = frozenset({"annotation", "annotation-xml"})
UNSEEN_SVG = frozenset("title desc defs metadata symbol clippath mask pattern marker".split())
#: Parts of a formula that stand apart.
APART_MATH = frozenset("mfrac mtr mtd".split())
#: A start tag closes open elements of these names, looked for up to the nearest element of the second set.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th", "caption"}, {"table", "tr"}),
    "th": ({"td", "th", "caption"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
IMPLIED["tbody"] = IMPLIED["tfoot"] = IMPLIED["thead"]
HEAD_ONLY = frozenset("base link meta title script style noscript template".split())

TAG = re.compile(r"<(?:!--(?:>|->|.*?(?:-->|--!>|\Z))|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([A-Za-z][^\s/>\x00]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>?)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([a-z-]+)", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible|initial)", re.I)
SHEET = re.compile(r"<!--.*?(?:-->|\Z)|<style([^>]*)>(.*?)(?:</style|\Z)", re.I | re.S)
CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
CSS_PART = re.compile(r"[{}]|[^{}]+")
COMPOUND = re.compile(r"(\*|[a-z][a-z0-9-]*)?((?:[.#][\w-]+)*)", re.I)
DECLARATION = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("name", "attrs", "children", "visible")

    def __init__(self, name: str, attrs: dict[str, str] | None = None, visible: bool = True) -> None:
        self.name, self.attrs, self.children, self.visible = name, attrs or {}, [], visible


class Open:
    """An open element: ``sink`` is the node that takes what it contains, None where nothing of it is shown."""

    __slots__ = ("name", "sink", "visible", "space", "depth")

    def __init__(self, name: str, sink: Node | None, visible: bool, space: str, depth: int) -> None:
        self.name, self.sink, self.visible, self.space, self.depth = name, sink, visible, space, depth


class Sheets:
    """Display and visibility from a page's own style sheets, for selectors that name the element itself."""

    def __init__(self, page: str) -> None:
        self.rules: dict[str, list[tuple]] = defaultdict(list)  # by the id, class or tag that must be there
        self.order, self.open = 0, ""  # rules so far; the selectors of the block that is open
        for m in SHEET.finditer(page):
            if m[2] is not None and self.on_screen(re.sub(r".*?\bmedia\s*=\s*[\"']?([^\"'>]*).*", r"\1", m[1], flags=re.S) if "media" in m[1].lower() else ""):
                self.read(m[2])

    @staticmethod
    def on_screen(media: str) -> bool:
        return not media.strip() or any(x.strip().lower() in ("all", "screen") for x in media.split(","))

    def read(self, css: str) -> None:
        """Rules at the top and in media blocks for screens; other blocks behind an @ are left out, with all in them."""
        nested: list[bool] = []  # of each open block, whether what is in it counts
        head = ""
        for part in CSS_PART.findall(CSS_COMMENT.sub(" ", css)):
            if part == "{":
                head = head.rsplit(";", 1)[-1].strip()
                counts = all(nested)
                if head.startswith("@"):
                    nested.append(counts and head[:6].lower() == "@media" and self.on_screen(head[6:]))
                else:
                    nested.append(False)  # declarations, no rules
                    self.open = head if counts else ""
                head = ""
            elif part == "}":
                if nested:
                    nested.pop()
                head, self.open = "", ""
            elif nested and not nested[-1]:
                if self.open:
                    self.add(self.open, part)
            else:
                head += part

    def add(self, selectors: str, body: str) -> None:
        found = [(p.lower(), v.lower(), bool(i)) for p, v, i in DECLARATION.findall(body)]
        for selector in selectors.split(",") if found else ():
            m = COMPOUND.fullmatch(selector.strip())
            if not m or not m[0]:
                continue
            names = re.findall(r"[.#][\w-]+", m[2])
            tag = (m[1] or "*").lower()
            ids = sum(n[0] == "#" for n in names)
            weight = (ids, len(names) - ids, tag != "*")
            self.order += 1
            self.rules[names[0] if names else tag].append((weight, self.order, tag, frozenset(names), found))

    def of(self, name: str, attrs: dict[str, str]) -> dict[str, tuple[str, bool]]:
        """The winning (value, important) of each property for an element."""
        if not self.rules:
            return {}
        own = {f".{c}" for c in attrs.get("class", "").split()} | ({f"#{attrs['id'].strip()}"} if "id" in attrs else set())
        best: dict[str, tuple] = {}
        for key in (*own, name, "*"):
            for weight, order, tag, names, found in self.rules.get(key, ()):
                if tag in ("*", name) and names <= own:
                    for prop, value, important in found:
                        best[prop] = max(best.get(prop, ()), ((important, weight, order), value))
        return {p: (v, rank[0]) for p, (rank, v) in best.items()}


def shown(name: str, attrs: dict[str, str], space: str, sheet: dict[str, tuple[str, bool]]) -> bool:
    if name in UNSEEN or "hidden" in attrs or (name == "dialog" and "open" not in attrs) or (name == "input" and attrs.get("type", "").lower() == "hidden"):
        return False
    if (space == "svg" and (name in UNSEEN_SVG or attrs.get("display") == "none")) or (space == "math" and name in UNSEEN_MATH):
        return False
    display, important = sheet.get("display", ("", False))
    inline = DISPLAY.findall(attrs["style"]) if "style" in attrs else []
    if inline and not important:
        display = inline[-1].lower()
    return display != "none"


def visible(attrs: dict[str, str], space: str, inherited: bool, sheet: dict[str, tuple[str, bool]]) -> bool:
    """The last visibility of the inline style, that of a style sheet or of a drawing's attribute, else the parent's."""
    found = VISIBILITY.findall(attrs["style"]) if "style" in attrs else []
    value, important = sheet.get("visibility", ("", False))
    if value in ("hidden", "collapse", "visible", "initial") and (important or not found):
        found = [value]
    if space == "svg" and "visibility" in attrs and not found:
        found = [attrs["visibility"]]
    return found[-1].lower() in ("visible", "initial") if found else inherited


def parse(page: str) -> tuple[Node, str]:
    """The tree of what a page shows, and its title."""
    root, title = Node("html"), ""
    stack = [Open("html", root, True, "", 0)]
    places: dict[str, list[int]] = defaultdict(list)  # where in the stack the open elements of a name are
    blocks: list[int] = []  # and all blocks
    sheets = Sheets(page) if "<style" in page.lower() else Sheets("")
    at = 0

    def cut(k: int) -> None:
        for e in stack[k:]:
            places[e.name].pop()
        while blocks and blocks[-1] >= k:
            blocks.pop()
        del stack[k:]

    def last(names: set[str] | frozenset[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def close(names: set[str] | frozenset[str], stop: set[str]) -> None:
        """Close all open elements of the names above the last one of ``stop``, and what is in them."""
        barrier = last(stop)
        found = [p[k] for n in names if (p := places.get(n)) and (k := bisect_right(p, barrier)) < len(p)]
        if found:
            cut(min(found))

    def add(child: Node | str) -> None:
        if stack[-1].sink is not None and (stack[-1].visible or isinstance(child, Node)):
            stack[-1].sink.children.append(child)

    def text(raw: str) -> None:
        if raw:
            if stack[-1].name == "head" and raw.strip():
                cut(len(stack) - 1)
            add(html.unescape(raw))

    while at < len(page):
        m = TAG.search(page, at)
        if not m:
            break
        text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>"))
            continue
        name = m[2].lower()
        if m[1]:
            if name == "p" and not places["p"]:
                add(Node("p"))
            elif name == "br":
                add(Node("br"))
            elif name not in ("html", "body") and places[name]:
                # a table holds back the ends of blocks from within, a block those of what is no block
                barrier = 0 if name == "table" else last({"table"}) if name in BLOCK else blocks[-1] if blocks else 0
                if places[name][-1] > barrier:
                    cut(places[name][-1])
            continue
        attrs = {a[0].lower(): html.unescape(a[1] or a[2] or a[3]) for a in ATTRIBUTE.findall(m[3])} if m[3] else {}
        if stack[-1].name == "head" and name not in HEAD_ONLY:
            cut(len(stack) - 1)
        if name in ("html", "body") and len(stack) > 1 and name == stack[1].name or name == "html":
            continue
        if name in IMPLIED:
            close(*IMPLIED[name])
        elif name in BLOCK:
            close({"p"}, {"table", "td", "th", "li", "div", "button", "object", "caption"})
        above = stack[-1]
        space = name if name in FOREIGN else "" if name == "foreignobject" else above.space
        sheet = sheets.of(name, attrs)
        seen = above.sink is not None and shown(name, attrs, space, sheet)
        node = Node(name, attrs, visible(attrs, space, above.visible, sheet))
        if name == "input" and node.visible and attrs.get("type", "").lower() in ("submit", "button", "reset"):
            node.children.append(attrs.get("value", ""))
        if seen:
            add(node)
        if (m[3] or "").endswith("/") and (name in FOREIGN or above.space in FOREIGN):
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            raw = page[at : end.start() if end else len(page)]
            at = end.end() if end else len(page)
            if name == "title" and not title and not space:
                title = SPACE.sub(" ", html.unescape(raw)).strip()
            elif name in ("textarea", "xmp") and node.visible:
                node.children.append(html.unescape(raw) if name == "textarea" else raw)
            continue
        if name not in VOID:  # a slash does not close an HTML element
            sink = None if not seen else node if above.depth < MAX_DEPTH else above.sink
            places[name].append(len(stack))
            if name in BLOCK:
                blocks.append(len(stack))
            stack.append(Open(name, sink, node.visible, space, above.depth + 1))
    text(page[at:])
    return root, title


class Lines:
    """Text set out in lines; white space collapses as it comes in."""

    def __init__(self) -> None:
        self.done: list[str] = []
        self.line: list[str] = []
        self.gap = False  # a space is due before the next word
        self.blank = False  # an empty line is due before the next line

    def put(self, text: str) -> None:
        if not text:
            return
        words = SPACE.sub(" ", text)
        if words == " ":
            self.gap = True
            return
        lead = " " if (self.gap or words[0] == " ") and self.line else ""
        self.gap = words[-1] == " "
        self.line.append(lead + words.strip(" "))

    def exact(self, text: str) -> None:
        for k, part in enumerate(text.replace("\r\n", "\n").split("\n")):
            if k:
                self.brk(keep=True)
            if part:
                self.line.append(part)

    def brk(self, keep: bool = False) -> None:
        """End the line; an empty one only if it is to be kept."""
        if self.line or keep:
            if self.blank and self.done:
                self.done.append("")
            self.blank = False
            self.done.append("".join(self.line).rstrip())
        self.line, self.gap = [], False

    def part(self) -> None:
        self.brk()
        self.blank = True

    def block(self, lines: list[str], first: str = "", rest: str = "") -> None:
        """Finished lines of an inner block, behind a mark or an indent."""
        self.brk()
        for k, line in enumerate(lines):
            self.line = [(first if k == 0 else rest if line else "") + line]
            self.brk(keep=True)


def render(node: Node, out: Lines, pre: bool = False) -> None:
    for child in node.children:
        if isinstance(child, str):
            out.exact(child) if pre else out.put(child)
            continue
        name = child.name
        if name == "br":
            out.brk(keep=True)
        elif name == "details" and "open" not in child.attrs:
            out.brk()
            summary = next((c for c in child.children if isinstance(c, Node) and c.name == "summary"), None)
            if summary:
                render(summary, out, pre)
            out.brk()
        elif name == "hr":
            out.part()
        elif name == "svg":
            render_svg(child, out)
        elif name == "math":
            render_math(child, out)
        elif name == "table":
            out.part()
            out.block(table_lines(child))
            out.part()
        elif name in ("ul", "ol", "menu", "dir"):
            nested = node.name == "li"
            out.brk() if nested else out.part()
            out.block(list_lines(child))
            out.brk() if nested else out.part()
        elif name == "blockquote" or name == "dd":
            out.part() if name == "blockquote" else out.brk()
            out.block(inner(child, pre), "  ", "  ")
            out.part() if name == "blockquote" else out.brk()
        elif name in BLOCK:
            edge = out.part if name in PARAGRAPH else out.brk
            edge()
            render(child, out, pre or name == "pre")
            edge()
        else:
            render(child, out, pre or name in ("textarea", "xmp"))


def render_svg(node: Node, out: Lines, label: bool = False) -> None:
    """The labels of a drawing: only what stands in its text elements, and HTML within it, is shown."""
    for child in node.children:
        if isinstance(child, str):
            if label:
                out.put(child)
            continue
        name, attrs = child.name, child.attrs
        apart = name in ("text", "foreignobject") or (name == "tspan" and not attrs.keys().isdisjoint(("x", "y", "dx", "dy")))
        out.gap |= apart
        render(child, out) if name == "foreignobject" else render_svg(child, out, label or name == "text")
        out.gap |= name in ("text", "foreignobject")


def render_math(node: Node, out: Lines) -> None:
    for child in node.children:
        if isinstance(child, str):
            out.put(child)
        else:
            out.gap |= child.name in APART_MATH or node.name in APART_MATH
            render_math(child, out)
            out.gap |= child.name in APART_MATH


def inner(node: Node, pre: bool = False) -> list[str]:
    out = Lines()
    render(node, out, pre)
    out.brk()
    return out.done


def list_lines(node: Node) -> list[str]:
    """Items behind ``- `` or their number; whatever else stands in the list goes on lines of its own."""
    out = Lines()
    step = -1 if node.name == "ol" and "reversed" in node.attrs else 1
    first = 1 if step > 0 else sum(isinstance(c, Node) and c.name == "li" for c in node.children)
    number = number_of(node.attrs.get("start"), first)
    loose = Node("div")

    def flush() -> None:
        if loose.children:
            out.block(inner(loose))
            loose.children = []

    for child in node.children:
        if isinstance(child, str) or child.name != "li":
            loose.children.append(child)
        else:
            flush()
            number = number_of(child.attrs.get("value"), number)
            mark = "" if not child.visible else f"{number}. " if node.name == "ol" else "- "
            number += step
            out.block(inner(child) or ([""] if mark else []), mark, " " * len(mark))
    flush()
    return out.done


def number_of(text: str | None, otherwise: int) -> int:
    return int(text) if text is not None and re.fullmatch(r"\s*-?[0-9]{1,9}\s*", text) else otherwise


def span_of(cell: Node, name: str, most: int) -> int:
    value = cell.attrs.get(name, "1").strip()
    return min(int(value), most) if re.fullmatch(r"[0-9]{1,9}", value) else 1


def table_parts(node: Node) -> Iterator[list[str] | list[Node] | None]:
    """In order: lines of text outside cells, rows of cells, and None between row groups."""
    todo = [node.children]
    while todo:
        children = todo.pop()
        row: list[Node] = []
        for k, child in enumerate(children):
            if isinstance(child, Node) and child.name in ("td", "th"):
                row.append(child)
            elif isinstance(child, Node) and child.name in ("tr", "thead", "tbody", "tfoot"):
                todo.append(children[k + 1 :])
                if child.name != "tr":
                    yield None
                    todo[-1] = [GROUP_END, *todo[-1]]
                todo.append(child.children)
                break
            elif child is GROUP_END:
                yield None
            else:
                lone = Node("div")
                lone.children = [child]
                if lines := inner(lone):
                    yield lines
        if row:
            yield row


GROUP_END = Node("")


class Cell(NamedTuple):
    start: int
    stop: int
    lines: list[str]


def table_grid(node: Node) -> list[list[str] | list[Cell]]:
    """Lines of text outside cells, and rows of cells with the columns they cover; columns in which no cell starts are none."""
    parts: list[list[str] | list[Cell]] = []
    taken: dict[int, int] = {}  # columns that a cell of an earlier row still covers, and for how many rows
    for part in table_parts(node):
        if part is None:
            taken = {}
        elif isinstance(part[0], str):
            parts.append(part)
        else:
            at, cells, covered = 0, [], {}
            for cell in part:
                while at in taken:
                    at += 1
                stop = at + max(span_of(cell, "colspan", MAX_COLSPAN), 1)
                rows = span_of(cell, "rowspan", MAX_ROWSPAN) or MAX_ROWSPAN  # 0: to the end of the group
                cells.append(Cell(at, stop, [part for line in inner(cell) for part in wrapped(line)]))
                if rows > 1:
                    covered |= dict.fromkeys(range(at, stop), rows - 1)
                at = stop
            taken = {c: n - 1 for c, n in taken.items() if n > 1} | covered
            parts.append(cells)
    starts = sorted({c.start for p in parts for c in p if isinstance(c, Cell)})
    return [[Cell(bisect_left(starts, c.start), bisect_left(starts, c.stop), c.lines) if isinstance(c, Cell) else c for c in p] for p in parts]


def wrapped(line: str, width: int = WRAP) -> list[str]:
    """A line in parts of at most ``width``, broken at spaces where there are any; further lines keep its indent."""
    if len(line) <= width:
        return [line]
    indent = line[: len(line) - len(line.lstrip(" "))]
    indent = indent if len(indent) < width // 2 else ""
    out, at = [], 0
    lead = ""
    while len(line) - at > width - len(lead):
        stop = line.rfind(" ", at + len(indent) + 1 if not at else at + 1, at + width - len(lead) + 1)
        stop = stop if stop > at else at + width - len(lead)
        out.append(lead + line[at:stop].rstrip(" "))
        at = stop + (line[stop : stop + 1] == " ")
        lead = indent
    return [*out, lead + line[at:]]


def table_lines(node: Node) -> list[str]:
    """Rows of cells in columns of equal width; text outside cells comes on lines before its row."""
    grid = table_grid(node)
    rows = [p for p in grid if isinstance(p[0], Cell)]
    cells = [c for row in rows for c in row]
    widths = [0] * max([c.stop for c in cells], default=0)
    for c in sorted(cells, key=lambda c: c.stop - c.start):  # a cell over several columns widens the last of them
        widths[c.stop - 1] += max(0, max(map(len, c.lines), default=0) - sum(widths[c.start : c.stop]) - 3 * (c.stop - c.start - 1))
    places = [0]
    for w in widths:
        places.append(places[-1] + w + 3)
    lines: list[str] = []
    for part in grid:
        if isinstance(part[0], str):
            lines += part
            continue
        for height in range(max(1, *(len(c.lines) for c in part))):
            column, line = 0, []
            for c in part:
                line += [" " * w for w in widths[column : c.start]]  # columns covered from above
                line.append((c.lines[height] if height < len(c.lines) else "").ljust(places[c.stop] - places[c.start] - 3))
                column = c.stop
            lines.append(" | ".join(line).rstrip())
    return lines


def page_text(page: str | None) -> tuple[str, str]:
    """(title, visible text) of a page."""
    if not page:
        return "", ""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20 * MAX_DEPTH))  # a few frames for each level
    root, title = parse(page)
    return title, "\n".join(inner(root)).strip("\n")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, title, text): a row per page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            found = [page_text(p) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.string()) for c in zip(*found, strict=True))], ["page_id", "title", "text"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "html").mapInArrow(run, "page_id long, title string, text string")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "title", "text", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))
