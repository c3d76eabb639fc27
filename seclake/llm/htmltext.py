"""Visible text of HTML pages by layout-aware rendering.

1. ``build`` reads the markup into a tree. Tags that HTML implies are added
   (a row for a cell outside one, an end for a paragraph before a block, for an
   item before the next one, for everything inside an element that ends); what may
   not stand between a table's parts moves before the table, as in browsers, in a block of its own, and cells, rows
   and sections come out of what misplaced elements stand around them;
   elements below ``DEPTH`` levels become siblings, as in browsers, so that no
   text is lost and nothing recurses deeper. One pass, linear in the page.
2. ``render`` walks the tree. Invisible elements go (scripts, styles, the
   head, templates, ``hidden``, ``display:none``, closed dialogs, and so on).
   White space collapses as in a browser; blocks begin lines, paragraphs
   and the like have an empty line around them, list items a mark and an
   indent; cells of small data tables stand in aligned columns, and a
   table with long or many-line cells (a layout table) is rendered block by block.

Null or empty html gives an empty text. Broken markup never fails: what can't be
a tag is text, an open tag or comment at the end is dropped. Whole pages are read.
"""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEPTH = 200
CELL_WIDTH = 60      # of a cell in an aligned table
TABLE_WIDTH = 400    # of an aligned row
SPAN = 1000          # columns that a cell may span, as in HTML

# The element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title template".split())
HIDDEN = frozenset("head script style template noscript title meta link iframe noembed noframes object video audio canvas svg datalist map area param".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset menu dir hr".split())
BLOCK = SPACED | frozenset("html body address article aside center details dialog dd div dt figcaption footer form header hgroup legend li main nav option optgroup section summary tr td th thead tbody tfoot caption search".split())
CLOSES_P = SPACED | frozenset("address article aside center details dialog div dd dt figcaption footer form header hgroup li main menu nav section summary search".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An element that ends the open ones named, up to the nearest of the limits.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir", "table")), "dt": (("dt", "dd"), ("dl", "table")), "dd": (("dt", "dd"), ("dl", "table")),
    "option": (("option",), ("select", "datalist")), "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th", "caption"), ("table",)), "th": (("td", "th", "caption"), ("table",)), "tr": (("tr", "td", "th", "caption"), ("table",)),
    "thead": (("thead", "tbody", "tfoot", "tr", "caption"), ("table",)), "tbody": (("thead", "tbody", "tfoot", "tr", "caption"), ("table",)), "tfoot": (("thead", "tbody", "tfoot", "tr", "caption"), ("table",)),
}
SECTIONS = ("thead", "tbody", "tfoot")
CELLS = ("td", "th", "caption")
#: Elements of a table that hold only other parts of it, and those parts.
FRAMES = frozenset(("table", "tr", "colgroup", *SECTIONS))
PARTS = frozenset(("tr", "colgroup", "col", *SECTIONS, *CELLS))
P_LIMITS = ("table", "td", "th", "caption", "button", "object", "template")

NAME = re.compile(r"/?([A-Za-z][^\s/>]*)")
STOP = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([^\s=>\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
BLANKS = re.compile(r"[ \t\n\r\f]+")
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
COMMENT_END = re.compile("--!?>")
RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}


class Element:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def get(self, name: str) -> str | None:
        """An attribute's value, empty for one without value."""
        if name not in self.attributes.lower():
            return None
        for m in ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == name:
                return next((unescape(v) for v in m.groups()[1:] if v is not None), "")
        return None


def _tag_end(html: str, at: int, missing: set[str]) -> int:
    """Position of the > that ends a tag, beyond quoted values; -1 if there is none. ``missing``: quotes that don't come again."""
    while m := STOP.search(html, at):
        at = m.end()
        if m[0] == ">":
            return at - 1
        if m[0] not in missing and html[max(0, m.start() - 64):m.start()].rstrip()[-1:] == "=":
            close = html.find(m[0], at)
            if close < 0:
                missing.add(m[0])
            else:
                at = close + 1
    return -1


def build(html: str) -> Element:
    root = Element("html")
    stack, open_tags = [root], {"html": 1}
    moved: dict[int, Element] = {}  # by open table: the block before it that misplaced content goes to

    def add(child: Element | str) -> None:
        """Into the open element, or before its table if it may not stand there."""
        if stack[-1].tag not in FRAMES or not open_tags.get("table"):
            stack[-1].children.append(child)
            return
        k = next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == "table")
        block = moved.get(id(stack[k]))
        if isinstance(child, Element) and child.tag in PARTS:
            moved.pop(id(stack[k]), None)  # what is misplaced after a part is a block of its own
            stack[-1].children.append(child)
        elif child.tag in HIDDEN if isinstance(child, Element) else not child.strip() and block is None:
            stack[-1].children.append(child)
        else:
            if block is None:
                block = moved[id(stack[k])] = Element("div")
                stack[k - 1].children.insert(len(stack[k - 1].children) - 1, block)  # an open table is the last child
            block.children.append(child)

    def push(element: Element) -> None:
        add(element)
        if len(stack) < DEPTH:
            stack.append(element)
            open_tags[element.tag] = open_tags.get(element.tag, 0) + 1

    def cut(size: int) -> None:
        while len(stack) > size:
            open_tags[stack.pop().tag] -= 1

    def end(names, limits) -> None:
        """Ends the outermost open element of ``names`` inside the nearest of ``limits``."""
        if any(open_tags.get(n) for n in names):
            found = 0
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in limits:
                    break
                if stack[k].tag in names:
                    found = k
            if found:
                cut(found)

    def imply(tag: str) -> None:
        """What stands between a table's parts and the open element."""
        if tag not in PARTS:
            return
        if not open_tags.get("table"):
            push(Element("table"))
        above = clear("table", *(("tr", *SECTIONS) if tag in ("td", "th") else SECTIONS if tag == "tr" else ()))
        if tag in ("td", "th") and above != "tr":
            push(Element("tr"))

    def clear(*frames: str) -> str | None:
        """Ends everything inside the nearest open element of ``frames``, and returns its tag."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in frames:
                cut(k + 1)
                return stack[k].tag
        return None

    def frame() -> bool:
        """Whether a table is open, and no cell or caption of it."""
        return bool(open_tags.get("table")) and next((x.tag not in CELLS for x in reversed(stack) if x.tag in CELLS or x.tag in FRAMES), False)

    def start(tag: str, attributes: str) -> Element | None:
        if tag in ("html", "body"):
            if tag == "body":
                end(("head",), ())
            return None
        if tag == "table" and frame():  # it ends the open one
            clear("table")
            cut(len(stack) - 1)
        elif tag in ("caption", "colgroup", "col") and frame():
            clear(*(("table", "colgroup") if tag == "col" else ("table",)))
        elif tag == "form" and stack[-1].tag in FRAMES:
            return None  # browsers leave it empty there
        if open_tags.get("p") and tag in CLOSES_P:
            end(("p",), P_LIMITS)
        if tag in HEADINGS and stack[-1].tag in HEADINGS:
            cut(len(stack) - 1)
        if tag in ENDS:
            end(*ENDS[tag])
            imply(tag)
        if open_tags.get("head") and tag not in HIDDEN and tag != "base":
            end(("head",), ())
        element = Element(tag, attributes)
        if tag in VOID:
            add(element)
        else:
            push(element)
        return element

    at, missing, n = 0, set(), len(html)
    while at < n:
        lt = html.find("<", at)
        text_end = n if lt < 0 else lt
        if text_end > at:
            add(html[at:text_end])
        if lt < 0:
            break
        if html.startswith("<!--", lt):
            if html.startswith((">", "->"), lt + 4):  # an empty comment
                at = html.index(">", lt) + 1
            else:
                m = COMMENT_END.search(html, lt + 4)
                at = n if m is None else m.end()
            continue
        if html.startswith(("<!", "<?"), lt):
            close = html.find(">", lt)
            at = n if close < 0 else close + 1
            continue
        m = NAME.match(html, lt + 1)
        if not m:
            add("<")
            at = lt + 1
            continue
        close = _tag_end(html, m.end(), missing)
        if close < 0:
            break
        tag, at = m[1].lower(), close + 1
        if html[lt + 1] == "/":
            if tag == "br":
                start("br", "")
            elif tag == "p" and not open_tags.get("p"):
                push(Element("p"))
                cut(len(stack) - 1)
            elif tag not in ("html", "body") and open_tags.get(tag):
                limits = () if tag in ("table", "td", "th", "tr", "tbody", "thead", "tfoot", "caption") else ("td", "th", "caption")
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        cut(k)
                        break
                    if stack[k].tag in limits or tag not in BLOCK and stack[k].tag in BLOCK:
                        break
            continue
        element = start(tag, html[m.end():close])
        if tag in RAW:
            stop = RAW_END[tag].search(html, at)
            if tag in ("textarea", "xmp"):
                element.children.append(html[at:stop.start() if stop else n])
            if stack[-1] is element:
                cut(len(stack) - 1)
            close = html.find(">", stop.start()) if stop else -1
            at = n if close < 0 else close + 1
    return root


def visible(element: Element) -> bool:
    if element.tag in HIDDEN:
        return False
    if not element.attributes:
        return element.tag != "dialog"
    return not (element.get("hidden") is not None or INVISIBLE.search(element.get("style") or "")
                or element.tag == "input" or element.tag == "dialog" and element.get("open") is None)


class Lines:
    """Finished lines of a block, and the one being written."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = False

    def text(self, text: str) -> None:
        """Inline text, its white space collapsed, also against what stands before."""
        text = BLANKS.sub(" ", text)
        if text[:1] == " " and (not self.line or self.line[-1][-1:] == " "):
            text = text[1:]
        if text:
            self.line.append(text)

    def end_line(self) -> None:
        line = "".join(self.line).rstrip(" ")
        self.line = []
        if line:
            if self.gap and self.lines:
                self.lines.append("")
            self.lines.append(line)
            self.gap = False

    def add(self, lines: list[str], spaced: bool) -> None:
        """A finished block, which may hold empty lines of its own."""
        self.end_line()
        if lines:
            if (spaced or self.gap) and self.lines:
                self.lines.append("")
            self.lines += lines
            self.gap = spaced
        elif spaced:
            self.gap = True


def render(element: Element, pre: bool = False, depth: int = 0) -> list[str]:
    """Lines of an element's visible text."""
    out = Lines()
    _flow(element, out, pre, depth)
    out.end_line()
    return out.lines


def _flow(element: Element, out: Lines, pre: bool, depth: int) -> None:
    number = _number(element.get("start")) if element.tag == "ol" else 0
    for child in element.children:
        if isinstance(child, str):
            text = unescape(child) if "&" in child else child
            text = text.replace("\xa0", " ") if not pre else text
            if pre:
                first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
                if first:
                    out.line.append(first)
                for line in rest:
                    out.lines.append("".join(out.line))
                    out.line = [line] if line else []
            else:
                out.text(text)
            continue
        if not visible(child):
            continue
        tag = child.tag
        if tag == "br":
            line = "".join(out.line).rstrip(" ")
            out.line = []
            if out.gap and out.lines and line:
                out.lines.append("")
            if out.lines or line:
                out.lines.append(line)
            out.gap = False
        elif tag == "hr":
            out.add([], True)
        elif tag in ("td", "th") and element.tag == "tr":
            out.add(render(child, pre, depth), False)
        elif tag in BLOCK:
            inner_pre = pre or tag in ("pre", "xmp")
            if tag == "table":
                lines = table(child, depth)
            else:
                lines = render(child, inner_pre, depth + (tag in ("ul", "ol", "menu", "dir")))
            if inner_pre and not pre:
                while lines and not lines[0].strip():
                    del lines[0]
                while lines and not lines[-1].strip():
                    del lines[-1]
            while lines and not lines[-1]:
                del lines[-1]
            if tag == "li":
                mark = f"{number}. " if element.tag == "ol" else "- "
                number += 1
                lines = [mark + lines[0], *[" " * len(mark) + x if x else x for x in lines[1:]]] if lines else []
            elif tag in ("dd", "blockquote"):
                lines = ["  " + x if x else x for x in lines]
            out.add(lines, tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and (depth or element.tag == "li")))
        else:
            _flow(child, out, pre, depth)


def _number(text: str | None) -> int:
    return int(text) if text and re.fullmatch(r"-?[0-9]{1,9}", text.strip()) else 1


def _rows(element: Element):
    for child in element.children:
        if isinstance(child, Element) and visible(child):
            if child.tag == "tr":
                yield child
            elif child.tag in ("thead", "tbody", "tfoot"):
                yield from _rows(child)


def _captions(element: Element):
    """Captions, and cells without a row (below ``DEPTH`` levels)."""
    for child in element.children:
        if isinstance(child, Element) and visible(child):
            if child.tag in SECTIONS or child.tag == "colgroup":
                yield from _captions(child)
            elif child.tag in CELLS:
                yield child


def table(element: Element, depth: int) -> list[str]:
    """Aligned columns if all cells are short single lines, else the cells as blocks."""
    rows, widths = [], []
    for row in _rows(element):
        cells = []
        for cell in row.children:
            if isinstance(cell, Element) and cell.tag in ("td", "th") and visible(cell):
                lines = render(cell, False, depth)
                span = _number(cell.get("colspan"))
                cells.append((lines, min(max(span, 1), SPAN)))
        if cells:
            rows.append(cells)
    small = all(len(lines) <= 1 and len("".join(lines)) <= CELL_WIDTH for cells in rows for lines, _ in cells)
    if small:
        for cells in rows:
            at = 0
            for lines, span in cells:
                widths += [0] * (at + 1 - len(widths))
                if span == 1:
                    widths[at] = max(widths[at], len("".join(lines)))
                at += span
        small = len(widths) <= SPAN and sum(widths) + 2 * len(widths) <= TABLE_WIDTH
    out = Lines()
    for child in _captions(element):
        out.add(render(child, False, depth), False)
    out.end_line()
    for cells in rows:
        if small:
            line, at = [], 0
            for lines, span in cells:
                width = sum(widths[at:at + span]) + 2 * (len(widths[at:at + span]) - 1)
                line.append("".join(lines).ljust(width))
                at += span
            out.add([x] if (x := "  ".join(line).rstrip(" ")) else [], False)
        else:
            for lines, _ in cells:
                out.add(lines, False)
    return out.lines


def text_of(html: str | None) -> str:
    lines = render(build(html or ""))
    while lines and not lines[-1].strip():
        del lines[-1]
    return "\n".join(lines)


def text_column(html: Column) -> Column:
    return F.pandas_udf(lambda pages: pd.Series([text_of(h) for h in pages], dtype=object), "string")(html)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id and ``text``."""
    return pages.select(F.col(id_col), text_column(F.col(html_col)).alias("text"))
