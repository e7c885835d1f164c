"""Visible text of web pages, laid out as it is shown."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Element names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("head title script style template noscript noembed noframes iframe object audio video canvas datalist".split())
BLOCK = set(("html body address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
             "header hgroup hr legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr td th caption ul").split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure fieldset hr".split())
#: An open element that ends where one of these begins, looked for up to the elements that bound it.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}), "thead": ({"caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select", "datalist"}),
}
#: Drawings and formulas, what they hold without showing it, and what stands apart from the words around it.
_FOREIGN, _UNSHOWN = {"svg", "math"}, set("desc metadata defs symbol clippath mask annotation annotation-xml".split())
_APART = {"text", "textarea", "select"}
#: What may stand in a head; anything else ends it.
_HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
#: Parts of a table that hold only other parts, and all parts; what else stands in the former is shown before the table.
_FRAME, _PARTS = set("table thead tbody tfoot tr colgroup".split()), set("caption colgroup thead tbody tfoot tr td th".split())
_ENDS_P = BLOCK - {"html", "body", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "optgroup", "option", "legend"}


_VISIBLE = re.compile("(?:^|;)visibility:(visible|hidden|collapse)")
_PRESERVED = re.compile("(?:^|;)white-space:(pre|normal|nowrap)")


class Element:
    """One element; ``lines`` are those of a table laid out already."""

    __slots__ = ("tag", "attrs", "children", "lines")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children, self.lines = tag, attrs, [], []

    def _style(self) -> str:
        return "".join(self.attrs["style"].lower().split()) if "style" in self.attrs else ""

    def shown(self) -> bool:
        return not (self.tag in HIDDEN or "hidden" in self.attrs or "display:none" in self._style()
                    or self.tag == "input" or (self.tag == "dialog" and "open" not in self.attrs))

    def visible(self, inherited: bool) -> bool:
        """Whether its own text shows; unlike ``shown``, elements inside may decide otherwise."""
        found = _VISIBLE.search(self._style()) if "style" in self.attrs else None
        return found[1] == "visible" if found else inherited

    def preserved(self, inherited: bool) -> bool:
        """Whether its white space and line breaks show as they are."""
        found = _PRESERVED.search(self._style()) if "style" in self.attrs else None
        return found[1] == "pre" if found else inherited or self.tag in ("pre", "listing", "xmp")

    def content(self) -> list:
        """The children that count: a closed details element shows its summary alone, a list field its chosen options."""
        if self.tag == "details" and "open" not in self.attrs:
            return [c for c in self.children if isinstance(c, Element) and c.tag == "summary"][:1]
        if self.tag == "select":
            return [x for o in _options(self) for x in (" ", *o.children, " ")]
        return self.children

    def number(self, name: str, other: int, least: int, most: int) -> int:
        """An attribute's whole number within bounds, ``other`` if it has none."""
        found = re.match(r"\s*([+-]?[0-9]{1,9})", self.attrs.get(name, ""))
        return min(max(int(found[1]), least), most) if found else other


class Tree(HTMLParser):
    """Elements nested as a browser would nest them: end tags may be missing, misplaced or double."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.root = Element("html", {})
        self.open = [self.root]
        self.drawn = False
        self.homes: dict[int, list] = {}  # where each open table stands
        self.feed(page)
        self.close()

    def _close(self, tags: set[str], bounds: set[str]) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in tags:
                del self.open[at:]
            elif self.open[at].tag in bounds:
                return

    def _table(self) -> int:
        """Place of the innermost open table, 0 if there is none or a template in it is open."""
        return next((at if self.open[at].tag == "table" else 0 for at in range(len(self.open) - 1, 0, -1) if self.open[at].tag in ("table", "template")), 0)

    def _in_table(self, tag: str) -> bool:
        """Closes and opens what the start tag implies in a table; False if a browser drops the tag there."""
        if self.open[-1].tag == "colgroup" and tag not in ("col", "template"):
            self.open.pop()
        if tag == "table" and self.open[-1].tag in _FRAME:
            del self.open[self._table() :]
        elif tag in _PARTS and (at := self._table()):
            at += 1
            if tag in ("tr", "td", "th") and at < len(self.open) and self.open[at].tag in ("thead", "tbody", "tfoot"):
                at += 1
            if tag in ("td", "th") and at < len(self.open) and self.open[at].tag == "tr":
                at += 1
            del self.open[at:]
            if tag in ("td", "th") and self.open[-1].tag != "tr":
                self._put(Element("tr", {}))
        return tag != "form" or self.open[-1].tag not in _FRAME

    def _put(self, child: Element | str) -> None:
        """Adds a child to the innermost open element, or in front of the table if that can't hold it."""
        home, tag = self.open[-1].children, "" if isinstance(child, str) else child.tag
        if self.open[-1].tag in _FRAME and tag not in _PARTS | {"col", "script", "style", "template"} and (at := self._table()):
            home = self.homes[id(self.open[at])]
            home.insert(len(home) - 1, child)  # an open table is the last child
        else:
            home.append(child)
        if tag and tag not in VOID:
            self.open.append(child)
        if tag == "table":
            self.homes[id(child)] = home

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body") and any(e.tag == tag for e in self.open):
            return
        if tag == "head" and (len(self.open) > 1 or any(isinstance(c, Element) or c.strip() for c in self.root.children)):
            return  # a browser has begun the head or the body already
        if tag == "body":
            self._close({"head"}, set())
        if self.open[-1].tag == "head" and tag not in _HEAD:
            self.open.pop()
        if self.homes and not self._in_table(tag):
            return
        if tag in _ENDS_P:
            self._close({"p"}, {"table", "td", "th", "button", "caption", "object"})
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
        element = Element(tag, {k: v or "" for k, v in attrs})
        if tag in _UNSHOWN and self._foreign():
            element.attrs["hidden"] = ""
        self.drawn = self.drawn or tag in _FOREIGN
        self._put(element)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        foreign = tag in _FOREIGN or self._foreign()
        self.handle_starttag(tag, attrs)
        if foreign and self.open[-1].tag == tag and len(self.open) > 1:
            self.open.pop()

    def _foreign(self) -> bool:
        """Whether the innermost place is in a drawing or formula."""
        return self.drawn and next((e.tag in _FOREIGN for e in reversed(self.open) if e.tag in _FOREIGN or e.tag == "foreignobject"), False)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID or tag in ("html", "body"):
            if tag == "br":
                self.handle_starttag("br", [])
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                del self.open[at:]
                return
            if self.open[at].tag == "table" or (self.open[at].tag in ("td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot")):
                return

    def handle_data(self, data: str) -> None:
        if not data.strip():
            self.open[-1].children.append(data)
            return
        if self.open[-1].tag in ("head", "colgroup"):
            self.open.pop()
        self._put(data)


#: White space that runs together; no-break spaces don't.
_SPACE = " \t\n\r\f"
_WORDS = re.compile(f"[^{_SPACE}]+")


class Lines:
    """Text put together line by line, with white space as it is shown."""

    def __init__(self):
        self.lines: list[str] = []
        self.line = ""
        self.space = self.gap = False
        self.prefix: list[str] = []
        self.marker = ""

    def text(self, data: str) -> None:
        words = _WORDS.findall(data)
        if not words:
            self.space = self.space or bool(data)
            return
        if self.line and (self.space or data[0] in _SPACE):
            self.line += " "
        self.line += " ".join(words)
        self.space = data[-1] in _SPACE

    def raw(self, data: str) -> None:
        """Text whose spaces and line breaks show; of several empty lines one stays."""
        for k, line in enumerate(data.replace("\r\n", "\n").split("\n")):
            if k:
                empty = not self.line.strip()
                self.end()
                self.gap = self.gap or empty
            self.line += " " + line if self.space and self.line else line
            self.space = False

    def end(self, gap: bool = False) -> None:
        """The line ends; with ``gap`` the next one stands after an empty one."""
        line = self.line.replace("\xa0", " ").rstrip()
        if line:
            if self.gap and self.lines:
                self.lines.append("")
            self.lines.append("".join(self.prefix) + self.marker + line)
            if self.marker:
                self.prefix.append(" " * len(self.marker))
                self.marker = ""
            self.gap = False
        self.line, self.space = "", False
        self.gap = self.gap or gap


#: Cells longer than this don't widen their column, so that one long cell doesn't fill all other rows with spaces.
_ALIGNED = 200


def _cell(cell: Element, visible: bool) -> list[str]:
    """Lines of a cell: several if it holds a list, a line break or preserved text, else one."""
    lines, stack = render(cell, visible), [cell]
    while stack:
        element = stack.pop()
        if element.tag in ("li", "br", "pre"):
            return lines
        stack.extend(c for c in element.children if isinstance(c, Element) and c.tag != "table" and c.shown())
    return [" ".join(" ".join(lines).split())]


def _groups(table: Element, visible: bool) -> list[list[tuple[Element, bool]]]:
    """The rows of each part of a table, with whether they are visible; rows in no part are one of their own."""
    groups, loose = [], None
    for child in table.children:
        if not isinstance(child, Element) or not child.shown():
            continue
        if child.tag == "tr":
            if loose is None:
                loose = []
                groups.append(loose)
            loose.append((child, child.visible(visible)))
        elif child.tag in ("thead", "tbody", "tfoot"):
            seen, loose = child.visible(visible), None
            groups.append([(r, r.visible(seen)) for r in child.children if isinstance(r, Element) and r.tag == "tr" and r.shown()])
    return groups


def _rows(table: Element, visible: bool) -> list[list[tuple[int, int, list[str]]]]:
    """Per row its cells: first column, column after the last, lines. A cell of several rows keeps its columns in those below."""
    rows = []
    for group in _groups(table, visible):
        taken: dict[int, int] = {}  # rows that a column is still taken for
        for row, seen in group:
            cells, at, tall = [], 0, {}
            for cell in row.children:
                if isinstance(cell, Element) and cell.tag in ("td", "th") and cell.shown():
                    while at in taken:
                        at += 1
                    end = at + cell.number("colspan", 1, 1, 1000)
                    cells.append((at, end, _cell(cell, cell.visible(seen))))
                    if (n := cell.number("rowspan", 1, 0, 65534) or len(group)) > 1:
                        tall.update(dict.fromkeys(range(at, end), n))
                    at = end
            taken = {k: n - 1 for k, n in {**taken, **tall}.items() if n > 1}
            rows.append(cells)
    return rows


def _table(table: Element, visible: bool) -> list[str]:
    """Lines of a table: captions, then rows whose cells line up. The tables inside must be laid out."""
    captions = [c for c in table.children if isinstance(c, Element) and c.tag == "caption" and c.shown()]
    lines = [line for c in captions for line in render(c, c.visible(visible))]
    rows = _rows(table, visible)
    place = {edge: i for i, edge in enumerate(sorted({edge for row in rows for cell in row for edge in cell[:2]}))}
    width = [0] * len(place)
    spans = sorted((place[end] - place[at], place[at], n) for row in rows for at, end, text in row if 0 < (n := max(map(len, text), default=0)) <= _ALIGNED)
    for span, at, n in spans:
        free = sum(w + 2 for w in width[at : at + span] if w) - 2
        if n > max(free, 0):
            width[at + span - 1] += n - free if free > 0 else n
    start, total = [], 0
    for w in width:
        start.append(total)
        total += w + 2 if w else 0
    for row in rows:
        for k in range(max((len(text) for _, _, text in row), default=0)):
            line = ""
            for at, _, text in row:
                if k < len(text) and text[k]:
                    line = (line + "  " if line else "").ljust(start[place[at]]) + text[k]
            lines.append(line)
    return lines


def _lay_out(root: Element) -> None:
    """All tables that show, the innermost first, so that nesting needs no recursion."""
    found, stack = [], [(root, root.visible(True))]
    while stack:
        element, visible = stack.pop()
        if element.tag == "table":
            found.append((element, visible))
        stack.extend((c, c.visible(visible)) for c in element.content() if isinstance(c, Element) and c.shown())
    for table, visible in reversed(found):
        table.lines = _table(table, visible)


def _options(select: Element) -> list[Element]:
    """The options that a closed list shows, or all of an open one."""
    found, stack = [], [select]
    while stack:
        element = stack.pop()
        if element.tag == "option":
            found.append(element)
        stack.extend(c for c in reversed(element.children) if isinstance(c, Element) and c.shown())
    if "multiple" in select.attrs or select.attrs.get("size", "").strip() not in ("", "0", "1"):
        return found
    return ([o for o in found if "selected" in o.attrs][-1:] or [o for o in found if "disabled" not in o.attrs][:1] or found[:1])


def _walk(root: Element, out: Lines, visible: bool) -> None:
    """Depth first with an own stack, as pages may be nested without limit."""
    stack: list = [(root, iter(root.content()), [0], visible, root.preserved(False))]
    while stack:
        element, children, number, visible, preserved = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            if element is not root:
                _leave(element, out)
        elif isinstance(child, str):
            if visible and preserved:
                out.raw(child)
            elif visible:
                out.text(child)
        elif child.shown():
            if child.tag == "li":
                number[0] = child.number("value", number[0] + 1, -10**9, 10**9)
            seen = child.visible(visible)
            if child.tag == "table":
                out.end(True)
                for line in child.lines:
                    out.line = line
                    out.end()
                child.lines = []
                out.end(True)
            elif _enter(child, out, element, number[0], seen):
                first = child.number("start", 1, -10**9, 10**9) - 1 if child.tag == "ol" else 0
                stack.append((child, iter(child.content()), [first], seen, child.preserved(preserved)))


def _enter(element: Element, out: Lines, parent: Element, number: int, visible: bool) -> bool:
    if element.tag == "br":
        out.end()
    elif element.tag in _APART:
        out.text(" ")
    elif element.tag == "img":
        out.text(" " + element.attrs["alt"] + " " if visible and element.attrs.get("alt", "").strip() else "")
    elif element.tag in BLOCK:
        nested = element.tag in ("ul", "ol") and parent.tag == "li"
        out.end(element.tag in SPACED and not nested)
        if element.tag == "li":
            element.attrs["_depth"] = str(len(out.prefix))
            out.marker = f"{number}. " if parent.tag == "ol" else "- "
        elif element.tag in ("dd", "blockquote"):
            out.prefix.append("  ")
    return element.tag not in VOID


def _leave(element: Element, out: Lines) -> None:
    if element.tag in BLOCK:
        out.end(element.tag in SPACED)
    elif element.tag in _APART:
        out.text(" ")
    if element.tag == "li":
        out.marker = ""
        del out.prefix[int(element.attrs["_depth"]) :]
    elif element.tag in ("dd", "blockquote") and out.prefix:
        out.prefix.pop()


def render(root: Element, visible: bool = True) -> list[str]:
    """Lines of an element whose tables are laid out."""
    out = Lines()
    _walk(root, out, visible)
    out.end()
    return out.lines


def visible_text(page: str | None) -> str:
    """All visible text of a page; pages that break the parser are read as text between tags."""
    if not page:
        return ""
    try:
        root = Tree(page).root
        _lay_out(root)
        return "\n".join(render(root, root.visible(True)))
    except AssertionError:
        return " ".join(entities.unescape(" ".join(x.rpartition(">")[2] for x in page.split("<"))).split())


def _extracted(columns: list[str]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [visible_text(p) for p in part["html"].to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part[c] for c in columns), pa.array(texts, pa.string())], [*columns, "text"])
    return scan


def extract(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Per row: page_id, text, n_chars, n_lines.

    A tree with the end tags that pages leave out decides what is shown: scripts, styles, hidden elements, closed details and
    what is typed into input fields are not; formulas, labels of drawings, text areas and chosen options are, and so is what is
    visible inside an invisible element. Blocks begin lines, paragraphs, headings, lists and tables stand apart, list items have
    marks or numbers (from ``start`` and ``value``), preserved text keeps its spaces and lines. Cells of a table's columns line up, spans
    included; a cell with a list, break or preserved text takes several lines. Any depth of nesting and
    length of page is read whole. Null and empty pages give an empty text; null and
    repeated ids keep their rows; other columns are ignored; nothing is shuffled.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(html).alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    out = rows.mapInArrow(_extracted(["page_id"]), f"page_id {kind}, text string")
    lines = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    return out.select("page_id", "text", F.length("text").cast("long").alias("n_chars"), lines.alias("n_lines"))
