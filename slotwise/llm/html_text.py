"""HTML extraction by layout-aware rendering.

A tree builder reads any byte soup as browsers do in the cases that matter for text: implied end
tags (paragraphs end at blocks, items at items, cells and rows at cells and rows), implied rows,
void and raw-text elements, unclosed elements at the end, comments, truncated tags. Visibility
rules drop what is never rendered, hidden attributes, inline styles and the page's own style
rules with display:none or visibility:hidden for tags, classes and ids, together, below each other
or as children (selectors with other signs select nothing), and closed details. The
renderer emits all other text: white space collapsed outside pre, one new line around blocks, a
blank line around paragraphs, headings, lists and tables, list items with their marks and indent,
and table cells padded to common columns, column and row spans included.

Column spans are at most 1000, as in the HTML standard; row spans end with their section, and columns beyond 1000 have
none. All passes use an explicit stack and are linear in the page, tables nested deeper than NESTED
are rendered without alignment, so deep or broken pages are no harder than others.

Defined results: null html is an empty text; an empty page is an empty text; null page_ids and
repeated rows are each returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm import common as C

NESTED, MOST_COLUMNS = 4, 1000


def _set(names: str) -> frozenset[str]:
    return frozenset(names.split())


VOID = _set("area base br col embed hr img input link meta param source track wbr")
RAW = _set("iframe noembed noframes script style textarea title xmp")
UNSEEN = _set("audio base canvas datalist head iframe link meta noembed noframes noscript object param script source style svg template title track video")
HEADINGS = _set("h1 h2 h3 h4 h5 h6")
BLOCKS = _set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul caption") | HEADINGS
SPACED = _set("blockquote dl figure menu ol p pre table ul") | HEADINGS
#: What a start tag ends, and where looking for it stops.
_CELLS, _SECTIONS = _set("td th"), _set("tbody tfoot thead")
ENDS_P = BLOCKS - _set("body caption dd dt html legend li optgroup option tbody tfoot thead tr")
ENDED = {
    "li": (_set("li"), _set("ol ul menu dir table td th")),
    **dict.fromkeys(("dd", "dt"), (_set("dd dt"), _set("dl table td th"))),
    **dict.fromkeys(("td", "th"), (_CELLS, _set("table"))),
    "tr": (_set("td th tr"), _set("table")),
    **dict.fromkeys(("tbody", "tfoot", "thead"), (_set("td th tr tbody tfoot thead caption"), _set("table"))),
    "option": (_set("option"), _set("select datalist")),
    "optgroup": (_set("option optgroup"), _set("select")),
}
_BOUND_P = _set("button caption table td th li")
#: Elements that an end tag of another name doesn't reach beyond.
_BOUND_END = {"table": _set(""), **dict.fromkeys(("tr", "td", "th", "tbody", "thead", "tfoot", "caption"), _set("table"))}
_CELL_BOUND = _set("td th table caption")

_NAME = re.compile(r"[A-Za-z][^\s/>]*+")
#: A quote opens a value only right after its sign, as in browsers; elsewhere it is a part of the name or value.
_VALUE = r"""[ \t\n\r\f]*+=[ \t\n\r\f]*+(?:"[^"]*+"|'[^']*+'|[^ \t\n\r\f>"'][^ \t\n\r\f>]*+|(?=>))"""
_REST = re.compile(rf"(?:[ \t\n\r\f/]++|[^ \t\n\r\f/>][^ \t\n\r\f/>=]*+(?:{_VALUE}|(?![ \t\n\r\f]*+=)))*+>")
_ATTRIBUTE = re.compile(rf"([^ \t\n\r\f/>][^ \t\n\r\f/>=]*+)({_VALUE})?+")
_TOLD = re.compile(r"hidden|style|class|id|span|start|open|type|value", re.I)
_NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_RULE = re.compile(r"([^{}]++)\{([^{}]*+)\}")
_COMPOUND = re.compile(r"([A-Za-z][\w-]*|\*)?((?:[.#][\w-]+)*)")
_SPACES = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("attrs", "kids", "tag")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.kids = tag, attrs, []


def attributes(raw: str) -> dict[str, str] | None:
    if not raw or not _TOLD.search(raw):
        return None
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(raw):
        value = value.partition("=")[2].lstrip(" \t\n\r\f")
        out.setdefault(name.lower(), unescape(value[1:-1] if value[:1] in "\"'" and value else value))
    return out


def tree(page: str) -> tuple[Node, list[str]]:
    """The root and the texts of the page's style elements."""
    root, styles = Node("html"), []
    open_, counts = [root], {"html": 1}
    at, size = 0, len(page)

    def text(s: str) -> None:
        if s:
            own = open_[-1]
            if own.tag in ("table", "tbody", "thead", "tfoot", "tr") and not s.strip():
                return
            own.kids.append(unescape(s) if "&" in s else s)

    def push(node: Node) -> None:
        open_[-1].kids.append(node)
        open_.append(node)
        counts[node.tag] = counts.get(node.tag, 0) + 1

    def pop_to(i: int) -> None:
        for node in open_[i:]:
            counts[node.tag] -= 1
        del open_[i:]

    def end(names: frozenset[str], bound: frozenset[str]) -> None:
        """Ends the outermost open element of these names within the bound."""
        if not any(counts.get(x) for x in names):
            return
        found = None
        for i in range(len(open_) - 1, 0, -1):
            tag = open_[i].tag
            if tag in bound:
                break
            if tag in names:
                found = i
        if found:
            pop_to(found)

    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        after = page[lt + 1 : lt + 2]
        if after == "/" and (m := _NAME.match(page, lt + 2)):
            text(page[at:lt])
            rest = _REST.match(page, m.end())
            if not rest:
                break  # the page ends within a tag
            at, tag = rest.end(), m[0].lower()
            if counts.get(tag) and tag not in ("html", "body"):
                bound = _BOUND_END.get(tag, _CELL_BOUND)
                for i in range(len(open_) - 1, 0, -1):
                    if open_[i].tag == tag:
                        pop_to(i)
                        break
                    if open_[i].tag in bound:
                        break
            elif tag == "p":
                open_[-1].kids.append(Node("p"))
            elif tag == "br":
                open_[-1].kids.append(Node("br"))
            continue
        if after in ("!", "?", "/"):
            text(page[at:lt])
            if page.startswith("<!--", lt):
                stop = page.find("-->", lt + 2 if page.startswith("<!-->", lt) else lt + 4)
                at = size if stop < 0 else stop + 3
            else:
                stop = page.find(">", lt)
                at = size if stop < 0 else stop + 1
            continue
        m = _NAME.match(page, lt + 1)
        if not m:
            text(page[at : lt + 1])  # a sign, not a tag
            at = lt + 1
            continue
        text(page[at:lt])
        rest = _REST.match(page, m.end())
        if not rest:
            break  # the page ends within a tag
        at, tag = rest.end(), m[0].lower()
        attrs = attributes(rest[0])
        if tag in ("html", "body"):
            root.attrs = {**(attrs or {}), **(root.attrs or {})} if attrs else root.attrs
            if tag == "body":
                end(_set("head"), frozenset())
            continue
        if tag == "head" and (counts.get("head") or len(open_) > 1):
            continue
        if counts.get("head") and tag not in ("base", "link", "meta", "noscript", "script", "style", "template", "title"):
            end(_set("head"), frozenset())
        if tag in ENDS_P and counts.get("p"):
            end(_set("p"), _BOUND_P)
        if tag in ENDED:
            end(*ENDED[tag])
        if tag in HEADINGS and open_[-1].tag in HEADINGS:
            pop_to(len(open_) - 1)
        if tag in _CELLS and open_[-1].tag in ("table", "tbody", "thead", "tfoot"):
            push(Node("tr"))
        node = Node(tag, attrs)
        if tag in VOID:
            open_[-1].kids.append(node)
        elif tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            body = page[at : close.start() if close else size]
            if tag == "style":
                styles.append(body)
            elif tag in ("textarea", "title"):
                node.kids.append(unescape(body))
            elif tag == "xmp":
                node.kids.append(body)
            open_[-1].kids.append(node)
            gt = page.find(">", close.end()) if close else -1
            at = size if gt < 0 else gt + 1
        else:
            push(node)
    return root, styles


#: A selector's parts from the outside in: whether a part must be the child of the one before, its tag, classes and id.
Selector = list[tuple[bool, str, frozenset[str], str]]


def selector(text: str) -> Selector | None:
    """A selector of tags, classes and ids; none for others."""
    out: Selector = []
    child = False
    for word in re.sub(r"\s*>\s*", " > ", text).split():
        if word == ">":
            if child or not out:
                return None
            child = True
            continue
        m = _COMPOUND.fullmatch(word)
        if not m:
            return None
        names = re.findall(r"[.#][\w-]+", m[2])
        ids = {x[1:] for x in names if x[0] == "#"}
        if len(ids) > 1:
            return None
        out.append((child, "" if m[1] in (None, "*") else m[1].lower(), frozenset(x[1:] for x in names if x[0] == "."), next(iter(ids), "")))
        child = False
    return out if out and not child else None


class Rules:
    """What a page's style rules hide."""

    def __init__(self, styles: list[str], root: Node):
        self.tags, self.classes, self.ids, self.marked = set(), set(), set(), set()
        deep: list[Selector] = []
        for style in styles:
            for selectors, body in _RULE.findall(re.sub(r"/\*.*?\*/", "", style, flags=re.S)):
                if _NOT_SHOWN.search(body):
                    for one in filter(None, map(selector, selectors.split(","))):
                        _, tag, classes, name = one[0]
                        if len(one) > 1 or len(classes) + bool(name) > 1:
                            deep.append(one)
                        elif classes or name:
                            (self.classes if classes else self.ids).add((tag, next(iter(classes), name)))
                        else:
                            self.tags.add(tag)
        if deep:
            self._mark(root, deep)

    def _mark(self, root: Node, deep: list[Selector]) -> None:
        """Marks what the selectors select, in one walk. For each selector two sets of bits go down with a node: the parts
        that end at it, and those that end at it or above it."""
        todo = [(root, (0,) * len(deep), (0,) * len(deep))]
        while todo:
            node, at_parent, above = todo.pop()
            attrs = node.attrs or {}
            own, name = frozenset(attrs.get("class", "").split()), attrs.get("id")
            here, so_far = [], []
            for parts, last, before in zip(deep, at_parent, above, strict=True):
                bits = 0
                for j, (child, tag, classes, wanted) in enumerate(parts):
                    if (not j or (last if child else before) >> (j - 1) & 1) and tag in ("", node.tag) and classes <= own and wanted in ("", name):
                        bits |= 1 << j
                if bits >> (len(parts) - 1) & 1:
                    self.marked.add(id(node))
                here.append(bits)
                so_far.append(before | bits)
            todo += [(x, tuple(here), tuple(so_far)) for x in node.kids if not isinstance(x, str)]

    def hide(self, node: Node) -> bool:
        tag, attrs = node.tag, node.attrs
        if tag in UNSEEN or tag in self.tags or "" in self.tags or id(node) in self.marked:
            return True
        if not attrs:
            return tag == "dialog"
        if "hidden" in attrs or (tag == "dialog" and "open" not in attrs) or ("style" in attrs and _NOT_SHOWN.search(attrs["style"])):
            return True
        if self.classes and any((t, k) in self.classes for k in attrs.get("class", "").split() for t in ("", tag)):
            return True
        return bool(self.ids) and any((t, attrs.get("id")) in self.ids for t in ("", tag))


class Page:
    """Lines being laid out."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now: list[str] = []
        self.breaks = 0  # new lines that are due before the next text
        self.space = False
        self.indent: list[str] = []  # of each open list item, blanks once its mark is out
        self.mark = False

    def _line(self) -> None:
        """Begins the line that text goes to."""
        if self.breaks and (self.lines or self.now):
            self.lines.append("".join(self.now).rstrip())
            self.lines += [""] * (self.breaks - 1)
            self.now = []
        self.breaks = 0
        if not self.now and self.indent:
            self.now.append("".join(self.indent))
            self.indent = [" " * len(x) for x in self.indent]
            self.space = False

    def text(self, s: str) -> None:
        if not s:
            return
        flat = _SPACES.sub(" ", s)
        if flat == " ":
            self.space = self.space or (bool(self.now) and not self.breaks)
            return
        if flat[0] == " ":
            self.space = True
            flat = flat[1:]
        fresh = bool(self.breaks) or not self.now
        self._line()
        if self.space and not fresh:
            self.now.append(" ")
        self.space = flat[-1] == " "
        self.now.append(flat[:-1] if self.space else flat)

    def exact(self, s: str) -> None:
        for i, line in enumerate(s.replace("\r\n", "\n").split("\n")):
            if i:
                self.breaks += 1
            if line:
                self._line()
                self.now.append(line)
        self.space = False

    def block(self, n: int) -> None:
        self.breaks = max(self.breaks, n)
        self.space = False

    def break_(self) -> None:
        if self.now or self.breaks:
            self.breaks += 1
        self.space = False

    def done(self) -> str:
        if self.now:
            self.lines.append("".join(self.now).rstrip())
            self.now = []
        lines = self.lines
        while lines and not lines[-1].strip():
            lines.pop()
        return "\n".join(lines)


def render(kids: list, rules: Rules, depth: int = 0) -> str:
    """The visible text of some nodes."""
    page = Page()
    lists: list[list] = []  # of each open list: its next number or None
    pre = 0
    todo: list[tuple] = [(x, False) for x in reversed(kids)]
    while todo:
        node, closing = todo.pop()
        if isinstance(node, str):
            (page.exact if pre else page.text)(node)
            continue
        tag = node.tag
        if closing:
            if tag in ("ol", "ul", "menu"):
                lists.pop()
            elif tag == "li":
                if page.indent and page.indent[-1].strip():  # nothing was in it
                    page._line()
                page.indent.pop()
            elif tag in ("pre", "textarea", "xmp"):
                pre -= 1
            if tag in BLOCKS:
                page.block(1 if tag not in SPACED or (lists and tag in ("ol", "ul", "menu")) else 2)
            elif tag in ("td", "th"):
                page.text(" ")
            continue
        if rules.hide(node):
            continue
        if tag == "br":
            page.break_()
            continue
        if tag in BLOCKS:
            page.block(1 if tag not in SPACED or (lists and tag in ("ol", "ul", "menu")) else 2)
        if tag == "table" and depth < NESTED:
            captions = [x for x in node.kids if not isinstance(x, str) and x.tag == "caption"]
            above, grid = table(node, rules, depth + 1)
            for part in [*(render(c.kids, rules, depth + 1) for c in captions if not rules.hide(c)), above, grid]:
                if part:
                    page.block(1)
                    page.exact(part)
            page.block(2)
            continue
        kids = node.kids
        if tag == "details" and not (node.attrs and "open" in node.attrs):
            kids = [x for x in kids if not isinstance(x, str) and x.tag == "summary"][:1]
        elif tag in ("ol", "ul", "menu"):
            start = (node.attrs or {}).get("start", "1") if tag == "ol" else ""
            lists.append([(int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1) if tag == "ol" else None])
        elif tag == "li":
            number = lists[-1][0] if lists else None
            if number is not None:
                value = (node.attrs or {}).get("value", "")
                number = int(value) if re.fullmatch(r"-?[0-9]{1,9}", value) else number
                lists[-1][0] = number + 1
            page.indent.append("- " if number is None else f"{number}. ")
        elif tag in ("pre", "textarea", "xmp"):
            pre += 1
            if kids and isinstance(kids[0], str) and kids[0].startswith("\n"):
                kids = [kids[0][1:], *kids[1:]]
        todo.append((node, True))
        todo += [(x, False) for x in reversed(kids)]
    return page.done()


def _span(cell: Node, name: str, most: int) -> int:
    """A span's size; 0 for one that goes on to the section's end."""
    value = (cell.attrs or {}).get(name, "1").strip()
    return min(most, int(value)) if re.fullmatch("[0-9]{1,9}", value) else 1


def table(node: Node, rules: Rules, depth: int) -> tuple[str, str]:
    """The text that stands in a table outside its cells, and its cells in padded columns."""
    rows: list[list[tuple[int, list[str], int]]] = []  # of each row its cells' first columns, lines and numbers of columns
    loose: list = []
    held: dict[int, int] = {}  # columns that cells above span into, and how many rows yet
    todo: list = [*reversed(node.kids)]
    while todo:
        x = todo.pop()
        if x is None:
            held = {}
        elif isinstance(x, str) or x.tag not in ("tr", "tbody", "thead", "tfoot", "caption", "colgroup", "col"):
            loose.append(x)
        elif x.tag in _SECTIONS and not rules.hide(x):
            held = {}
            todo += [None, *reversed(x.kids)]
        elif x.tag == "tr" and not rules.hide(x):
            row, at, new = [], 0, {}
            for cell in x.kids:
                if isinstance(cell, str) or cell.tag not in _CELLS:
                    loose.append(cell)
                elif not rules.hide(cell):
                    while at in held:
                        at += 1
                    columns, down = max(1, _span(cell, "colspan", MOST_COLUMNS)), _span(cell, "rowspan", 65_534) or 65_534
                    row.append((at, render(cell.kids, rules, depth).split("\n"), columns))
                    if down > 1:
                        new.update(dict.fromkeys(range(at, min(at + columns, MOST_COLUMNS)), down))
                    at += columns
            held = {c: n - 1 for c, n in [*held.items(), *new.items()] if n > 1}
            if any(any(lines) for _, lines, _ in row):
                rows.append(row)
    widths: dict[int, int] = {}
    for row in rows:
        for at, lines, columns in row:
            if columns == 1:
                widths[at] = max(widths.get(at, 0), *map(len, lines))
    out = []
    for row in rows:
        height = max(len(lines) for _, lines, _ in row)
        for i in range(height):
            line, upto = [], 0
            for at, lines, columns in row:
                line += [" " * widths.get(c, 0) for c in range(upto, at)]  # what cells above span
                room = sum(widths.get(c, 0) for c in range(at, at + columns)) + 2 * (columns - 1)
                line.append((lines[i] if i < len(lines) else "").ljust(room))
                upto = at + columns
            out.append("  ".join(line).rstrip())
    return render(loose, rules, depth) if loose else "", "\n".join(out)


def extract(page: str | None) -> str:
    """The visible text of a page."""
    if not page:
        return ""
    root, styles = tree(page)
    rules = Rules(styles, root)
    return "" if rules.hide(root) else render(root.kids, rules)


def texts(pages: DataFrame) -> DataFrame:
    """page_id, text of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in C.chunks(batches, "html"):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([extract(x) for x in part.column(1).to_pylist()], pa.string())], ["page_id", "text"])

    return pages.select(F.col("page_id").cast("long"), "html").mapInArrow(run, "page_id long, text string")
