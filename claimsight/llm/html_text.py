"""Visible text of web pages (operator 3): a small tree builder and a layout-aware renderer.

``parse`` builds a tree from any markup: implied end tags (paragraphs, list items, table parts,
options, headings), implied rows, void elements, raw text of scripts and styles, comments, end tags
without a start.  Inside ``svg`` and ``math`` the rules of foreign content hold: ``/>`` closes, CDATA is
text, and a start tag of HTML ends them; ``svg`` shows the text of ``text`` and ``foreignObject``
only (not what ``use`` repeats from ``defs``), ``math`` all but its annotations.  What stands in a table but in none of its cells
moves before the table, as in browsers.  ``render`` walks the tree and emits all visible text: elements that browsers never
show, ``hidden`` attributes, ``display:none`` styles, closed dialogs and the bodies of closed details are left out; so is what is
``visibility:hidden``, but not what is ``visible`` again inside of it.  White
space collapses except in ``pre`` and ``textarea``; blocks stand on their own lines, paragraphs and
headings between blank lines; list items get ``- `` or their number (``reversed`` lists count down), indented by depth; table cells
are padded so that columns line up, rows and columns that a cell spans included.  A long cell that others follow is broken into lines
between words; a single word longer than that still pushes the cells behind it.  Both are loops with a stack of their own, so deep nesting is
no problem, and both are linear in the page.

Null html gives null text, empty html empty text.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight.llm.common import column, slices

# Element names of HTML by how a browser lays them out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head title meta link base script style template noscript noembed noframes iframe object audio video "
                   "canvas datalist area param source track".split())
RAW = frozenset("script style xmp noembed noframes iframe".split())
PLAIN = frozenset(("textarea", "title"))  # text with entities, no tags
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr menu".split())
BLOCK = SPACED | frozenset("address article aside body caption center dd details dialog dir div dt fieldset figcaption footer "
                           "form header hgroup html legend li main nav optgroup option search section summary tbody td tfoot "
                           "th thead tr".split())
LISTS = frozenset(("ul", "ol", "menu", "dir"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Starting one of these ends an open paragraph.
ENDS_P = BLOCK - frozenset("html body caption tbody td tfoot th thead tr option optgroup legend".split())
#: What a start tag closes, and the elements it does not look beyond.
CLOSES = {
    "li": (("li",), LISTS), "dt": (("dt", "dd"), frozenset(("dl",))), "dd": (("dt", "dd"), frozenset(("dl",))),
    "option": (("option",), frozenset(("select", "datalist"))), "optgroup": (("option", "optgroup"), frozenset(("select",))),
    "td": (("td", "th"), frozenset(("table", "tr"))), "th": (("td", "th"), frozenset(("table", "tr"))),
    "tr": (("tr", "caption", "colgroup"), frozenset(("table",))),
    "tbody": (("tbody", "thead", "tfoot", "caption", "colgroup"), frozenset(("table",))),
    "thead": (("tbody", "thead", "tfoot", "caption", "colgroup"), frozenset(("table",))),
    "tfoot": (("tbody", "thead", "tfoot", "caption", "colgroup"), frozenset(("table",))),
}
#: An end tag looks no further up than these, unless it names one of them.
BARRIERS = frozenset(("table", "td", "th", "caption"))
TABLE_PARTS = frozenset(("tr", "tbody", "thead", "tfoot"))
#: Where only parts of a table may stand, these parts, and what may stand there besides without moving before the table.
TABLE_CONTEXT = TABLE_PARTS | {"table"}
STRUCTURE = TABLE_PARTS | {"caption", "colgroup", "col", "td", "th"}
TABLE_GUESTS = STRUCTURE | {"script", "style", "template"}
#: What svg and math hold but don't show, where HTML goes on inside them, and the start tags of HTML that end them.
FOREIGN = frozenset(("svg", "math"))
UNSEEN_FOREIGN = frozenset("annotation annotation-xml defs desc metadata symbol clippath mask pattern marker".split())
INTEGRATION = frozenset("foreignobject desc title annotation-xml mi mn mo ms mtext".split())
APART = frozenset("mfrac mroot mtable mtr".split())  # a space between their children
BREAKOUT = HEADINGS | frozenset("b big blockquote body br center code dd div dl dt em embed head hr i img li listing menu meta nobr ol p "
                                "pre ruby s small span strong strike sub sup table tt u ul var".split())
NO_BARRIER, TABLE_ONLY = frozenset(), frozenset(("table",))

#: Cells with cells behind them are broken into lines of at most this width.
CELL_WIDTH = 80
#: Cells that begin after so many columns span no rows.
SPANNED_COLUMNS = 1000

_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))*+)(>?)""")
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")
_UNSHOWN = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
_UNSHOWN_FOREIGN = re.compile(r"""\b(?:display\s*=\s*["']?\s*none|visibility\s*=\s*["']?\s*(?:hidden|collapse))""", re.I)
_QUOTED = re.compile(r""""[^"]*"|'[^']*'""")
_BARE_LAST = re.compile(r"""=\s*[^\s"'][^\s]*\Z""")
_COMMENT_END = re.compile(r"--!?>")
_BLANK = re.compile(r"[ \t\n\r\f\v]+")
_HINT = re.compile(r"hidden|style|start|value|colspan|rowspan|reversed|open|type|alt", re.I)


class Element:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]) -> None:
        self.tag, self.attributes, self.children = tag, attributes, []

    def visible(self) -> bool:
        a = self.attributes
        if self.tag in UNSEEN or "hidden" in a and a["hidden"].lower() != "until-found" or self.tag == "dialog" and "open" not in a:
            return False
        return not (a and "style" in a and _UNSHOWN.search(a["style"]) or self.tag == "input" and a.get("type", "").lower() == "hidden")

    def shown(self, inherited: bool) -> bool:
        """The computed visibility: the last declaration of the own style, else the parent's."""
        own = _VISIBILITY.findall(self.attributes["style"]) if "style" in self.attributes else []
        return own[-1].lower() == "visible" if own else inherited

    def number(self, name: str, default: int, least: int) -> int:
        value = self.attributes.get(name, "")
        return max(least, int(value)) if re.fullmatch(r"-?\d{1,9}", value) else default


def parse(source: str) -> Element:
    """The page as a tree below one root element."""
    root = Element("#root", {})
    stack, at, n = [root], 0, len(source)
    # Open elements by tag, in all and below the nearest barrier: a search up the stack starts only if it can succeed.
    everywhere: Counter[str] = Counter()
    scopes: list[Counter[str]] = [Counter()]
    # Of each open element, what its texts are: of HTML (""), of "math", of svg outside ("svg", not shown) or inside a "text".
    kinds = [""]

    def add(node: Element | str) -> None:
        """Append to the open element; in a table, but in none of its cells, insert before the table, its parent's last child so far."""
        if stack[-1].tag in TABLE_CONTEXT and not kinds[-1] and everywhere["table"] and (
                node.strip(" \t\n\r\f") if isinstance(node, str) else node.tag not in TABLE_GUESTS):
            at = len(stack) - 1
            while stack[at].tag != "table":
                at -= 1
            stack[at - 1].children.insert(-1, node)
        else:
            stack[-1].children.append(node)

    def push(element: Element) -> None:
        kind = kinds[-1]
        if element.tag in FOREIGN:
            kind = element.tag
        elif kind and element.tag in INTEGRATION:
            kind = ""
        elif kind == "svg" and element.tag == "text":
            kind = "text"
            stack[-1].children.append(" ")
        add(element)
        stack.append(element)
        kinds.append(kind)
        everywhere[element.tag] += 1
        scopes[-1][element.tag] += 1
        if element.tag in BARRIERS:
            scopes.append(Counter())

    def pop() -> None:
        tag = stack.pop().tag
        if kinds.pop() == "text" and kinds[-1] == "svg":
            stack[-1].children.append(" ")
        if tag in BARRIERS:
            scopes.pop()
        scopes[-1][tag] -= 1
        everywhere[tag] -= 1

    def close(tags, barriers) -> None:
        near = scopes[-1] if barriers and barriers >= BARRIERS else everywhere
        if not any(near[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                while len(stack) > i:
                    pop()
                return
            if stack[i].tag in barriers:
                return

    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            if kinds[-1] != "svg":
                add(html.unescape(source[at:lt]))
            at = lt
            continue
        if source.startswith("<!--", at):
            if source.startswith((">", "->"), at + 4):  # closed at once
                at = source.index(">", at) + 1
                continue
            end = _COMMENT_END.search(source, at + 4)
            at = end.end() if end else n
            continue
        if kinds[-1] and source.startswith("<![CDATA[", at):
            end = source.find("]]>", at + 9)
            end = n if end < 0 else end
            if kinds[-1] != "svg":
                stack[-1].children.append(source[at + 9:end])
            at = end + 3
            continue
        if source.startswith(("<!", "<?"), at):
            end = source.find(">", at)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(source, at)
        if m is None:
            if kinds[-1] != "svg":
                add("<")
            at += 1
            continue
        tag, at = m[1].lower(), m.end()
        if not m[3]:  # the page ends inside a tag
            break
        if source[m.start() + 1] == "/":
            if tag == "br":
                add(Element("br", {}))
            elif tag in HEADINGS:
                close(HEADINGS, BARRIERS)
            elif tag not in ("body", "html"):  # what follows still belongs to the page
                close((tag,), NO_BARRIER if tag in BARRIERS else TABLE_ONLY if tag in TABLE_PARTS else BARRIERS)
            continue
        attributes = {}
        if m[2] and _HINT.search(m[2]):
            for a in _ATTRIBUTE.finditer(m[2]):
                attributes.setdefault(a[1].lower(), html.unescape(a[2] or a[3] or a[4] or ""))
        if kinds[-1] or tag in FOREIGN:
            while kinds[-1] and tag in BREAKOUT:
                pop()
            if kinds[-1] and (tag in UNSEEN_FOREIGN or _UNSHOWN_FOREIGN.search(m[2])):
                attributes["hidden"] = ""
            if kinds[-1] == "math" and stack[-1].tag in APART and stack[-1].children:
                stack[-1].children.append(" ")
            if m[2].endswith("/") and (kinds[-1] or tag in FOREIGN) and not _BARE_LAST.search(_QUOTED.sub('""', m[2])):
                continue  # an empty element
        if tag == "form" and not kinds[-1] and stack[-1].tag in TABLE_CONTEXT and everywhere["table"]:
            continue  # holds nothing here
        if tag in STRUCTURE and everywhere["table"]:
            at_table = len(stack) - 1
            while stack[at_table].tag not in BARRIERS and stack[at_table].tag not in TABLE_CONTEXT:
                at_table -= 1
            if stack[at_table].tag in TABLE_CONTEXT:  # what moved before the table ends
                while len(stack) > at_table + 1:
                    pop()
        if tag in ENDS_P:
            close(("p",), BARRIERS)
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in HEADINGS and stack[-1].tag in HEADINGS:
            pop()
        if tag == "body":
            close(("head",), NO_BARRIER)
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            push(Element("tr", {}))
        element = Element(tag, attributes)
        if tag not in VOID and tag not in RAW and tag not in PLAIN:
            push(element)
            continue
        add(element)
        if tag in RAW or tag in PLAIN:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
            inside = source[at:end.start() if end else n]
            if tag not in RAW:
                element.children.append(html.unescape(inside))
            elif tag == "xmp":
                element.children.append(inside)
            close_at = source.find(">", end.start()) if end else -1
            at = n if close_at < 0 else close_at + 1
    return root


class _Lines:
    """Output lines of one flow of text (the page, or one table cell)."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap = 0  # blank lines owed before the next text
        self.space = False  # a space owed before the next word
        self.mark = ""  # marker of a list item that has no text yet
        self.indent = 0

    def text(self, s: str) -> None:
        words = _BLANK.sub(" ", s)
        if words in ("", " "):
            self.space = self.space or bool(words and self.parts)
            return
        if self.space or words[0] == " " and self.parts:
            self.parts.append(" ")
        self.parts.append(words.strip(" "))
        self.space = words[-1] == " "

    def verbatim(self, s: str) -> None:
        for i, line in enumerate(s.replace("\r\n", "\n").split("\n")):
            if i:
                self.end(force=True)
            if line:
                self.parts.append(line)

    def end(self, blank: int = 0, force: bool = False) -> None:
        """Finish the line; ``blank`` lines should follow, and an empty line is kept only by ``force``."""
        if self.parts or self.mark and force:
            if self.lines and self.gap:
                self.lines += [""] * self.gap
            pad = "  " * self.indent
            if self.mark:
                pad, self.mark = pad[:-2] + self.mark, ""
            self.lines.append((pad + "".join(self.parts)).rstrip())
            self.gap = 0
        elif force and self.lines and not self.gap:
            self.lines.append("")
        self.parts, self.space = [], False
        self.gap = max(self.gap, blank)


def _wrapped(text: str) -> list[str]:
    """Lines of a cell, long ones broken between words."""
    out = []
    for line in text.split("\n"):
        while len(line) > CELL_WIDTH:
            at = line.rfind(" ", 1, CELL_WIDTH + 1)
            at = line.find(" ", CELL_WIDTH) if at < 0 else at
            if at < 0:
                break
            out.append(line[:at].rstrip())
            line = line[at + 1:].lstrip()
        out.append(line)
    return out


def _table(rows: list[list[tuple[str, int, int]]], out: _Lines) -> None:
    """Rows of (cell text, columns, rows spanned), padded into columns; a cell of several lines takes several lines."""
    taken: dict[int, int] = {}  # columns that cells of rows above cover: the last row that they do
    grid: list[list[tuple[int, int, list[str]]]] = []  # first column, columns, lines of each cell
    for r, row in enumerate(rows):
        line, at = [], 0
        reach = max((c for c, last in taken.items() if last >= r), default=-1)
        for i, (text, span, down) in enumerate(row):
            while taken.get(at, -1) >= r:
                at += 1
            line.append((at, span, _wrapped(text) if i < len(row) - 1 or reach > at else text.split("\n")))
            if down > 1:
                taken |= dict.fromkeys(range(at, min(at + span, SPANNED_COLUMNS)), r + down - 1)
            at += span
        grid.append(line)
    widths: dict[int, int] = {}
    size = lambda lines: min(CELL_WIDTH, max(map(len, lines)))
    for line in grid:
        for at, span, lines in line:
            if span == 1:
                widths[at] = max(widths.get(at, 0), size(lines))
    columns = sorted({at for line in grid for at, _, _ in line})
    for line in grid:  # a cell over several columns that is wider than they are widens the last of those that have cells
        for at, span, lines in line[:-1]:
            if span > 1:
                mine = [c for c in columns[bisect_left(columns, at):bisect_left(columns, at + span)]]
                lack = size(lines) - sum(widths.get(c, 0) for c in mine) - 3 * (len(mine) - 1)
                if lack > 0:
                    widths[mine[-1]] = widths.get(mine[-1], 0) + lack
    starts, x = {}, 0
    for c in columns:
        starts[c] = x
        x += widths.get(c, 0) + 3
    for line in grid:
        for k in range(max((len(lines) for _, _, lines in line), default=0)):
            joined = ""
            for i, (at, _, lines) in enumerate(line):
                if at > columns[0]:
                    joined = joined.ljust(starts[at] - 3) + " | "
                joined += lines[k] if k < len(lines) else ""
            if joined.strip(" |"):
                out.parts = [joined.rstrip(" ")]
                out.end()


def render(root: Element) -> str:
    """All visible text below ``root``."""
    out = _Lines()
    outer: list[tuple[_Lines, list]] = []  # flows that wait for a table to end, with that table's rows
    rows: list[list[tuple[str, int, int]]] = []
    numbers: list[tuple[int, int] | None] = []  # next number and step of the open lists; None: bullets
    pre, shown = 0, True
    todo: list = [root]  # elements to enter, texts, and functions to call on leaving
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            if shown:
                out.verbatim(x) if pre else out.text(x)
            continue
        if isinstance(x, Element):
            if not x.visible():
                continue
            tag = x.tag
            if tag == "br":
                out.end(force=True)
                continue
            before, shown = shown, x.shown(shown)
            if tag in ("img", "input"):
                told = x.attributes.get("alt" if tag == "img" else "value", "")
                if told and shown:
                    out.text(f" {told} ")
                shown = before
                continue
            blank = 1 if tag in SPACED and not (tag in LISTS and numbers) and not rows and not outer else 0
            if tag in BLOCK:
                if not (out.mark and not out.parts):
                    out.end(blank)
            if tag == "hr":
                out.parts = ["---"] if shown else []
                out.end(blank)
            elif tag in LISTS:
                items = sum(isinstance(c, Element) and c.tag == "li" for c in x.children) if "reversed" in x.attributes else 1
                step = -1 if "reversed" in x.attributes else 1
                numbers.append((x.number("start", items, -10 ** 9), step) if tag == "ol" else None)
                out.indent += 1
            elif tag == "li" and numbers:
                mark = "- "
                if numbers[-1] is not None:
                    number, step = x.number("value", numbers[-1][0], -10 ** 9), numbers[-1][1]
                    mark, numbers[-1] = f"{number}. ", (number + step, step)
                if shown:
                    out.mark = mark
            elif tag in ("dd", "blockquote"):
                out.indent += 1
            elif tag in ("pre", "textarea", "xmp"):
                pre += 1
                if x.children and isinstance(x.children[0], str) and x.children[0].startswith("\n"):
                    x.children[0] = x.children[0][1:]
            elif tag == "table":
                outer.append((out, rows))
                rows = []
            elif tag == "tr" and outer:
                rows.append([])
            elif tag in ("td", "th") and outer:
                if not rows:
                    rows.append([])
                out = _Lines()
            children = x.children
            if tag == "details" and "open" not in x.attributes:  # its first summary only
                children = [c for c in children if isinstance(c, Element) and c.tag == "summary"][:1]
            todo.append((x, blank, before))
            todo += reversed(children)
            continue
        x, blank, shown = x  # leaving
        tag = x.tag
        if tag in ("td", "th") and outer:
            out.end()
            down = x.number("rowspan", 1, 0)
            # The most columns and rows that a cell may span in HTML; 0 rows: all that follow.
            rows[-1].append(("\n".join(out.lines), min(x.number("colspan", 1, 1), 1000), min(down, 65534) or 65534))
            out = outer[-1][0]
            continue
        if tag == "table":
            done, (out, rows) = rows, outer.pop()
            out.end()
            _table([r for r in done if r], out)
            out.end(blank)
        elif tag in BLOCK:
            out.end(blank)
        if tag in LISTS:
            numbers.pop()
            out.indent -= 1
        elif tag in ("dd", "blockquote"):
            out.indent -= 1
        elif tag in ("pre", "textarea", "xmp"):
            pre -= 1
        if tag == "li":
            out.mark = ""
    out.end()
    return "\n".join(out.lines)


def page_text(source: str | None) -> str | None:
    return None if source is None else render(parse(source))


def extract(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """Columns ``keep`` of ``pages`` plus ``text``: the visible text of each whole page. Row-wise, no shuffle."""
    schema = T.StructType([pages.schema[c] for c in keep] + [T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__html", 1 << 20):
            texts = [page_text(x.as_py()) for x in column(batch, "__html")]
            yield pa.RecordBatch.from_arrays([column(batch, c) for c in keep] + [pa.array(texts, pa.string())], names=schema.names)

    return pages.select(*keep, F.col(html).alias("__html")).mapInArrow(run, schema)
