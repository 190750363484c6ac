"""5. HTML extraction: layout-aware rendering of all visible text.

A tree builder reads a page as browsers do where it matters for text: tags
that markup leaves out are implied (a paragraph ends where a block starts, an
item at the next item, a cell at the next cell, a row, a section; rows and
cells outside a table open one), comments and declarations are dropped, and
the content of raw-text elements is no markup. Elements that are not shown
(``head``, ``script``, ``template``, a ``hidden`` attribute, ``display:none``
in its style, what a closed ``details`` holds beside its summary) are left out; ``visibility`` is inherited, so a visible child of a hidden
element is shown. Formulae and the text drawn in figures (``math``, ``svg``) are
text. The renderer then lays the tree out as
text: white space collapses except in ``pre``, blocks stand on lines of their
own with an empty line where they have margins, list items are marked and
indented, and the cells of a table are padded to columns, cells over several rows or columns keeping their places
(in the first ``COLUMNS`` columns). Style sheets are not read.

Cases: a null or empty page gives an empty text; text without markup is itself,
with white space collapsed; unclosed and stray tags are closed or ignored;
markup may nest to any depth, but is indented as if at most ``DEPTH`` deep; a
quote is one only where an attribute's value starts; a tag that nothing ends is
dropped with what follows; numbers in references and spans may have any length; repeated rows and null ids give a row each.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Generator, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEPTH = 120
#: Columns of a table that spans are followed in, and rows that a cell may span (as browsers have it).
COLUMNS, ROWS = 100, 65534
TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<attrs>(?>[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+)*+)>|<[!?/][^>]*+>?|(?P<text>[^<]++|<)""",
    re.S,
)
ATTR = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
#: An unquoted value may end with a slash, which closes nothing.
SELF_CLOSED = re.compile(r"""(?:^|[\s"']|[\s/][^\s/=]+)/\s*\Z""")
# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
UNSEEN = frozenset("head script style title template noscript iframe noembed noframes datalist audio video canvas object annotation annotation-xml".split())
#: What a figure holds but does not draw where it stands.
UNDRAWN = frozenset("defs symbol desc metadata clippath mask marker pattern lineargradient radialgradient filter".split())
MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset form hr".split())
BLOCK = MARGIN | frozenset("html body div section article aside nav header footer main address li dt dd tr thead tbody tfoot caption figcaption details summary legend center option optgroup menu dir search hgroup".split())
CLOSES_P = BLOCK - frozenset("html body tr thead tbody tfoot caption option optgroup legend summary li dt dd".split()) | frozenset(["li", "dt", "dd", "summary"])
SECTIONS = frozenset(["thead", "tbody", "tfoot"])
#: What an opening tag closes first, up to (not including) one of the bounds.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist", "optgroup"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["td", "th", "tr", "caption"]), frozenset(["table", "thead", "tbody", "tfoot"])),
    **{s: (frozenset(["td", "th", "tr", "caption"]) | SECTIONS, frozenset(["table"])) for s in SECTIONS},
    "body": (frozenset(["head"]), frozenset()),
}
LISTS = frozenset(["ul", "ol", "menu", "dir"])
FOREIGN, INTEGRATION = frozenset(["svg", "math"]), frozenset(["foreignobject", "annotation-xml"])
SCOPE = frozenset(["table", "td", "th", "caption", "html", "button"])
HIDING = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"(?:^|[;\s])visibility\s*:\s*(visible|initial|hidden|collapse)", re.I)


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict | None = None):
        self.tag, self.attrs, self.kids = tag, attrs or {}, []


def _unescaped(text: str) -> str:
    """Character references replaced; a number of any length is no error."""
    if "&" not in text:
        return text
    if "&#" in text:
        text = re.sub(r"&#[0-9]{8,}+", "&#1114112", re.sub(r"&#0++(?=[0-9])", "&#", text))
    return html.unescape(text)


def _span(text: str, most: int) -> int:
    """The number of rows or columns a cell takes: ``most`` at most, 1 where none is given."""
    digits = re.match(r"\s*\+?0*+([0-9]{0,6}+)", text)[1]
    return min(int(digits), most) if digits else 0 if re.match(r"\s*\+?0", text) else 1


def _attributes(text: str) -> dict:
    out: dict[str, str] = {}
    for k, v in ATTR.findall(text):
        out.setdefault(k.lower(), _unescaped(v[1:-1] if len(v) > 1 and v[0] in "\"'" and v[-1] == v[0] else v))
    return out


TEMPLATE = re.compile(r"<(/?)template(?=[\s/>])[^>]*>?", re.I)


def _template_end(page: str, at: int) -> re.Match | None:
    """The tag that ends a template, past those inside it."""
    depth = 1
    for m in TEMPLATE.finditer(page, at):
        depth += -1 if m[1] else 1
        if not depth:
            return m
    return None


def build(page: str) -> Node:
    """The tree of a page."""
    root = Node("#root")
    stack = [root]
    places: dict[str, list[int]] = defaultdict(list)  # of each tag's open elements in the stack
    closed: list[Node] = []
    at = 0

    def push(node: Node) -> None:
        stack[-1].kids.append(node)
        places[node.tag].append(len(stack))
        stack.append(node)

    def innermost(tags: frozenset) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=0)

    def close(tags: frozenset, bounds: frozenset) -> None:
        """End the innermost open element of ``tags``, and what is open inside it, unless a bound comes first."""
        i = innermost(tags)
        if i and i >= innermost(bounds):
            for n in stack[i:]:
                places[n.tag].pop()
            del stack[i:]

    while m := TOKEN.match(page, at):
        at = m.end()
        if (text := m["text"]) is not None:
            if text == "<" and page[at : at + 1].isascii() and page[at : at + 1].isalpha():
                break  # a tag that nothing ends: the end of the page, as browsers have it
            stack[-1].kids.append(_unescaped(text))
            continue
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if tag == "br":
                stack[-1].kids.append(Node("br"))
            elif places[tag]:
                bounds = frozenset() if tag in ("table", "body", "html") else frozenset(["table"]) if tag in ("td", "th", "tr", "caption") or tag in SECTIONS else frozenset(["td", "th", "table"])
                close(frozenset([tag]), bounds - {tag})
            continue
        foreign = innermost(FOREIGN) > innermost(INTEGRATION)
        if foreign and SELF_CLOSED.search(m["attrs"]):
            stack[-1].kids.append(Node(tag, _attributes(m["attrs"])))
            continue
        if tag in CLOSES_P:
            close(frozenset(["p"]), SCOPE)
        if tag in IMPLIED:
            gone, bounds = IMPLIED[tag]
            # A row closes the cell and then the row before it.
            for _ in range(3 if tag in ("tr", *SECTIONS) else 1):
                close(gone, bounds)
        if tag in ("td", "th") and stack[-1].tag != "tr":
            if not places["table"]:
                push(Node("table"))
            push(Node("tr"))
        elif tag == "tr" and not places["table"]:
            push(Node("table"))
        elif tag == "li" and not innermost(LISTS):
            push(Node("ul"))
        node = Node(tag, _attributes(m["attrs"]) if m["attrs"].strip(" /\n\t\r\f") else None)
        if tag in VOID:
            stack[-1].kids.append(node)
        elif tag in RAW:
            end = _template_end(page, at) if tag == "template" else re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            stop = end.start() if end else len(page)
            node.kids.append(_unescaped(page[at:stop]) if tag in ("title", "textarea") else page[at:stop])
            stack[-1].kids.append(node)
            at = end.end() if end else len(page)
        else:
            push(node)
            if tag == "details" and "open" not in node.attrs:
                closed.append(node)
    for node in closed:  # only its summary is shown
        node.kids = [k for k in node.kids if isinstance(k, Node) and k.tag == "summary"][:1]
    return root


def hidden(node: Node) -> bool:
    a = node.attrs
    return node.tag in UNSEEN or "hidden" in a or (node.tag == "input") or ("style" in a and HIDING.search(a["style"]) is not None)


def visible(node: Node, inherited: bool) -> bool:
    """Whether the element's own text is shown, by its ``visibility`` or else its parent's."""
    found = VISIBILITY.findall(node.attrs["style"]) if "style" in node.attrs else node.attrs["visibility"].split() if "visibility" in node.attrs else []
    own = found[-1].lower() if found else ""
    return True if own in ("visible", "initial") else False if own in ("hidden", "collapse") else inherited


def finished(call: Generator):
    """The result of a generator that yields the generators it waits for: nesting takes no depth of calls."""
    calls, value = [call], None
    while calls:
        try:
            calls.append(calls[-1].send(value))
            value = None
        except StopIteration as e:
            calls.pop()
            value = e.value
    return value


class Lines:
    """Text laid out so far: ended lines, the open one, and the space wanted before what comes next."""

    def __init__(self):
        self.lines: list[str] = []
        self.open = ""
        self.gap = 0  # 1: a new line, 2: an empty line before it
        self.indent = ""
        self.mark = ""
        self.kept = False  # the open line's leading space is text

    def text(self, s: str) -> None:
        words = s.split()
        if not words:
            if s and self.open and not self.open.endswith(" "):
                self.open += " "
            return
        self._start()
        if s[0].isspace() and self.open and not self.open.endswith((" ", "\t")):
            self.open += " "
        self.open += " ".join(words) + (" " if s[-1].isspace() else "")

    def raw(self, s: str) -> None:
        first, *rest = s.split("\n")
        self._start()
        self.open, self.kept = self.open + first, True
        for x in rest:
            self.line(True)
            self.open += x

    def _start(self) -> None:
        if self.gap == 2 and self.lines and self.lines[-1]:
            self.lines.append("")
        self.gap = 0

    def line(self, keep: bool = False) -> None:
        """End the open line, if it has any text (or ``keep`` says so)."""
        s = self.open if keep else self.open.rstrip() if self.kept else self.open.strip()
        if s or keep or self.mark:
            if not s and self.mark:
                return
            self.lines.append((self.indent[: len(self.indent) - len(self.mark)] + self.mark + s).rstrip())
            self.mark = ""
        self.open, self.kept = "", keep and self.kept

    def block(self, margin: int) -> None:
        self.line()
        self.gap = max(self.gap, margin)


def render(node: Node, out: Lines, pre: bool = False, within: list | None = None, shown: bool = True, drawn: bool = True) -> Generator:
    """Lay out an element; ``within`` is the list around it, ``shown`` the
    visibility it inherits, ``drawn`` whether text is drawn where it stands."""
    if hidden(node):
        return
    tag = node.tag
    shown = visible(node, shown)
    if tag == "svg":
        drawn = False
    elif tag == "foreignobject" or tag == "text" and not drawn:
        drawn = True
        out.block(1)
    elif not drawn and tag in UNDRAWN:
        return
    if tag == "br":
        out._start()
        out.line(True)
        return
    if tag == "table":
        yield table(node, out, shown, drawn)
        return
    if tag == "hr":
        out.block(2)
        if shown:
            out.text("---")
            out.block(2)
        return
    margin = (1 if tag in ("ul", "ol", "menu") and within else 2) if tag in MARGIN else 1 if tag in BLOCK else 0
    if margin:
        out.block(margin)
    held = out.indent
    deeper = len(held) < 2 * DEPTH
    if tag in LISTS:
        start = node.attrs.get("start", "1")
        within = [tag, int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1]
    elif tag == "li":
        kind = within or ["ul", 1]
        mark = f"{kind[1]}. " if kind[0] == "ol" else "- "
        kind[1] += 1
        out.indent, out.mark = held + " " * len(mark) if deeper else held[: -len(mark)] + " " * len(mark), mark if shown else ""
    elif tag in ("dd", "blockquote") and deeper:
        out.indent = held + "  "
    pre = pre or tag in ("pre", "xmp")
    for i, k in enumerate(node.kids):
        if not isinstance(k, str):
            if tag == "mfrac" and shown and any(not isinstance(x, str) for x in node.kids[:i]):
                out.text("/")
            yield render(k, out, pre, within, shown, drawn)
        elif shown and drawn:
            out.raw(k) if pre else out.text(k)
    if margin:
        out.block(margin)
        if tag == "li":
            out.mark = ""
    out.indent = held


def table(node: Node, out: Lines, shown: bool, drawn: bool) -> Generator:
    """Cells padded to columns; a cell of several lines takes several lines."""
    out.block(2)
    rows: list[list[list[str]]] = []

    def walk(n: Node, shown: bool) -> Generator:
        at, held = 0, {}  # the row, and the one that the cells above end before, by column
        for k in n.kids:
            if isinstance(k, str):
                if k.strip() and shown and drawn:
                    rows.append([[" ".join(k.split())]])
            elif hidden(k):
                continue
            elif k.tag in SECTIONS:
                yield walk(k, visible(k, shown))
            elif k.tag == "tr":
                seen = visible(k, shown)
                row: list[list[str]] = []
                for c in k.kids:
                    if isinstance(c, str) and not c.strip():
                        continue
                    if not isinstance(c, str) and hidden(c):
                        continue
                    while held.get(len(row), 0) > at:  # cells of rows above reach down to here
                        row.append([""])
                    first = len(row)
                    row.append((yield _inside(c, seen, drawn)))
                    if not isinstance(c, str) and first < COLUMNS:
                        row += [[""]] * (min(_span(c.attrs.get("colspan", "1"), COLUMNS), COLUMNS - first) - 1)
                        rows_down = _span(c.attrs.get("rowspan", "1"), ROWS) or ROWS  # 0: to the section's end
                        held.update(dict.fromkeys(range(first, len(row)), at + rows_down))
                at += 1
                if row and (seen or row != [[""]] * len(row)):
                    rows.append(row)
            elif k.tag not in ("col", "colgroup"):
                cell = yield _inside(k, shown, drawn)
                if cell != [""] or visible(k, shown):
                    rows.append([cell])

    yield walk(node, shown)
    width = [0] * max(map(len, rows), default=0)
    for row in rows:
        if len(row) > 1:
            for i, cell in enumerate(row):
                width[i] = max(width[i], *map(len, cell))
    for row in rows:
        for line in range(max(map(len, row))):
            parts = [cell[line] if line < len(cell) else "" for cell in row]
            out._start()
            out.open = "  ".join(p.ljust(w) for p, w in zip(parts, width, strict=False)).rstrip() if len(parts) > 1 else parts[0]
            out.line(True)
    out.block(2)


def _inside(node: Node | str, shown: bool, drawn: bool) -> Generator:
    own = Lines()
    kids = node.kids if isinstance(node, Node) and node.tag != "svg" else [node]
    shown = visible(node, shown) if isinstance(node, Node) else shown
    for k in kids:
        if not isinstance(k, str):
            yield render(k, own, shown=shown, drawn=drawn)
        elif shown and drawn:
            own.text(k)
    own.line()
    return [x for x in own.lines if x] or [""]


def page_text(page: str) -> str:
    out = Lines()
    finished(render(build(page), out))
    out.line()
    lines = out.lines
    while lines and not lines[-1]:
        lines.pop()
    while lines and not lines[0]:
        lines.pop(0)
    return "\n".join(lines)


def extract_text(pages: DataFrame, html_col: str = "html", out_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the page by default) with the page's
    visible text as ``out_col``; a column of that name is replaced."""
    keep = [c for c in (pages.columns if keep is None else keep) if c not in (html_col, out_col)]
    rows = pages.select(F.coalesce(F.col(html_col), F.lit("")).alias("page"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)])

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([page_text(p.as_py()) for p in batch.column(0)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], text], names=[*batch.schema.names[1:], "visible"])

    heads = "".join(f"c{i} {pages.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    out = rows.mapInArrow(fn, heads + "visible string")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("visible").alias(out_col))
