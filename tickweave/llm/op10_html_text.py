"""Operator 10, HTML extraction by layout-aware rendering.

A tree builder (implied end tags, raw-text elements, misnested and stray tags)
turns a page into open / text / close steps; a renderer walks them with the
visibility rules and writes all visible text: blocks on their own lines with
blank lines around paragraphs, headings, lists and tables, list items with
marks and indentation, table cells padded to aligned columns.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tickweave.llm.spark import table

# Fixed values of the HTML standard (element classes).
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol",
    "optgroup", "option", "p", "pre", "search", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul", "xmp", "caption",
}
SPACED = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "pre", "blockquote", "figure", "fieldset", "menu", "dir", "hr", "xmp"}
HIDDEN = {"head", "script", "style", "template", "noscript", "title", "iframe", "object", "audio", "video", "canvas", "datalist", "noembed", "noframes", "rp"}
CLOSES_P = BLOCK - {"body", "html", "legend", "optgroup", "option", "tbody", "tfoot", "thead", "tr", "caption"}
LISTS = {"ul", "ol", "menu", "dir"}
TABLE_PARTS = {"table", "thead", "tbody", "tfoot", "tr"}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>|([^<]+)|<", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACES = re.compile(r"[ \t\n\r\f]+")


def steps(html: str) -> Iterator[tuple[str, str, dict]]:
    """('open', tag, attributes), ('close', tag, {}) and ('text', text, {}) of the page's
    tree, properly nested: implied end tags are made, stray end tags dropped."""
    stack: list[str] = []
    count: Counter[str] = Counter()  # open elements by tag: deep pages are searched only for what is open

    def close_to(i: int) -> Iterator[tuple[str, str, dict]]:
        while len(stack) > i:
            count[stack[-1]] -= 1
            yield "close", stack.pop(), {}

    def nearest(tags: set[str], walls: set[str]) -> int:
        if not any(count[t] for t in tags):
            return -1
        for i in range(len(stack) - 1, -1, -1):
            if stack[i] in tags:
                return i
            if stack[i] in walls:
                return -1
        return -1

    at, n, last = 0, len(html), html.rfind(">")
    while at < n:
        if at > last:  # no tag can end any more
            yield "text", unescape(html[at:]), {}
            break
        m = TOKEN.match(html, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[4] is not None:
                yield "text", unescape(m[4]), {}
            elif m[0] == "<":
                yield "text", "<", {}
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "br":
                yield "open", "br", {}
                yield "close", "br", {}
                continue
            walls = {"table"} if tag in TABLE_PARTS or tag in ("td", "th", "caption") else {"td", "th", "caption"}
            i = nearest({tag}, walls - {tag})
            if i >= 0 and tag not in BLOCK and tag not in ("td", "th") and any(x in BLOCK for x in stack[i + 1 :]):
                continue  # an inline end tag does not end the blocks that began inside
            if i >= 0:
                yield from close_to(i)
            elif tag == "p":
                yield "open", "p", {}
                yield "close", "p", {}
            continue
        # Implied end tags of what this start tag cannot stand in.
        i = -1
        if tag in CLOSES_P:
            i = nearest({"p"}, {"td", "th", "caption", "button", "table"})
        if tag == "li":
            j = nearest({"li"}, LISTS | {"td", "th", "table"})
            i = j if i < 0 or 0 <= j < i else i
        elif tag in ("dd", "dt"):
            j = nearest({"dd", "dt"}, {"dl", "td", "th", "table"})
            i = j if i < 0 or 0 <= j < i else i
        elif tag in ("td", "th"):
            i = nearest({"td", "th"}, {"table"})
        elif tag == "tr":
            i = nearest({"tr", "caption"}, {"table"})
        elif tag in ("thead", "tbody", "tfoot"):
            i = nearest({"thead", "tbody", "tfoot"}, {"table"})
            i = i if i >= 0 else nearest({"tr", "caption"}, {"table"})
        elif tag in ("option", "optgroup"):
            i = nearest({"option", "optgroup"} if tag == "optgroup" else {"option"}, {"select", "datalist"})
        elif tag == "body":
            i = nearest({"head"}, set())
        if i >= 0:
            yield from close_to(i)
        if tag in ("td", "th", "tr", "thead", "tbody", "tfoot", "caption") and not count["table"]:
            continue  # a table part outside a table is no element
        if tag in ("td", "th") and nearest({"tr"}, {"table"}) < 0:
            stack.append("tr")
            count["tr"] += 1
            yield "open", "tr", {}
        if tag in BLOCK - {"html", "body"} and stack and stack[-1] == "head":
            yield from close_to(len(stack) - 1)
        attrs = {a[1].lower(): unescape(a[2] or a[3] or a[4] or "") for a in ATTRIBUTE.finditer(m[3])} if m[3] and not m[3].isspace() else {}
        yield "open", tag, attrs
        if tag in VOID:
            yield "close", tag, {}
        elif tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            raw = html[at : end.start() if end else n]
            at = end.end() if end else n
            if tag in ("textarea", "title"):
                raw = unescape(raw)
            yield "text", raw, {}
            yield "close", tag, {}
        else:
            stack.append(tag)
            count[tag] += 1
    yield from close_to(0)


class Flow:
    """Lines of one block context (the page, or a table cell)."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = self.kept = False
        self.gap = 0
        self.indent: list[str] = []
        self.mark = ""

    def words(self, text: str) -> None:
        parts = SPACES.split(text)
        if len(parts) == 1:
            self._add(text)
            return
        if parts[0]:
            self._add(parts[0])
        for p in parts[1:]:
            self.space = bool(self.line)
            if p:
                self._add(p)

    def _add(self, word: str) -> None:
        if word:
            if self.space and self.line:
                self.line.append(" ")
            self.line.append(word)
            self.space = False

    def preformatted(self, text: str) -> None:
        head, *rest = text.replace("\r\n", "\n").split("\n")
        if head:
            self.line.append(head)
        for x in rest:
            self.kept = True
            self.end_line()
            if x:
                self.line.append(x)

    def end_line(self, always: bool = False) -> None:
        if self.line or always or self.kept:
            if self.lines:
                self.lines.extend([""] * self.gap)
            self.gap = 0
            body, pad = "".join(self.line), "".join(self.indent)
            if self.mark:
                pad = pad[: len(pad) - len(self.mark)] + self.mark
                self.mark = ""
            self.lines.append((pad + body).rstrip() if body else "")
        self.line, self.space, self.kept = [], False, False

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def text(self) -> list[str]:
        self.end_line()
        return self.lines


class Grid:
    """Rows of cells of one table; ``render`` pads them to aligned columns."""

    def __init__(self):
        self.rows: list[list[list[str]]] = []

    def render(self) -> list[str]:
        columns = max((len(r) for r in self.rows), default=0)
        width = [0] * columns
        for r in self.rows:
            for i, cell in enumerate(r):
                width[i] = max([width[i], *map(len, cell)])
        out = []
        for r in self.rows:
            for k in range(max([1, *map(len, r)])):
                out.append("  ".join((c[k] if k < len(c) else "").ljust(width[i]) for i, c in enumerate(r)).rstrip())
        return out


def visibility(tag: str, attrs: dict, shown: bool, drawn: bool) -> tuple[bool, bool]:
    """(displayed, visible) of an element from its parent's; display is lost for
    good below a hidden element, visibility can be regained."""
    if tag in HIDDEN or "hidden" in attrs or tag == "input" and attrs.get("type", "").lower() == "hidden":
        shown = False
    style = attrs.get("style")
    if style:
        rules = dict(p.split(":", 1) for p in style.lower().replace("!important", "").split(";") if ":" in p)
        rules = {k.strip(): v.strip() for k, v in rules.items()}
        if rules.get("display") == "none":
            shown = False
        if "visibility" in rules:
            drawn = rules["visibility"] not in ("hidden", "collapse")
    return shown, drawn


def render(html: str) -> str:
    """All visible text of a page."""
    flows, grids = [Flow()], []
    state = [(True, True, False, "")]  # displayed, visible, preformatted, kind of list with its counter
    counters: list[int] = []
    cells: list[int] = []  # colspan of the open cells
    inside: list[str] = []
    for kind, what, attrs in steps(html):
        shown, drawn, pre, lst = state[-1]
        flow = flows[-1]
        if kind == "text":
            if shown and drawn:
                if inside and inside[-1] in TABLE_PARTS:  # text between cells stands before the table
                    if not what.isspace():
                        flow.words(what)
                elif pre:
                    flow.preformatted(what)
                else:
                    flow.words(what)
            continue
        if kind == "open":
            shown, drawn = visibility(what, attrs, shown, drawn)
            pre = pre or what in ("pre", "textarea", "xmp")
            inside.append(what)
            state.append((shown, drawn, pre, what if what in LISTS else lst))
            if not shown:
                continue
            if what == "br":
                flow.end_line(always=True)
            elif what == "table":
                flow.block(1)
                grids.append(Grid())
            elif what == "tr" and grids:
                grids[-1].rows.append([])
            elif what in ("td", "th") and grids and grids[-1].rows:
                flows.append(Flow())
                span = attrs.get("colspan", "1")
                cells.append(max(1, min(1000, int(span))) if span.isascii() and span.isdigit() else 1)
            elif what in LISTS:
                flow.block(0 if counters else 1)
                start = attrs.get("start", "1")
                counters.append(int(start) if start.isascii() and start.isdigit() else 1)
            elif what == "li":
                flow.block(0)
                if lst == "ol" and counters:
                    mark = f"{counters[-1]}. "
                    counters[-1] += 1
                else:
                    mark = "- "
                flow.indent.append(" " * len(mark))
                flow.mark = mark
            elif what in ("dd", "blockquote"):
                flow.block(1 if what == "blockquote" else 0)
                flow.indent.append("    ")
            elif what in BLOCK and what not in TABLE_PARTS:
                flow.block(1 if what in SPACED else 0)
            continue
        # close
        state.pop()
        inside.pop()
        if not shown:
            continue
        if what == "table" and grids:
            lines = grids.pop().render()
            while flows and len(cells) > len(flows) - 1:
                cells.pop()
            if any(lines):
                flow.block(1)
                for x in lines:
                    flow.line = [x] if x else []
                    flow.end_line(always=True)
                flow.block(1)
        elif what in ("td", "th") and cells and len(flows) > 1:
            grids[-1].rows[-1].append(flows.pop().text())
            grids[-1].rows[-1].extend([[]] * (cells.pop() - 1))
        elif what in LISTS:
            counters.pop()
            flow.block(0 if counters else 1)
        elif what in ("li", "dd", "blockquote"):
            flow.end_line()
            flow.mark = ""
            if flow.indent:
                flow.indent.pop()
            flow.block(1 if what == "blockquote" else 0)
        elif what in BLOCK and what not in TABLE_PARTS:
            flow.block(1 if what in SPACED else 0)
    return "\n".join(flows[0].text())


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``page_id, text``: the visible text of every page, one row per input row.

    Null or empty html gives an empty text; null and repeated ids keep their
    rows; a page without tags is one run of text; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = pa.array([render(x) if x else "" for x in b.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), out], names=[id_col, "text"])

    return pages.select(id_col, html_col).mapInArrow(run, f"`{id_col}` {pages.schema[id_col].dataType.simpleString()}, text string")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
