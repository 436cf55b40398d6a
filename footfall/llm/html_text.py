"""Visible text of web pages, laid out as a page shows it.

A tree builder reads tags, adds the ends that HTML lets authors leave out and
drops ends that close nothing; what it opens and closes is always nested. The
layout walks that, leaves out what is not shown, sets blocks apart, marks and
indents list items and aligns table cells.

A null page has a null text, an empty one an empty text. Broken markup is read
as far as it goes: an unclosed tag or comment ends with the page. Rows with null
or equal ids are rendered one by one; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import html
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements without content, elements whose content is plain
# characters, and the elements whose start ends an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table ul".split()
)
# Blocks with an empty line before and after.
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul".split())
HIDDEN = frozenset(
    "area audio canvas datalist head iframe math meta noembed noframes noscript object param rp script style "
    "svg template title video".split()
)
LISTS = frozenset(["ul", "ol", "menu", "dir"])
SECTIONS = frozenset(["thead", "tbody", "tfoot"])
# A start tag ends the nearest open element of these names, unless a boundary stands between.
IMPLIED_END = {
    "li": (("li",), LISTS),
    "dt": (("dt", "dd"), frozenset(["dl"])),
    "dd": (("dt", "dd"), frozenset(["dl"])),
    "option": (("option",), frozenset(["select", "datalist"])),
    "optgroup": (("optgroup", "option"), frozenset(["select"])),
    "tr": (("tr", "caption", "colgroup"), frozenset(["table"])),
    "td": (("td", "th"), frozenset(["tr", "table"])),
    "th": (("td", "th"), frozenset(["tr", "table"])),
    "thead": (("caption", "colgroup", "thead", "tbody", "tfoot"), frozenset(["table"])),
    "tbody": (("caption", "colgroup", "thead", "tbody", "tfoot"), frozenset(["table"])),
    "tfoot": (("caption", "colgroup", "thead", "tbody", "tfoot"), frozenset(["table"])),
    "body": (("head",), frozenset()),
    "rt": (("rt", "rp"), frozenset(["ruby"])),
    "rp": (("rt", "rp"), frozenset(["ruby"])),
}
# No end tag and no paragraph's end reaches out of these.
SCOPES = frozenset(["td", "th", "caption", "table", "button", "object", "template"])
HEAD_ONLY = frozenset("base link meta title style script noscript template head".split())

_MARKUP = regex.compile(
    r"<(?:(?P<comment>!--)|(?P<other>[!?])|(?P<end>/)?(?P<name>[A-Za-z][^\s/>]*)"
    r"(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>)"
)
_ATTRIBUTE = regex.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACES = regex.compile(r"[ \t\n\r\f]+")
_UNSEEN = regex.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", regex.I)

Event = tuple[str, str, str]  # kind (open, close, text), name or characters, attributes


def _tokens(page: str) -> Iterator[Event]:
    """Markup as it stands in the page, with character references resolved."""
    at, raw = 0, ""
    while at < len(page):
        if raw:
            end = regex.compile(rf"</{regex.escape(raw)}(?=[\s/>])", regex.I).search(page, at)
            stop = end.start() if end else len(page)
            if stop > at:
                inner = page[at:stop]
                yield "text", html.unescape(inner) if raw in ("title", "textarea") else inner, ""
            at, raw = stop, ""
            continue
        m = _MARKUP.search(page, at)
        if not m:
            yield "text", html.unescape(page[at:]), ""
            return
        if m.start() > at:
            yield "text", html.unescape(page[at : m.start()]), ""
        if m["comment"]:
            end = page.find("-->", m.start() + 2)
            at = len(page) if end < 0 else end + 3
        elif m["other"]:
            end = page.find(">", m.end())
            at = len(page) if end < 0 else end + 1
        else:
            at, name = m.end(), m["name"].lower()
            if m["end"]:
                yield "close", name, ""
            else:
                yield "open", name, m["attributes"]
                if name in RAW:
                    raw = name


class _Open:
    """The open elements, and the places of each name among them."""

    def __init__(self):
        self.names: list[str] = []
        self.places: dict[str, list[int]] = {}

    def push(self, name: str) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        self.names.append(name)

    def pop(self) -> str:
        name = self.names.pop()
        self.places[name].pop()
        return name

    def last(self, names) -> int:
        """The place of the innermost element of these names; -1 if none is open."""
        return max((found[-1] for name in names if (found := self.places.get(name))), default=-1)


def _tree(page: str) -> Iterator[Event]:
    """The same, well nested: implied starts and ends added, stray ends dropped.

    Any element is found by its name at once, so deep pages take no longer.
    """
    stack = _Open()

    def ends(names, boundary) -> Iterator[Event]:
        at = stack.last(names)
        if at >= 0 and at >= stack.last(boundary):
            while len(stack.names) > at:
                yield "close", stack.pop(), ""

    def starts(name: str, attributes: str = "") -> Iterator[Event]:
        stack.push(name)
        yield "open", name, attributes

    for kind, name, attributes in _tokens(page):
        if kind == "text":
            if stack.names and stack.names[-1] in ("head", "html") and not name.isspace():
                yield from ends(("head",), ())
            yield kind, name, ""
        elif kind == "open":
            if "head" in stack.names[:2] and name not in HEAD_ONLY:
                yield from ends(("head",), ())
            if name in BLOCKS and stack.last(("p",)) >= 0:
                yield from ends(("p",), SCOPES)
            if name in IMPLIED_END:
                yield from ends(*IMPLIED_END[name])
            if name in ("td", "th") and stack.last(("table",)) > stack.last(("tr",)):
                yield from starts("tr")
            if name in VOID:
                yield "open", name, attributes
                yield "close", name, ""
            else:
                yield from starts(name, attributes)
        elif name == "br":
            yield "open", "br", ""
            yield "close", "br", ""
        else:
            yield from ends((name,), SCOPES - {name} if name not in ("table", "tr", *SECTIONS) else {"table"} - {name})
    while stack.names:
        yield "close", stack.pop(), ""


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def _is_shown(name: str, attributes: dict[str, str]) -> bool:
    if name in HIDDEN or "hidden" in attributes or _UNSEEN.search(attributes.get("style", "")):
        return False
    return not (name == "dialog" and "open" not in attributes)


class Lines:
    """Text being laid out: finished lines, and the line being written."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False  # a space is due before the next word
        self.gap = 0  # line ends due before the next word: 1 a new line, 2 an empty line

    def write(self, text: str) -> None:
        if text[:1] in " \t\n\r\f":
            self.space = True
        body = _SPACES.sub(" ", text).strip(" ")
        if not body:
            return
        self._start()
        if self.space and self.parts:
            self.parts.append(" ")
        self.parts.append(body)
        self.space = text[-1] in " \t\n\r\f"

    def write_lines(self, lines: list[str]) -> None:
        """Lines that are kept as they are."""
        self._start()
        self.lines.extend(lines[:-1])
        self.parts.append(lines[-1])

    def _start(self) -> None:
        if self.gap and self.lines:
            self.lines.extend([""] * (self.gap - 1))
        self.gap = 0

    def end_line(self) -> None:
        if self.parts:
            self.lines.append("".join(self.parts))
            self.parts = []
        self.space = False

    def block(self, lines: int) -> None:
        self.end_line()
        self.gap = max(self.gap, lines)

    def line_break(self) -> None:
        self._start()
        self.lines.append("".join(self.parts))
        self.parts, self.space = [], False

    def finished(self) -> list[str]:
        self.end_line()
        lines = [line.rstrip(" \t") for line in self.lines]
        while lines and not lines[-1]:
            lines.pop()
        while lines and not lines[0]:
            lines.pop(0)
        return lines


def _table(rows: list[list[list[str]]]) -> list[str]:
    """Cells, each a list of lines, in columns as wide as their widest line."""
    rows = [r for r in rows if any(r)]
    widths = [0] * max(map(len, rows), default=0)
    for row in rows:
        for k, cell in enumerate(row):
            widths[k] = max(widths[k], max(map(len, cell), default=0))
    shown = [k for k, w in enumerate(widths) if w]
    out = []
    for row in rows:
        for n in range(max(map(len, row))):
            cells = [row[k][n] if k < len(row) and n < len(row[k]) else "" for k in shown]
            out.append(" | ".join(c.ljust(widths[k]) for c, k in zip(cells, shown, strict=True)).rstrip(" |"))
    return out


def visible_text(page: str) -> str:
    out = Lines()
    outer: list[tuple[str, Lines]] = []  # blocks laid out on their own: li, blockquote, dd, tables, cells
    tables: list[list[list[list[str]]]] = []
    numbers: list[int | None] = []  # the next number of every open list; none for bullets
    hidden = pre = 0

    for kind, name, extra in _tree(page):
        if kind == "text":
            if hidden:
                continue
            if pre:
                lines = name.replace("\r\n", "\n").expandtabs(8).split("\n")
                out.write_lines(lines)
            elif not (outer and outer[-1][0] == "table" and name.isspace()):
                out.write(name)
            continue
        if kind == "open":
            if hidden:
                hidden += 1
                continue
            given = _attributes(extra) if extra else {}
            if not _is_shown(name, given):
                hidden = 1
                continue
            if name == "br":
                out.line_break()
            elif name == "input":
                if given.get("type", "text").lower() in ("submit", "button", "reset", "text") and given.get("value"):
                    out.write(f" {given['value']} ")
            elif name == "table":
                out.block(2)
                outer.append((name, out))
                tables.append([])
                out = Lines()
            elif name == "tr" and tables:
                tables[-1].append([])
            elif name in ("td", "th") and tables:
                if not tables[-1]:
                    tables[-1].append([])
                outer.append((name, out))
                out = Lines()
            elif name in ("li", "blockquote", "dd"):
                out.block(2 if name == "blockquote" else 1)
                outer.append((name, out))
                out = Lines()
            elif name in BLOCKS:
                out.block(2 if name in SPACED and not (name in LISTS and numbers) else 1)
            if name in LISTS:
                start = given.get("start", "1")
                digits = start.removeprefix("-")
                first = int(start) if digits.isascii() and digits.isdigit() and len(digits) < 10 else 1
                numbers.append(first if name == "ol" else None)
            pre += name in ("pre", "textarea")
            continue
        if hidden:
            hidden -= 1
            continue
        if name in LISTS and numbers:
            numbers.pop()
        pre -= name in ("pre", "textarea") and pre > 0
        if name in ("td", "th") and outer and outer[-1][0] == name:
            tables[-1][-1].append(out.finished())
            out = outer.pop()[1]
        elif name == "table" and outer and outer[-1][0] == "table":
            # Text between cells, such as a caption, stands before the table.
            lines = out.finished() + _table(tables.pop())
            out = outer.pop()[1]
            _nest(out, lines)
            out.block(2)
        elif name in ("li", "blockquote", "dd") and outer and outer[-1][0] == name:
            lines = out.finished()
            out = outer.pop()[1]
            mark = ""
            if name == "li":
                mark = "- "
                if numbers and numbers[-1] is not None:
                    mark = f"{numbers[-1]}. "
                    numbers[-1] += 1
            else:
                mark = "  "
            if lines:
                _nest(out, [mark + lines[0], *(" " * len(mark) + x if x else "" for x in lines[1:])])
            out.block(2 if name == "blockquote" else 1)
        elif name in BLOCKS:
            out.block(2 if name in SPACED and not (name in LISTS and numbers) else 1)
    return "\n".join(out.finished())


def _nest(out: Lines, lines: list[str]) -> None:
    if lines:
        out.write_lines(lines)
        out.end_line()


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if p is None else visible_text(p) for p in batch.column(2).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, "page_id long, url string, text string"
    )
