"""One pass over a stored page: its base, links, list items and tables.

Pages are rows of a ``(key, html)`` table; nothing is fetched. Lists and
tables nest, end tags are left out, and comments, scripts and quoted
attributes hold text that looks like markup, so patterns over the text cannot
tell links from their like. A page is cut into tokens by one expression (in
time linear in its length, whatever is left open), and the few tags that open
or close links, list items, tables and cells drive a stack. The work is done in
Arrow batches where the page is stored: no shuffle, and memory for one page's
parts at a time.

What counts, as in a browser:

- Tags and attributes in any case, in any order, with values in ``"``, ``'`` or no quotes; of an attribute given twice the
  first. A ``>`` inside a quoted value ends nothing.
- Comments, ``script``, ``style``, ``textarea``, ``title`` and the other elements of plain text hold no tags, a
  ``template`` holds no links; one that is not closed reaches to the end of the page, and so does an unclosed tag.
- Character references are decoded, in attributes by the rule for attributes (``?a=1&copy=2`` stays as it is).
- ``<li>`` ends the item before it; the end of a list, cell or table ends what is open inside; ``<a>`` ends the link
  before it.
- The first ``<base href>`` counts.

``<noscript>`` is read as if scripts were off. Null pages have no parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html import unescape
from html.entities import html5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# An attribute's value is quoted, or ends at a blank or the tag's end (an unclosed quote makes it the latter).
_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))*+"""
_PLAIN = "script|style|textarea|title|xmp|iframe|noembed|noframes"
TOKEN = re.compile(
    rf"""<!--(?:-?>|.*?(?:--!?>|\Z))"""
    rf"""|<({_PLAIN})(?=[\s/>]){_ATTRIBUTES}(?:>.*?(?:</\1(?=[\s/>])[^>]*+>|\Z)|\Z)"""
    rf"""|<(/?)([a-z][^\s/>]*+)({_ATTRIBUTES})(>|\Z)"""
    r"""|<[!?/][^>]*+(?:>|\Z)""", re.I | re.S)
_ATTRIBUTE = re.compile(r"""([^\s=>/][^\s=>/]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?""", re.S)
_REFERENCE = re.compile(r"&(#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[a-zA-Z][a-zA-Z0-9]*+;?)(=?)")
_DROPPED = re.compile(r"[\t\n\r]")  # what a browser takes out of a URL

LINK = "struct<pos: int, href: string, text: string, item: int, list: int, depth: int>"
ITEM = "struct<item: int, list: int, depth: int, text: string>"
PARTS = {"base": "string", "links": f"array<{LINK}>", "items": f"array<{ITEM}>", "tables": "array<array<array<string>>>"}


def attribute_text(value: str) -> str:
    """An attribute's value with its character references decoded: a name without ``;`` counts only if all of it is one
    and no ``=`` follows."""
    def one(m: re.Match) -> str:
        name = m[1]
        if name[0] != "#" and (name not in html5 or m[2] and not name.endswith(";")):
            return m[0]
        return unescape("&" + name) + m[2]
    return _REFERENCE.sub(one, value) if "&" in value else value


def attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        value = m[2] or ""
        if len(value) > 1 and value[0] in "\"'" and value[-1] == value[0]:
            value = value[1:-1]
        found.setdefault(m[1].lower(), value)
    return {name: attribute_text(value) for name, value in found.items()}


class _Open:
    """An open list, item, table or cell, with what is known of its surroundings, so that nobody searches them."""

    __slots__ = ("kind", "at", "text", "sink", "item", "list", "depth", "table")

    def __init__(self, kind: str, at, place: int, around: _Open | None):
        self.kind, self.at, self.text = kind, at, []
        # The text that text here belongs to: of the innermost item or cell, of nothing between a table's cells.
        self.sink = self.text if kind in ("item", "cell") else None if kind == "table" or around is None else around.sink
        self.item = at if kind == "item" else around.item if around else None
        self.list = at if kind == "list" else around.list if around else None
        self.depth = (around.depth if around else 0) + (kind == "list")
        self.table = place if kind == "table" else around.table if around else -1  # the innermost table's place


class Page:
    """The parts of a page: ``base``, ``links`` (pos, href, text, item, list, depth), ``items`` (item, list, depth, text)
    and ``tables``, rows of cells [text, rowspan, colspan] in the order in which tables open."""

    def __init__(self, html: str | None):
        self.base: str | None = None
        self.links: list[list] = []
        self.items: list[list] = []
        self.tables: list[list[list[list]]] = []
        self.lists = 0
        self._stack: list[_Open] = []
        self._link: tuple[list, list, int] | None = None  # the open link, its text, and how deep it was opened
        self._read(html or "")

    def _read(self, html: str) -> None:
        at, inert = 0, 0
        for m in TOKEN.finditer(html):
            if m.start() > at and not inert and (self._link or self._stack):
                self._text(html[at:m.start()])
            at = m.end()
            name = m[3]
            if name is None or not m[5]:
                continue
            name = name.lower()
            if name == "template":
                inert = max(0, inert + (-1 if m[2] else 1))
            elif not inert and name in _TAGS:
                getattr(self, _TAGS[name])(name, not m[2], m[4])
        if at < len(html) and not inert and (self._link or self._stack):
            self._text(html[at:])
        self._close(0)
        self._end_link()

    def _text(self, raw: str) -> None:
        text = unescape(raw) if "&" in raw else raw
        if self._link:
            self._link[1].append(text)
        if self._stack and self._stack[-1].sink is not None:
            self._stack[-1].sink.append(text)

    def _push(self, kind: str, at) -> None:
        self._stack.append(_Open(kind, at, len(self._stack), self._stack[-1] if self._stack else None))

    def _end_link(self) -> None:
        if self._link:
            self._link[0][2] = "".join(self._link[1])
            self._link = None

    def _close(self, depth: int) -> None:
        """Close what is open from ``depth`` on."""
        if self._link and self._link[2] > depth:
            self._end_link()
        while len(self._stack) > depth:
            element = self._stack.pop()
            if element.kind == "item":
                self.items[element.at][3] = "".join(element.text)
            elif element.kind == "cell":
                element.at[0] = "".join(element.text)

    def anchor(self, name: str, opens: bool, text: str) -> None:
        self._end_link()
        href = attributes(text).get("href") if opens else None
        if href is not None:
            item = self._stack[-1].item if self._stack else None
            where = self.items[item][:3] if item is not None else [None, None, None]
            self.links.append([len(self.links), _DROPPED.sub("", href.strip(" \t\n\r\f")), "", *where])
            self._link = (self.links[-1], [], len(self._stack))

    def first_base(self, name: str, opens: bool, text: str) -> None:
        href = attributes(text).get("href") if opens and self.base is None else None
        if href is not None:
            self.base = _DROPPED.sub("", href.strip(" \t\n\r\f"))

    def some_list(self, name: str, opens: bool, text: str) -> None:
        if opens:
            self._push("list", self.lists)
            self.lists += 1
            return
        # The innermost list of this cell; between it and the top there is at most an item.
        for back in (1, 2):
            if len(self._stack) >= back and self._stack[-back].kind == "list":
                return self._close(len(self._stack) - back)
            if len(self._stack) < back or self._stack[-back].kind != "item":
                return None

    def list_item(self, name: str, opens: bool, text: str) -> None:
        if self._stack and self._stack[-1].kind == "item":
            self._close(len(self._stack) - 1)
        if opens:
            around = self._stack[-1] if self._stack else None
            self.items.append([len(self.items), around.list if around else None, around.depth if around else 0, ""])
            self._push("item", len(self.items) - 1)

    def table(self, name: str, opens: bool, text: str) -> None:
        if opens:
            self._push("table", len(self.tables))
            self.tables.append([])
        elif self._stack and self._stack[-1].table >= 0:
            self._close(self._stack[-1].table)

    def row_or_cell(self, name: str, opens: bool, text: str) -> None:
        at = self._stack[-1].table if self._stack else -1
        if at < 0:
            return
        rows = self.tables[self._stack[at].at]
        self._close(at + 1)
        if opens and (name == "tr" or not rows):
            rows.append([])
        if opens and name != "tr":
            span = {k: int(v) for k, v in attributes(text).items() if k in ("rowspan", "colspan") and v.isascii() and v.isdigit()}
            rows[-1].append(["", span.get("rowspan", 1), max(1, min(span.get("colspan", 1), 1000))])
            self._push("cell", rows[-1][-1])

    def grid(self, index: int) -> list[list[str]]:
        """Rows of a table with spanning cells repeated in every place they cover; no rows if there is no such table."""
        if not -len(self.tables) <= index < len(self.tables):
            return []
        rows, held = [], {}  # held: column -> (rows left, text)
        table = self.tables[index]
        for i, cells in enumerate(table):
            row, waiting, column = [], iter(cells), 0
            cell = next(waiting, None)
            while cell is not None or column in held:
                if column in held:
                    left, text = held.pop(column)
                    if left > 1:
                        held[column] = (left - 1, text)
                    row.append(text)
                    column += 1
                    continue
                text, down, across = cell
                text = " ".join(text.split())
                down = len(table) - i if down == 0 else down  # 0 spans the rest of the table
                for _ in range(across):
                    if column in held:
                        break
                    if down > 1:
                        held[column] = (down - 1, text)
                    row.append(text)
                    column += 1
                cell = next(waiting, None)
            rows.append(row)
        return rows

    def part(self, name: str):
        if name == "base":
            return self.base
        if name == "links":
            return [dict(zip(("pos", "href", "text", "item", "list", "depth"), x, strict=True)) for x in self.links]
        if name == "items":
            return [dict(zip(("item", "list", "depth", "text"), x, strict=True)) for x in self.items]
        return [self.grid(i) for i in range(len(self.tables))]


_TAGS = {"a": "anchor", "base": "first_base", "li": "list_item", "table": "table",
         **dict.fromkeys(("ul", "ol", "menu", "dir"), "some_list"), **dict.fromkeys(("tr", "td", "th"), "row_or_cell")}


def page_parts(pages: DataFrame, keys: Sequence[str] = ("page_id",), html_col: str = "html",
               parts: Sequence[str] = tuple(PARTS)) -> DataFrame:
    """``keys`` and the chosen ``parts`` of every page:

    - ``base``: the first ``<base href>``, or NULL;
    - ``links``: (pos, href, text, item, list, depth) of every ``<a href>`` in order; the last three say in which list item
      it is (NULL outside lists);
    - ``items``: (item, list, depth, text) of every list item, with the text that is no deeper item's;
    - ``tables``: rows of cell texts of every table, spanning cells repeated in each place they cover.
    """
    keys, parts = list(keys), list(parts)
    kinds = [T._parse_datatype_string(PARTS[p]) for p in parts]
    schema = T.StructType([pages.schema[k] for k in keys] + [T.StructField(p, k) for p, k in zip(parts, kinds, strict=True)])
    from pyspark.sql.pandas.types import to_arrow_type
    types = [to_arrow_type(k) for k in kinds]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                found: list[list] = [[] for _ in parts]
                for html in some.column(len(keys)):
                    page = Page(html.as_py())
                    for out, name in zip(found, parts, strict=True):
                        out.append(page.part(name))
                yield pa.RecordBatch.from_arrays(
                    [some.column(i) for i in range(len(keys))]
                    + [pa.array(out, kind) for out, kind in zip(found, types, strict=True)], names=[*keys, *parts])

    return pages.select(*keys, html_col).mapInArrow(read, schema)
