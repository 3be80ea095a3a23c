"""Links, tables and list items out of page texts.

Links are found by a pattern in the JVM. Tables and items nest and are often left unclosed, so
their pages go through a tokenizer with a stack of open elements, in Arrow batches: a page at a time, in one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CELLS = "array<struct<texts: array<string>, links: array<string>>>"
_ITEMS = "array<struct<text: string, link: string>>"


@dataclass
class _Capture:
    """An open cell or item: its text so far and its first link."""

    text: list[str] = field(default_factory=list)
    link: str | None = None


@dataclass
class _Table:
    """An open table: whether its rows are wanted, its open row and cell."""

    wanted: bool
    row: list[_Capture | None] | None = None
    cell: _Capture | None = None


class _TableParser(HTMLParser):
    """Rows of the first table of an id; a row has a capture for each wanted cell that it holds.

    A new row or cell ends the open one of its table; rows of a nested table are not rows of the outer one,
    its text is text of the outer cell.
    """

    def __init__(self, table_id: str, cells: Sequence[str], attribute: str):
        super().__init__(convert_charrefs=True)
        self.table_id, self.cells, self.attribute = table_id, cells, attribute
        self.open: list[_Table] = []
        self.rows: list[list[_Capture | None]] = []
        self.seen = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = dict(attrs)
        if tag == "table":
            wanted = not self.seen and given.get("id") == self.table_id
            self.seen |= wanted
            self.open.append(_Table(wanted))
        elif tag == "a" and given.get("href"):
            for table in self.open:
                if table.cell is not None and table.cell.link is None:
                    table.cell.link = given["href"]
        elif self.open and tag in ("tr", "td", "th"):
            top = self.open[-1]
            top.cell = None
            if tag == "tr" or top.row is None:
                top.row = [None] * len(self.cells)
                if top.wanted:
                    self.rows.append(top.row)
            if tag == "td" and given.get(self.attribute) in self.cells:
                place = self.cells.index(given[self.attribute])
                if top.row[place] is None:
                    top.row[place] = top.cell = _Capture()

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self.open:
            self.open.pop()
        elif self.open and tag in ("tr", "td", "th"):
            self.open[-1].cell = None
            if tag == "tr":
                self.open[-1].row = None

    def handle_data(self, data: str) -> None:
        for table in self.open:
            if table.cell is not None:
                table.cell.text.append(data)


class _ItemParser(HTMLParser):
    """Text and first link of every element of a tag, in the order in which they begin.

    Elements nest inside lists; one that begins outside a list of its own ends the open one.
    """

    def __init__(self, tag: str):
        super().__init__(convert_charrefs=True)
        self.tag = tag
        self.open: list[_Capture | None] = []  # None: a list between two elements
        self.items: list[_Capture] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == self.tag:
            if self.open and self.open[-1] is not None:
                self.open.pop()
            self.items.append(_Capture())
            self.open.append(self.items[-1])
        elif tag in ("ul", "ol", "table"):
            self.open.append(None)
        elif tag == "a" and (link := dict(attrs).get("href")):
            for item in self.open:
                if item is not None and item.link is None:
                    item.link = link

    def handle_endtag(self, tag: str) -> None:
        if tag == self.tag:
            if self.open and self.open[-1] is not None:
                self.open.pop()
        elif tag in ("ul", "ol", "table"):
            while self.open and self.open.pop() is not None:
                pass

    def handle_data(self, data: str) -> None:
        for item in self.open:
            if item is not None:
                item.text.append(data)


def table_rows(page: str, table_id: str, cells: Sequence[str], attribute: str = "data-stat") -> list[dict]:
    parser = _TableParser(table_id, cells, attribute)
    parser.feed(page)
    parser.close()
    return [
        {"texts": [c and "".join(c.text) for c in row], "links": [c and c.link for c in row]} for row in parser.rows
    ]


def page_items(page: str, tag: str) -> list[dict]:
    parser = _ItemParser(tag)
    parser.feed(page)
    parser.close()
    return [{"text": "".join(item.text), "link": item.link} for item in parser.items]


def _parsed(kind: str, parse: Callable[[str], list[dict]], page: Column) -> Column:
    """The parsed parts of every page; declared non-deterministic so that a filter doesn't parse twice."""

    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: None if page is None else parse(page))

    return F.pandas_udf(run, kind).asNondeterministic()(page)


def uncommented(html: Column) -> Column:
    """Page with the contents of its comments laid open."""
    return F.replace(F.replace(html, F.lit("<!--"), F.lit("")), F.lit("-->"), F.lit(""))


def extract_links(
    pages: DataFrame, ids: Sequence[str], html: str = "html", prefix: str = "/", keyword: str = ""
) -> DataFrame:
    """Anchor targets with the prefix that contain the keyword, in page order."""
    links = F.regexp_extract_all(
        F.col(html), F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1)
    )
    return (
        pages.select(*ids, F.posexplode(links).alias("position", "link"))
        .filter(F.startswith(F.col("link"), F.lit(prefix)) & F.contains(F.col("link"), F.lit(keyword)))
    )


def extract_items(
    pages: DataFrame, ids: Sequence[str], html: str = "html", tag: str = "li"
) -> DataFrame:
    """Text and first link of every element of the tag, in page order."""
    items = _parsed(_ITEMS, lambda page: page_items(page, tag), uncommented(F.col(html)))
    found = pages.select(*ids, F.posexplode(items).alias("position", "_item"))
    return found.select(*ids, "position", "_item.text", F.nullif("_item.link", F.lit("")).alias("link"))


def link_stem(link: Column) -> Column:
    """Last part of a link without its ``.htm`` ending."""
    return F.replace(F.element_at(F.split(link, "/"), -1), F.lit(".htm"), F.lit(""))


def extract_table_rows(
    pages: DataFrame,
    ids: Sequence[str],
    table_id: str,
    cells: Mapping[str, str],
    key: str,
    key_id: str,
    whole: Sequence[str] = (),
    summary_label: str | None = "Team Total",
    html: str = "html",
    attribute: str = "data-stat",
) -> DataFrame:
    """Rows of the table with the given id, also where a comment hides it.

    ``cells`` maps output columns to the cells' ``data-stat``. Rows without the
    ``key`` cell are skipped; its link gives ``key_id``. The columns in
    ``whole`` are integers, 0 for an empty cell. A row without a link that bears
    the summary label is dropped.
    """
    stats = list(dict.fromkeys(cells.values()))
    rows = _parsed(_CELLS, lambda page: table_rows(page, table_id, stats, attribute), uncommented(F.col(html)))
    exploded = pages.select(*ids, F.posexplode(rows).alias("position", "_tr"))

    def held(part: str, name: str) -> Column:
        return F.get(F.col(f"_tr.{part}"), F.lit(stats.index(cells[name])))

    found = exploded.filter(held("texts", key).isNotNull())
    values = {}
    for name in cells:
        text = held("texts", name)
        values[name] = (
            F.coalesce(F.nullif(F.trim(text), F.lit("")).try_cast("int"), F.lit(0)) if name in whole else text
        )
    listed = found.select(
        *ids,
        "position",
        link_stem(F.nullif(held("links", key), F.lit(""))).alias(key_id),
        *[value.alias(name) for name, value in values.items()],
    )
    if summary_label is None:
        return listed
    return listed.filter(F.col(key_id).isNotNull() | (F.col(key) != summary_label))
