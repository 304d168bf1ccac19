"""Tables of HTML pages by position."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tags import fed


class _Tables(HTMLParser):
    """Cell texts of all tables in page order; a nested table is a table of its own."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.open: list[int] = []
        self.cell: list[list[str]] = []

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "table":
            self.tables.append([])
            self.open.append(len(self.tables) - 1)
        elif tag == "tr" and self.open:
            self.tables[self.open[-1]].append([])
        elif tag in ("td", "th") and self.open and self.tables[self.open[-1]]:
            self.tables[self.open[-1]][-1].append("")

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self.open:
            self.open.pop()

    def handle_data(self, data: str) -> None:
        if self.open and (rows := self.tables[self.open[-1]]) and rows[-1]:
            rows[-1][-1] += data


def table_rows(pages: DataFrame, html: str, position: int | None = None) -> DataFrame:
    """``pages`` (without ``html``) with table, line (both from 0) and cells for each row of each table, or of one.

    Line 0 is the header row. White space in cells is collapsed. Null pages and pages without tables have no rows.
    """

    @F.arrow_udf("array<struct<table:int,line:int,cells:array<string>>>")
    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            ends, tables, lines, cell_ends, cells = [0], [], [], [0], []
            for text in texts:
                parser = _Tables()
                fed(parser, text.as_py() or "", close=False)
                for k, rows in enumerate(parser.tables):
                    if position is None or k == position:
                        for n, row in enumerate(r for r in rows if r):
                            tables.append(k)
                            lines.append(n)
                            cells += [" ".join(c.split()) for c in row]
                            cell_ends.append(len(cells))
                ends.append(len(tables))
            listed = pa.ListArray.from_arrays(pa.array(cell_ends, pa.int32()), pa.array(cells, pa.string()))
            rows = pa.StructArray.from_arrays([pa.array(tables, pa.int32()), pa.array(lines, pa.int32()), listed], names=["table", "line", "cells"])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    others = [c for c in pages.columns if c != html]
    return pages.select(*others, F.inline(parse(F.col(html))))


def named(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The body rows' cells under the given names; rows that are shorter get nulls."""
    cells: list[Column] = [F.try_element_at("cells", F.lit(i + 1)).alias(c) for i, c in enumerate(columns)]
    return rows.where("line > 0").select(*(c for c in rows.columns if c != "cells"), *cells)
