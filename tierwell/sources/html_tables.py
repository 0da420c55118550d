"""HTML table extraction (S7) and the reference-list build.

Pages arrive as a table ``(page_id, html)`` (no fetching here). Every page
is parsed inside a task with the standard-library HTML parser, one row out
per table row: ``(page_id, table_no, row_no, is_header, cells)``, spans
expanded. The list build then works on that
DataFrame with native expressions: pick a table, strip citation markers,
drop rows without information, join two lists on the code.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.text import strip_citations

TABLE_SCHEMA = "page_id long, table_no int, row_no int, is_header boolean, cells array<string>"


class _Table:
    """One open table: finished rows, the open row and the open cell."""

    def __init__(self):
        self.rows: list[tuple[int, bool, list[dict]]] = []
        self.section = 0
        self.row: list[dict] | None = None
        self.cell: dict | None = None
        self.in_head = False

    def end_cell(self) -> None:
        if self.cell is not None:
            self.cell["text"] = " ".join("".join(self.cell.pop("parts")).split())
            self.row.append(self.cell)
            self.cell = None

    def end_row(self) -> None:
        self.end_cell()
        if self.row is not None:
            head = bool(self.row) and (self.in_head or all(c["th"] for c in self.row))
            self.rows.append((self.section, head, self.row))
            self.row = None

    def grid(self) -> list[tuple[bool, list[str]]]:
        """Rows as texts, with cells repeated over the columns and rows they span."""
        out, below, section = [], {}, 0      # column -> (text, rows still covered)
        for at_section, head, cells in self.rows:
            if at_section != section:        # no span leaves its section
                below, section = {}, at_section
            row, queue = [], list(cells)
            while queue or any(c >= len(row) for c in below):
                at = len(row)
                if at in below:
                    text, left = below.pop(at)
                    row.append(text)
                    if left > 1:
                        below[at] = (text, left - 1)
                elif queue:
                    c = queue.pop(0)
                    for k in range(c["colspan"]):
                        if at + k in below:      # overlapping spans: the older one keeps its place
                            break
                        row.append(c["text"])
                        if c["rowspan"] > 1:
                            below[-at - k - 1] = (c["text"], c["rowspan"] - 1)
                else:
                    row.append("")
            # spans that begin in this row cover the rows below it
            for key in [k for k in below if k < 0]:
                below[-key - 1] = below.pop(key)
            out.append((head, row))
        return out


#: The largest spans that HTML knows.
_MOST = {"colspan": 1000, "rowspan": 65534}


def _span(attrs, name: str) -> int:
    """Columns or rows that a cell spans; a ``rowspan`` of 0 lasts to the end of the rows' section."""
    value = (dict(attrs).get(name) or "").strip()
    if not (value.isascii() and value.isdigit()):
        return 1
    if name == "rowspan" and int(value) == 0:
        return _MOST[name]
    return min(max(int(value), 1), _MOST[name])


class _Tables(HTMLParser):
    """Tables in the order in which they open.

    End tags of cells, rows and table sections may be left out, as HTML
    allows; a nested table is a table of its own and its text is no part of the
    cell around it. A row is a header if it lies in ``thead`` or all its cells
    are header cells.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[_Table] = []
        self._open: list[_Table] = []
        self._skip = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self._skip += 1
        if tag == "table":
            self._open.append(_Table())
            self.tables.append(self._open[-1])
            return
        if not self._open:
            return
        t = self._open[-1]
        if tag in ("thead", "tbody", "tfoot"):
            t.end_row()
            t.section += 1
            t.in_head = tag == "thead"
        elif tag == "tr":
            t.end_row()
            t.row = []
        elif tag in ("td", "th"):
            t.end_cell()
            if t.row is None:
                t.row = []
            t.cell = {"th": tag == "th", "parts": [], "colspan": _span(attrs, "colspan"),
                      "rowspan": _span(attrs, "rowspan")}
        elif tag in ("br", "p", "div", "li") and t.cell is not None:
            t.cell["parts"].append(" ")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self._skip = max(0, self._skip - 1)
        if not self._open:
            return
        t = self._open[-1]
        if tag in ("td", "th"):
            t.end_cell()
        elif tag == "tr":
            t.end_row()
        elif tag in ("thead", "tbody", "tfoot"):
            t.end_row()
            t.section += 1
            t.in_head = False
        elif tag == "table":
            t.end_row()
            self._open.pop()
            if self._open and self._open[-1].cell is not None:
                self._open[-1].cell["parts"].append(" ")

    def handle_data(self, data):
        if self._open and self._open[-1].cell is not None and not self._skip:
            self._open[-1].cell["parts"].append(data)

    def close(self):
        super().close()
        while self._open:
            self._open.pop().end_row()


def parse_tables(html: str) -> list[list[tuple[bool, list[str]]]]:
    p = _Tables()
    p.feed(html or "")
    p.close()
    return [t.grid() for t in p.tables]


def extract_tables(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One output row per table row of every page (tables numbered from 1)."""
    def run(batches):
        for pdf in batches:
            out = []
            for pid, html in zip(pdf[id_col], pdf[html_col]):
                for t_no, table in enumerate(parse_tables(html), start=1):
                    for r_no, (is_header, cells) in enumerate(table):
                        out.append((None if pd.isna(pid) else int(pid), t_no, r_no, bool(is_header),
                                    cells))
            yield pd.DataFrame(out, columns=["page_id", "table_no", "row_no", "is_header",
                                             "cells"])
    return pages.select(F.col(id_col).cast("long").alias(id_col), html_col).mapInPandas(
        run, TABLE_SCHEMA)


def table_columns(tables: DataFrame, table_no: int, names: list[str],
                  positions: list[int] | None = None,
                  headers: list[str] | None = None) -> DataFrame:
    """Body rows of table ``table_no`` of every page as named string columns.

    Columns are taken by position, or by the text of the first header row
    (the outer level of a two-level header; the first of equal texts counts).
    A row without such a cell has NULL there.
    """
    body = tables.filter((F.col("table_no") == table_no) & ~F.col("is_header"))
    if headers is None:
        positions = positions or list(range(len(names)))
        return body.select("page_id", "row_no",
                           *[F.get("cells", F.lit(p)).alias(n) for p, n in zip(positions, names)])
    head = (tables.filter((F.col("table_no") == table_no) & F.col("is_header") & (F.col("row_no") == 0))
            .select(F.col("page_id").alias("_page"), F.col("cells").alias("_head")))
    joined = body.join(head, F.col("page_id").eqNullSafe(F.col("_page")))
    return joined.select("page_id", "row_no", *[
        F.get("cells", (F.array_position("_head", h) - 1).cast("int")).alias(n)
        for h, n in zip(headers, names)])


def reference_list(tables: DataFrame, left=(2, {"code": "Code", "name_ru": "Names"}),
                   right=(1, {"code": "Code", "name_en": "Name"})) -> DataFrame:
    """Two code lists, citations stripped, blank rows dropped, joined on code.

    Each side is a table's number and, per column, the header it stands under.
    """
    def clean(table_no, columns):
        df = table_columns(tables, table_no, list(columns), headers=list(columns.values()))
        df = df.select(*[strip_citations(F.trim(F.col(c))).alias(c) for c in columns])
        keep = None
        for c in columns:
            ok = F.col(c).isNotNull() & (F.trim(F.col(c)) != "")
            keep = ok if keep is None else keep & ok
        return df.filter(keep)
    return clean(*left).join(clean(*right), "code", "inner")
