"""Rows of tables whose markup leaves ends out or nests tables, as rows that close their cells."""

from __future__ import annotations

import re
import sys

from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# sent with their code, so executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.DOTALL)
_ID = re.compile(r"""(?:^|\s)id\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = ("script", "style")
#: What a tag ends that is still open, up to the table it belongs to.
ENDS = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "tbody": ("thead", "tbody", "tfoot"), "thead": ("tbody",), "tfoot": ("thead", "tbody")}
#: Tags of a nested table, which go from the cell that holds it.
_NESTED = re.compile(r"(?is)</?(?:table|thead|tbody|tfoot|tr|td|th)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>")


def repaired_rows(page: str, table_id: str) -> list[str]:
    """The rows of the first body of the table, each as cells that are closed and hold no cells.

    A new cell ends the one before, a new row its row, a new section its section, and the end of an element all
    that is open in it; an end that matches nothing in its table counts for nothing. Comments, scripts
    and styles hold no tags.
    """
    open_: list[tuple[str, int]] = []  # name and where its content begins, from the outside in
    rows: list[str] = []
    cells: list[str] = []
    wanted = body = row = cell = None  # depths of the table, its body, and the row and cell that are being read
    inside, at, done = "", 0, False

    def pop_to(depth: int, end: int) -> None:
        """Ends all elements from ``depth`` on at the place ``end`` of the page."""
        nonlocal wanted, body, row, cell, cells, done
        if cell is not None and depth <= cell:
            content = _NESTED.sub("", page[open_[cell][1]:end])
            link = "</a>" if any(name == "a" for name, _ in open_[cell:]) else ""
            cells.append(f"<td{inside}>{content}{link}</td>")
            cell = None
        if row is not None and depth <= row:
            rows.append("".join(cells))
            cells, row = [], None
        if body is not None and depth <= body:
            body, done = None, True
        if wanted is not None and depth <= wanted:
            wanted, done = None, True
        del open_[depth:]

    def last(names: tuple[str, ...]) -> int | None:
        """The innermost open element of these names that no table stands in front of."""
        for depth in range(len(open_) - 1, -1, -1):
            if open_[depth][0] in names:
                return depth
            if open_[depth][0] == "table":
                return None
        return None

    while not done and (tag := _TAG.search(page, at)):
        at, name = tag.end(), (tag.group(2) or "").lower()
        if not name:
            continue
        if tag.group(1):
            depth = last((name,))
            if depth is not None:
                pop_to(depth, tag.start())
            continue
        ended = last(ENDS[name]) if name in ENDS else last(("a",)) if name == "a" else None
        if ended is not None:
            pop_to(ended, tag.start())
        if name in VOID or tag.group(3).endswith("/"):
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b", re.IGNORECASE).search(page, at)
            at = end.start() if end else len(page)
        depth = len(open_)
        open_.append((name, tag.end()))
        if name == "table" and wanted is None and (found := _ID.search(tag.group(3))) and found.group(1).strip("\"'") == table_id:
            wanted = depth
        elif name == "tbody" and wanted is not None and body is None and last(("tbody",)) == depth and _table(open_) == wanted:
            body = depth
        elif name == "tr" and body is not None and row is None:
            row = depth
        elif name in ("td", "th") and row is not None and cell is None:
            cell, inside = depth, tag.group(3) if name == "td" else ' class=""'
    if not done:
        pop_to(0, len(page))
    return rows


def _table(open_: list[tuple[str, int]]) -> int | None:
    """The innermost open table."""
    return max((depth for depth, (name, _) in enumerate(open_) if name == "table"), default=None)


def irregular(html: Column) -> Column:
    """Whether markup without comments leaves out an end that rows need, or has more than one table."""
    def uneven(tag: str) -> Column:
        return F.regexp_count(html, F.lit(rf"(?i)<{tag}\b")) != F.regexp_count(html, F.lit(rf"(?i)</{tag}\s*>"))

    odd = F.regexp_count(html, F.lit(r"(?i)<table\b")) > 1
    for tag in ("table", "tbody", "tr", "td", "th", "a"):
        odd = odd | uneven(tag)
    return odd


def repair(html: Column, table_id: str) -> Column:
    """``repaired_rows`` of the pages; null for null."""
    import pandas as pd

    def rows(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: repaired_rows(page, table_id), na_action="ignore")

    rows.__annotations__ = {"pages": pd.Series, "return": pd.Series}
    return F.pandas_udf(rows, "array<string>")(html)
