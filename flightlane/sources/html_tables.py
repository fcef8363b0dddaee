"""Rows out of HTML pages, by regular expressions that run in the JVM.

They expect markup that closes its rows and cells and does not nest tables. Pages with a ratings table
for which that does not hold have their rows repaired first, in Arrow batches (``html_repair``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlane.fixed_values import RATING_NAME_CLASS, RATING_STARS_CLASS, RATING_TABLE_ID
from flightlane.functions.text import decode_entities, digits_to_int, strip
from flightlane.operators.reshape import explode_once, settled
from flightlane.sources.html_repair import irregular, repair

# what may stand inside an opening tag, quoted values with a '>' in them included
_PIECE = r"""(?:[^>"'\s]++|\s|"[^"]*+"|'[^']*+')"""
_INSIDE = rf"{_PIECE}*+"
_COMMENT = r"(?s)<!--.*?-->"
_TAG = rf"<[/!]?[a-zA-Z]{_INSIDE}>"


def element(tag: str, id: str | None = None, css_class: str | None = None) -> str:
    """A pattern for one element; group 1 is the inside of its opening tag, group 2 its content."""
    wanted = ""
    if id:
        wanted += rf"""(?={_PIECE}*?\sid\s*=\s*(?:"{id}"|'{id}'|{id}[\s>]))"""
    if css_class:
        words = rf"""(?:"(?:[^"]*\s)?{css_class}(?:\s[^"]*)?"|'(?:[^']*\s)?{css_class}(?:\s[^']*)?'|{css_class}[\s>])"""
        wanted += rf"(?={_PIECE}*?\sclass\s*=\s*{words})"
    return rf"(?is)<{tag}\b{wanted}({_INSIDE})>(.*?)</{tag}\s*>"


def attribute(inside: Column, name: str) -> Column:
    """An attribute's value out of the inside of an opening tag; empty when it is missing."""
    quoted = F.regexp_extract(inside, rf"""(?is)(?:^|\s){name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.regexp_replace(quoted, "^[\"']|[\"']$", "")


def without_tags(markup: Column) -> Column:
    return F.regexp_replace(markup, _TAG, "")


def without_padded_tags(markup: Column) -> Column:
    """Tags go together with the white space around them."""
    return F.regexp_replace(markup, rf"\s*{_TAG}\s*", "")


def without_comments(html: Column) -> Column:
    return F.regexp_replace(html, _COMMENT, "")


def row_fragments(region: Column, regions: list[str], row: str) -> Column:
    """The content of every ``row`` element inside the nested ``regions`` of a page without comments, in page order."""
    for pattern in regions:
        region = F.regexp_extract(region, pattern, 2)
    return F.regexp_extract_all(region, F.lit(row), F.lit(2))


def with_links(pages: DataFrame, regions: list[str], row: str, out: str = "links", html: str = "html") -> DataFrame:
    """Pages with an array of text and href: the first link of every row that has link text."""
    link = element("a")

    def read(fragment: Column) -> list[Column]:
        return [without_tags(F.regexp_extract(fragment, link, 2)), attribute(F.regexp_extract(fragment, link, 1), "href")]

    decoded = _decoded_fields(pages, row_fragments(without_comments(F.col(html)), regions, row), read, 2)
    links = F.transform(
        "_fields", lambda f, i: F.struct(i.alias("pos"), strip(f[0]).alias("text"), f[1].alias("href"))
    )
    return decoded.withColumn(out, F.filter(links, lambda r: F.length(r["text"]) > 0)).drop("_fields")


def with_ratings(pages: DataFrame, out: str = "ratings", html: str = "html") -> DataFrame:
    """Pages with an array of Airline, Stars and URL: the table rows that name an airline.

    Pages without the table are dropped before any regular expression sees them.
    """
    regions = [element("table", id=RATING_TABLE_ID), element("tbody")]
    stars_cell = element("td", css_class=RATING_STARS_CLASS)
    name_cell = element("td", css_class=RATING_NAME_CLASS)
    link = element("a")

    def read(fragment: Column) -> list[Column]:
        name = F.regexp_extract(fragment, name_cell, 2)
        return [
            without_tags(F.regexp_extract(name, link, 2)),
            without_padded_tags(F.regexp_extract(fragment, stars_cell, 2)),
            attribute(F.regexp_extract(name, link, 1), "href"),
        ]

    tables = pages.where(F.col(html).contains(RATING_TABLE_ID)).withColumn("_plain", without_comments(F.col(html)))
    tables = settled(tables, ["_plain"])
    tables = tables.withColumn("_repaired", repair(F.when(irregular(F.col("_plain")), F.col(html)), RATING_TABLE_ID))
    fragments = F.coalesce("_repaired", row_fragments(F.col("_plain"), regions, element("tr")))
    decoded = _decoded_fields(tables, fragments, read, 3).drop("_plain", "_repaired")
    ratings = F.transform(
        "_fields",
        lambda f: F.struct(
            strip(f[0]).alias("Airline"), digits_to_int(strip(f[1])).alias("Stars"), f[2].alias("URL")
        ),
    )
    return decoded.withColumn(out, F.filter(ratings, lambda r: F.length(r["Airline"]) > 0)).drop("_fields")


def _decoded_fields(
    pages: DataFrame, fragments: Column, read: Callable[[Column], list[Column]], width: int
) -> DataFrame:
    """Pages with ``_fields``: per fragment the ``width`` texts that ``read`` takes from it,
    entities decoded. All texts of a page go through the decoder together, and both they and the decoded
    ones are settled: what follows names them several times, and would run the patterns again each time."""
    raw = settled(pages.withColumn("_raw", F.transform(fragments, lambda fragment: F.array(*read(fragment)))), ["_raw"])
    flat = F.flatten("_raw")
    texts = settled(raw.withColumn("_texts", F.coalesce(decode_entities(flat), flat)), ["_texts"])
    # the lambda runs per fragment: it may only touch finished columns
    fields = F.transform("_raw", lambda _, i: F.slice("_texts", i * width + 1, F.lit(width)))
    return texts.withColumn("_fields", fields).drop("_raw", "_texts")


def extract_links(pages: DataFrame, regions: list[str], row: str, keep: list[str], html: str = "html") -> DataFrame:
    """A row per link: pos, text and href."""
    return explode_once(with_links(pages, regions, row, "_links", html), F.col("_links"), "_link", keep).select(*keep, "_link.*")


def extract_ratings(
    pages: DataFrame, html: str = "html", keep: list[str] | None = None, with_url: bool = True
) -> DataFrame:
    """A row per rated airline: Airline, Stars (or null) and URL."""
    keep = keep or []
    rows = explode_once(with_ratings(pages, "_ratings", html), F.col("_ratings"), "_rating", keep).select(*keep, "_rating.*")
    return rows if with_url else rows.drop("URL")
