"""HTML pages to records.

Pages are read whole, a few at once, by partition; each page's elements are picked in Python
and everything that is plain text work afterwards (prices, stock, addresses, slugs, hashes) is
column expressions. A cheap text filter drops pages without the wanted markup before Python sees
them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from itertools import islice
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lakeweir.functions import (
    absolute_url,
    captured_int,
    content_hash,
    cut_lead_in,
    first_filled,
    first_number,
    last_path_part,
    slug_from_name,
    strip_curly_quotes,
    strip_parent_steps,
    truncate,
    word_rating,
)
from lakeweir.functions.classify import RATING_WORDS
from lakeweir.operators.htmltree import Element, parse_html
from lakeweir.operators.snapshot import keep_first

BOOKS_SITE = "https://books.toscrape.com"


class Pick(NamedTuple):
    """Where a field comes from: the first element of each step within the one before, and what of it.

    A step is (tag), (tag, class), or (tag, class, attributes); a tag that begins with + is a sibling
    that follows. ``take`` is ``text``, ``texts`` (of all elements of the last step, as JSON), an
    attribute after @, ``cell`` (of the table row labelled so) or a number (that element of the
    last step, as text).
    """

    steps: tuple[tuple, ...]
    take: str | int = "text"
    label: str = ""


class Record(NamedTuple):
    """Records of a page: one per element of ``each`` (None: the page), if all ``needs`` are found and not empty."""

    each: tuple | None
    fields: dict[str, Pick]
    needs: tuple[str, ...] = ()

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} string" for name in self.fields)


# Where the pages hold what, as tag, class and attribute.
_ROWS = (("table", "table-striped"), ("tr",))
LISTING = Record(("article", "product_pod"), {
    "href": Pick((("h3",), ("a",)), "@href"), "title": Pick((("h3",), ("a",)), "@title"), "link": Pick((("h3",), ("a",)), "tag"),
}, ("link",))
BOOK = Record(None, {
    "upc": Pick(_ROWS, "cell", "UPC"), "title": Pick((("h1",),)), "excl": Pick(_ROWS, "cell", "Price (excl. tax)"),
    "incl": Pick(_ROWS, "cell", "Price (incl. tax)"), "tax_text": Pick(_ROWS, "cell", "Tax"),
    "stock": Pick(_ROWS, "cell", "Availability"), "rating": Pick((("p", "star-rating"),), "@class"),
    "category": Pick((("ul", "breadcrumb"), ("li",)), 2),
    "description": Pick((("div", None, {"id": "product_description"}), ("+p",))),
    "src": Pick((("div", "item active"), ("img",)), "@src"),
}, ("upc",))
QUOTE = Record(("div", "quote"), {
    "raw": Pick((("span", "text"),)), "author_name": Pick((("small", "author"),)),
    "href": Pick((("a", None, {"href": re.compile("/author/")}),), "@href"), "tags": Pick((("a", "tag"),), "texts"),
    "quoted": Pick((("span", "text"),), "tag"), "signed": Pick((("small", "author"),), "tag"),
}, ("quoted", "signed"))
AUTHOR = Record(None, {
    "title": Pick((("h3", "author-title"),)), "born_date": Pick((("span", "author-born-date"),)),
    "place": Pick((("span", "author-born-location"),)), "about": Pick((("div", "author-description"),)),
})


def _matching(element: Element, step: tuple) -> Iterator[Element]:
    tag, css, attributes = (*step, None, None)[:3]
    if tag.startswith("+"):
        sibling = element.next_sibling(tag[1:])
        return iter(() if sibling is None else (sibling,))
    found = element.all(tag, css)
    if not attributes:
        return found
    return (e for e in found if all(_fits(wanted, e.attrs.get(name, "")) for name, wanted in attributes.items()))


def _fits(wanted: str | re.Pattern, value: str) -> bool:
    return wanted == value if isinstance(wanted, str) else bool(wanted.search(value))


def _value(start: Element, pick: Pick) -> str | None:
    """What ``pick`` names below ``start``, None if it is not there."""
    at: Element | None = start
    for step in pick.steps[:-1]:
        at = next(_matching(at, step), None)
        if at is None:
            return None
    last = _matching(at, pick.steps[-1])
    if pick.take == "texts":
        return json.dumps([e.text() for e in last], ensure_ascii=False)
    if pick.take == "cell":
        # Of rows with the same label the last counts.
        pairs = ((row.first("th"), row.first("td")) for row in last)
        return {head.text(): cell.text() for head, cell in pairs if head and cell}.get(pick.label)
    element = next(islice(last, pick.take if isinstance(pick.take, int) else 0, None), None)
    if element is None:
        return None
    if pick.take == "tag":
        return element.tag
    return element.attrs.get(pick.take[1:]) if str(pick.take).startswith("@") else element.text()


def _picked(page: Element, record: Record) -> list[tuple]:
    rows = []
    for start in _matching(page, record.each) if record.each else (page,):
        row = {name: _value(start, pick) for name, pick in record.fields.items()}
        if all(row[name] for name in record.needs):
            rows.append(tuple(row.values()))
    return rows


# Pages that a task has opened at once at most, and bytes of their text after which it opens no more.
PAGES, PAGE_BYTES = 64, 4 << 20


def _slices(batch: pa.RecordBatch) -> Iterator[list[tuple]]:
    """Rows of a batch of pages, the text first, few at once: a worker holds Python texts of one slice only."""
    begin, held = 0, 0
    lengths = pc.fill_null(pc.binary_length(batch.column(0)), 0)
    for at, size in enumerate(lengths):
        held += size.as_py()
        if held >= PAGE_BYTES or at + 1 - begin >= PAGES or at + 1 == batch.num_rows:
            part = batch.slice(begin, at + 1 - begin)
            yield list(zip(*(column.to_pylist() for column in part.columns), strict=True))
            begin, held = at + 1, 0


def _page_rows(html: str, record: Record) -> list[tuple]:
    """Position, picked fields and error text of each record of a page."""
    try:
        page = parse_html(html)
        rows = [(i, *fields, None) for i, fields in enumerate(_picked(page, record))]
        page.release()
    except (AttributeError, ValueError, TypeError) as error:
        rows = [(0, *[None] * len(record.fields), str(error))]
    return rows


def _extract(pages: DataFrame, record: Record, carry: list[str]) -> DataFrame:
    """Rows of ``record`` per page: carried columns, position in the page, picked fields, error text.

    Spark hands over thousands of pages as one batch; they are opened and given back in slices, so that
    what a worker holds follows from the batch alone and not from the input or the records of its pages.
    """
    carried = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in carry)
    ddl = f"{carried}, position int, {record.ddl}, parse_error string"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                rows = [(*kept, *found) for html, *kept in part for found in _page_rows(html, record)]
                columns = zip(*rows, strict=True) if rows else [()] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return pages.select("html", *carry).mapInArrow(run, ddl)


def _settle(rows: DataFrame, errors: bool) -> DataFrame:
    return rows if errors else rows.where(F.col("parse_error").isNull()).drop("parse_error")


def listing_links(
    pages: DataFrame, site: str = BOOKS_SITE, *, carry: Sequence[str] = (), errors: bool = False
) -> DataFrame:
    """(page_url, position, url, title) of every product on listing pages (url, html), and ``carry`` columns."""
    marked = pages.where(F.col("html").contains("product_pod"))
    rows = _extract(marked, LISTING, ["url", *carry]).withColumns({c: F.coalesce(c, F.lit("")) for c in ("href", "title")})
    links = rows.withColumnRenamed("url", "page_url").withColumn("url", absolute_url(F.col("href"), site))
    kept = ["page_url", "position", "url", "title", *carry, "parse_error"]
    return _settle(links.select(*kept), errors)


def shortened(name: str, value: Column, cut: Mapping[str, int] | None) -> Column:
    """``value`` under ``name``, cut where the caller asks for it."""
    return (truncate(value, cut[name]) if cut and name in cut else value).alias(name)


def book_records(
    pages: DataFrame, extracted_at: Column, site: str = BOOKS_SITE, *, errors: bool = False,
    cut: Mapping[str, int] | None = None,
) -> DataFrame:
    """One book per detail page (url, html); pages without UPC give none.

    A price such as ``1.2.3`` makes the page unreadable: it gives no record, only an error.
    ``cut`` names columns with the length to cut them at; without it texts stay whole.
    """
    marked = pages.where(F.col("html").contains("table-striped"))
    rows = _extract(marked, BOOK, ["url"])
    rows = rows.withColumns({c: F.coalesce(c, F.lit("")) for c in ("title", "excl", "incl", "tax_text", "stock")})
    words = F.split("rating", r"\s+")
    word = F.get(F.filter(words, lambda w: F.lower(w).isin(*RATING_WORDS)), F.lit(0))
    price = {name: F.regexp_extract(text, r"[\d.]+", 0) for name, text in [("price", "excl"), ("price_incl_tax", "incl"), ("tax", "tax_text")]}
    unreadable = F.lit(False)
    for text in price.values():
        unreadable = unreadable | ((text != "") & text.try_cast("double").isNull())
    records = rows.select(
        "upc",
        shortened("title", F.col("title"), cut),
        *[first_number(F.col(c)).alias(name) for name, c in [("price", "excl"), ("price_incl_tax", "incl"), ("tax", "tax_text")]],
        shortened("availability", F.col("stock"), cut),
        captured_int(F.col("stock"), r"\((\d+) available\)").alias("stock_count"),
        word_rating(word).alias("star_rating"),
        "category",
        shortened("description", F.col("description"), cut),
        F.concat(F.lit(f"{site}/"), strip_parent_steps(F.col("src"))).alias("image_url"),
        F.col("url").alias("product_url"),
        extracted_at.alias("extracted_at"),
        extracted_at.cast("date").alias("extraction_date"),
        F.coalesce("parse_error", F.when(unreadable, F.lit("price is no number"))).alias("parse_error"),
    )
    return _settle(records, errors)


def quote_records(
    pages: DataFrame, extracted_at: Column, *, carry: Sequence[str] = (), errors: bool = False
) -> DataFrame:
    """Every quote of quote pages (url, html), with its hash, and ``carry`` columns.

    The slug comes from the author link, else from the name.
    """
    marked = pages.where(F.col("html").contains("quote"))
    rows = _extract(marked, QUOTE, ["url", *carry])
    text = strip_curly_quotes(F.col("raw"))
    from_name = F.nullif(slug_from_name(F.col("author_name")), F.lit(""))
    records = rows.select(
        F.col("url").alias("page_url"),
        "position",
        content_hash(text, F.col("author_name")).alias("quote_hash"),
        text.alias("text"),
        "author_name",
        F.coalesce(last_path_part(F.col("href"), "author"), from_name).alias("author_slug"),
        "tags",
        extracted_at.alias("extracted_at"),
        extracted_at.cast("date").alias("extraction_date"),
        *carry,
        "parse_error",
    )
    return _settle(records, errors)


def author_records(
    pages: DataFrame, extracted_at: Column, *, errors: bool = False, cut: Mapping[str, int] | None = None
) -> DataFrame:
    """One author per page (slug, html). ``cut`` names columns with the length to cut them at."""
    rows = _extract(pages, AUTHOR, ["slug"])
    place = cut_lead_in(F.col("place"))
    records = rows.select(
        "slug",
        shortened("name", F.coalesce("title", "slug"), cut),
        "born_date",
        shortened("born_location", first_filled(place, F.lit("")), cut),
        shortened("description", F.col("about"), cut),
        extracted_at.alias("extracted_at"),
        extracted_at.cast("date").alias("extraction_date"),
        "parse_error",
    )
    return _settle(records, errors)


def land_books(listings: DataFrame, details: DataFrame, extracted_at: Column, *, errors: bool = False) -> DataFrame:
    """Listing and detail pages to unique books: the first link per address, the first record per UPC.

    ``listings`` has a page number ``page_no``; listing order decides which record is first. With
    ``errors`` detail pages that could not be read are rows too, each with its ``parse_error``.
    """
    found = listing_links(listings, carry=["page_no"])
    links = keep_first(found, ["url"], ["page_no", "position"]).select("url", "page_no", "position")
    records = book_records(details, extracted_at, errors=errors)
    ordered = records.join(links, F.col("product_url") == F.col("url")).drop("url")
    return _first_records(ordered, ["upc"], ["page_no", "position"], ["product_url"]).drop("page_no", "position")


def _first_records(rows: DataFrame, keys: list[str], order: list[str], page: list[str]) -> DataFrame:
    """The first record per key in one pass; rows of pages that failed have no key and count per page."""
    if "parse_error" not in rows.columns:
        return keep_first(rows, keys, order)
    failed = F.col("parse_error").isNotNull()
    marked = rows.withColumn("__failed", F.when(failed, F.concat_ws("|", *page)))
    return keep_first(marked, [*keys, "__failed"], order).drop("__failed")


def land_quotes(pages: DataFrame, extracted_at: Column, *, errors: bool = False) -> DataFrame:
    """Quote pages with a page number ``page_no`` to unique quotes, the first by page and position.

    With ``errors`` pages that could not be read are rows too, each with its ``parse_error``.
    Quotes are told apart by text and author; the short hash alone would join some in very large sets.
    """
    rows = quote_records(pages, extracted_at, carry=["page_no"], errors=errors)
    first = _first_records(rows, ["quote_hash", "text", "author_name"], ["page_no", "position"], ["page_url"])
    return first.drop("page_no", "position", *(() if errors else ("page_url",)))
