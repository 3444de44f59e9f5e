from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeweir.operators import pages
from lakeweir.operators.htmltree import parse_html
from tests.conftest import rows



def stamp():
    return F.lit(datetime(2024, 1, 7, 3)).cast("timestamp_ntz")


DETAIL = """<!DOCTYPE html><html><!-- <h1>no</h1> --><head><script>if (a < b) { "<h1>no</h1>" }</script></head><body>
<ul class="breadcrumb"><li><a href="/">Home</a><li>Books</li><li> <a href="x">Sci-Fi</a> </li></ul>
<div class="item active"><img src="../../media/c.jpg" alt='a "b"'/></div>
<h1>It&rsquo;s <b>A</b> Title</h1><p class="star-rating Three"></p>
<div id="product_description"><h2>D</h2></div><span></span><p>Long&nbsp;text &amp; more</p>
<table class="table table-striped"><tr><th>UPC</th><td>a897</td></tr><tr><th>Price (excl. tax)<td>£51.77
<tr><th>Price (incl. tax)</th><td>£53.00</td></tr><tr><th>Tax</th><td>£0.00</td></tr>
<tr><th>Availability</th><td>In stock (22 available)</td></tr></table></body></html>"""


@pytest.mark.parametrize(
    "html, tag, want",
    [
        ("<p>a<p>b", "p", ["a", "b"]),
        ("<ul><li>a<ul><li>x</ul><li>b</ul>", "li", ["ax", "x", "b"]),
        ("<b>x</i>y</b>z", "b", ["xy"]),
        ("<div><b>open", "b", ["open"]),
        ("<title>a <b> c</title><b>d</b>", "b", ["d"]),
        ("1 < 2 <b>é&eacute;</b> <", "b", ["éé"]),
        ("<b title='a>b'>q</b>", "b", ["q"]),
        ("<B CLASS=x>q</B>", "b", ["q"]),
        ("<b", "b", []),
        ("<!-- open <b>x</b>", "b", []),
    ],
)
def test_tree(html, tag, want):
    assert [e.text() for e in parse_html(html).all(tag)] == want


def test_attributes():
    element = parse_html("<a href=/x/ class='p  q' title=\"a&amp;b\" hidden TITLE=z>t</a>").first("a", "q")
    assert element.attrs == {"href": "/x/", "class": "p  q", "title": "a&b", "hidden": ""}
    assert parse_html("<a class='p  q'>").first("a", "p q") is not None


def test_book(frame):
    cases = {
        "ok": DETAIL,
        "no_upc": DETAIL.replace("a897", ""),
        "odd_price": DETAIL.replace("51.77", "1.2.3"),
        "bare": "<table class='table-striped'><tr><th>UPC</th><td>zz</td></tr></table>",
        "other": "<h1>x</h1>",
    }
    df = frame("url string, html string", *cases.items())
    got = {r["product_url"]: r.asDict() for r in pages.book_records(df, stamp(), "https://b").collect()}
    assert set(got) == {"ok", "bare"}
    want = dict(
        upc="a897", title="It’sATitle", price=51.77, price_incl_tax=53.0, tax=0.0, availability="In stock (22 available)",
        stock_count=22, star_rating=3, category="Sci-Fi", description="Long text & more", image_url="https://b/media/c.jpg",
        extracted_at=datetime(2024, 1, 7, 3),
    )
    assert {k: got["ok"][k] for k in want} == want
    bare = got["bare"]
    assert (bare["title"], bare["price"], bare["stock_count"], bare["star_rating"], bare["category"], bare["image_url"]) == ("", None, 0, None, None, None)
    errors = pages.book_records(df, stamp(), errors=True).where("parse_error is not null")
    assert [r["product_url"] for r in errors.collect()] == ["odd_price"]


def test_quotes_and_authors(frame):
    html = """<div class="quote"><span class="text">“A “b” c”</span><small class="author">J. K. R</small>
      <a href="http://q/author/J-K-R/x">about</a><a class="tag">é</a><a class="tag"> y </a></div>
      <div class="quote"><span class="text">no author</span></div>
      <div class="quote"><span class="text">“t”</span><small class="author">Dr. No</small></div>"""
    got = pages.quote_records(frame("url string, html string", ("u", html)), stamp()).orderBy("position").collect()
    assert [(r["text"], r["author_slug"], r["tags"]) for r in got] == [("A “b” c", "J-K-R", '["é", "y"]'), ("t", "Dr-No", "[]")]
    authors = frame(
        "slug string, html string",
        ("a", "<h3 class='author-title'>Ann </h3><span class=author-born-location>in Ulm</span><div class=author-description> x </div>"),
        ("b", "<p>nothing</p>"),
    )
    got = pages.author_records(authors, stamp()).select("slug", "name", "born_date", "born_location", "description")
    assert rows(got) == [("a", "Ann", None, "Ulm", "x"), ("b", "b", None, "", None)]


def test_landing_keeps_first(frame):
    item = '<article class="product_pod"><h3><a href="{}" title="{}">t</a></h3></article>'
    listings = frame(
        "page_no int, url string, html string",
        (1, "l1", item.format("catalogue/a", "A") + item.format("catalogue/b", "B")), (2, "l2", item.format("a", "again") + item.format("../c", "C")),
    )
    details = frame("url string, html string", *[(f"https://books.toscrape.com/catalogue/{n}", DETAIL.replace("a897", upc)) for n, upc in [("a", "one"), ("b", "two"), ("c", "one")]])
    got = pages.land_books(listings, details, stamp())
    assert rows(got.select("upc", "product_url")) == [("one", "https://books.toscrape.com/catalogue/a"), ("two", "https://books.toscrape.com/catalogue/b")]
    quote = '<div class="quote"><span class="text">“{}”</span><small class="author">X</small></div>'
    quotes = frame("page_no int, url string, html string", (1, "p1", quote.format("q") * 2), (2, "p2", quote.format("q") + quote.format("r")))
    assert rows(pages.land_quotes(quotes, stamp()).select("text")) == [("q",), ("r",)]


def test_pages_are_opened_in_slices():
    """A batch of thousands of pages is opened a few pages at once, and large pages fewer at once."""
    import pyarrow as pa

    texts = ["a" * 10] * 1000 + ["é" * pages.PAGE_BYTES, None, "b"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(1003))], names=["html", "page_no"])
    parts = list(pages._slices(batch))
    assert [row for part in parts for row in part] == list(zip(texts, range(1003)))
    assert max(len(part) for part in parts) == pages.PAGES and len(parts) == 17
    assert [len(part) for part in pages._slices(batch.slice(1000))] == [1, 2]


def test_pages_give_the_same_rows_in_any_slices(frame, monkeypatch):
    quote = '<div class="quote"><span class="text">“{}”</span><small class="author">X</small></div>'
    cases = [(f"u{i}", quote.format(f"é{i}") * (i % 4), None if i == 3 else i) for i in range(40)] + [("none", None, 7)]
    got = {}
    for size in (1, 64):
        monkeypatch.setattr(pages, "PAGES", size)
        found = pages._extract(frame("url string, html string, page_no bigint", *cases).coalesce(1), pages.QUOTE, ["url", "page_no"])
        got[size] = rows(found.select("url", "page_no", "position", "raw", "parse_error"))
    want = [(u, n, k, f"“é{u[1:]}”", None) for u, html, n in cases if html is not None for k in range(html.count("quote"))]
    assert got[1] == got[64] == sorted([*want, ("none", 7, 0, None, got[1][0][4])], key=repr)
    assert "NoneType" in next(r[4] for r in got[1] if r[0] == "none")


def test_released_page_leaves_no_cycle():
    import gc
    import weakref

    class Held(str):
        pass

    page = parse_html("<div><p>a</p><p>b</p></div>")
    text = Held("x")
    page.first("p").children.append(text)
    seen = weakref.ref(text)
    gc.disable()
    try:
        page.release()
        del page, text
        assert seen() is None
    finally:
        gc.enable()
