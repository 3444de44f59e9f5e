"""Values that must not end or distort a job."""

from pyspark.sql import functions as F

from lakeweir.functions.times import epoch_millis
from lakeweir.operators.contracts import Contract, Field, validate_json
from lakeweir.operators.enrich import enrich
from lakeweir.operators.pages import book_records


def test_times_out_of_range_are_null(frame):
    df = frame("t string", ("99999999999999999",), ("-99999999999999999",), ("0",), ("x",))
    got = [r[0] for r in df.select(epoch_millis(F.col("t"))).collect()]
    assert got[:2] == [None, None] and got[2].year == 1970 and got[3] is None


def test_nan_fulfils_no_limit(frame):
    df = frame("raw string", ('{"price": "nan"}',), ('{"price": 1.5}',), ('{"price": -1}',))
    got = validate_json(df, "raw", Contract("priced", [Field("price", "float", ge=0)])).collect()
    assert [list(r.errors) for r in got] == [["price:ge"], [], ["price:ge"]]


def test_repeated_dictionary_ids_multiply_nothing(frame):
    facts = frame("id string", ("1",), (None,), ("7",))
    names = frame("code int, name string", (1, "a"), (1, "b"), (None, "c"))
    got = enrich(facts, names, F.col("id"), "code", {"name": ("name", "unknown")}).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([("1", "b"), (None, "unknown"), ("7", "unknown")], key=repr)


def test_long_page_texts_stay_whole(frame):
    page = (
        '<html><article class="product_page"><h1>{}</h1><div id="product_description"><h2>d</h2></div><p>{}</p>'
        '<table class="table table-striped"><tr><th>UPC</th><td>u1</td></tr></table></article></html>'
    ).format("t" * 700, "d" * 3000)
    pages = frame("url string, html string", ("http://x", page))
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    whole, cut = (book_records(pages, stamp, cut=c).first() for c in (None, {"title": 500}))
    assert len(whole.title) == 700 and len(cut.title) == 500
