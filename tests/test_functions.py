from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakeweir import functions as X


def one(frame, value, expression, ddl="x string"):
    return frame(ddl, (value,)).select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, want",
    [("sci-fi & women's", "Sci-Fi & Women'S"), ("ÉCOLE 2nd", "École 2nd"), ("", ""), (None, None), ("  a", "  A")],
)
def test_title_case(frame, text, want):
    assert one(frame, text, X.title_case) == want


def test_clean_keeps_tabs_and_hard_spaces(frame):
    assert one(frame, " \t a  ", X.clean) == "\t a "


@pytest.mark.parametrize(
    "text, want",
    [
        ("Risque Important", ("eleve", 3)), ("ÉLEVÉ", ("eleve", 3)), ("eleve", ("eleve", 3)),
        ("Modéré", ("modere", 2)), ("moyen", ("modere", 2)), ("faible", ("faible", 1)),
        ("Existant", ("faible", 1)), ("inexistant", ("faible", 1)), ("autre", ("inconnu", 0)),
        ("", ("inconnu", 0)), (None, ("inconnu", 0)), ("faible et important", ("eleve", 3)),
    ],
)
def test_severity(frame, text, want):
    assert tuple(one(frame, text, X.severity)) == want


@pytest.mark.parametrize("value, digits, want", [(2.0449, 2, 2.05), (2.0444, 2, 2.04), (0.1249, 1, 0.1), (None, 1, None)])
def test_rounding_twice(frame, value, digits, want):
    got = one(frame, value, lambda c: X.rounded_decimal(c, digits), "x double")
    assert (None if got is None else float(got)) == want


@pytest.mark.parametrize("value, want", [(0.125, "0.12"), (0.135, "0.14"), (1234.5, "1234.50"), (-3.005, "-3.00")])
def test_fixed_text_is_python_rounding(frame, value, want):
    assert want == f"{value:.2f}"
    assert one(frame, value, X.fixed_text, "x double") == want


def test_bands_and_flags(frame):
    limits = [(15, "low"), (35, "mid")]
    for value, want in [(14.9, "low"), (15.0, "mid"), (35.0, "top"), (None, "top")]:
        assert one(frame, value, lambda c: X.band(c, limits, "top"), "x double") == want
    stars = [(4, "good"), (2, "fair")]
    for value, want in [(4, "good"), (3, "fair"), (1, "poor"), (None, "poor")]:
        assert one(frame, value, lambda c: X.band(c, stars, "poor", at_least=True), "x int") == want
    assert [one(frame, v, X.flag_positive, "x int") for v in (1, 0, None)] == [True, False, False]


def test_keys(frame):
    df = frame("a string, b int", ("x", None), (None, None))
    keys = [r[0] for r in df.select(X.surrogate_key(F.col("a"), F.col("b"))).collect()]
    import hashlib

    token = "_dbt_utils_surrogate_key_null_"
    assert keys == [hashlib.md5(f"{a}-{token}".encode()).hexdigest() for a in ("x", token)]
    got = frame("a string, b string", ("t", "u")).select(X.content_hash(F.col("a"), F.col("b"))).first()[0]
    assert got == hashlib.sha256(b"t|u").hexdigest()[:16]


def test_times(frame):
    assert one(frame, "1500", X.epoch_millis) == datetime(1970, 1, 1, 0, 0, 1, 500000)
    assert one(frame, "", X.epoch_millis) is None
    df = frame("a timestamp_ntz, b timestamp_ntz", (datetime(2024, 1, 1), datetime(2024, 1, 1, 1, 0, 0, 1)))
    assert df.select(X.hours_between(F.col("a"), F.col("b"))).first()[0] == (3600 + 1e-6) / 3600
    parts = X.date_parts(F.col("x"), F.lit("2020-02-03").cast("date"))
    for text, want in [("2026-06-02T10:00", ("2026", "06", "02")), ("bad", ("2020", "02", "03")), (None, ("2020", "02", "03"))]:
        assert tuple(frame("x string", (text,)).select(*parts.values()).first()) == want
    assert one(frame, date(2024, 1, 1), lambda c: X.age_in_days(F.lit("2024-01-04").cast("date"), c), "x date") == 3


def test_small_text_helpers(frame):
    assert one(frame, "“hi”", X.strip_curly_quotes) == "hi"
    assert one(frame, "in Ulm", X.cut_lead_in) == "Ulm"
    assert one(frame, "J. K. Rowling", X.slug_from_name) == "J-K-Rowling"
    assert one(frame, "£51.77", X.first_number) == 51.77
    assert one(frame, "none", X.first_number) is None
    assert one(frame, "In stock (22 available)", lambda c: X.captured_int(c, r"\((\d+) available\)")) == 22
    assert one(frame, "Out", lambda c: X.captured_int(c, r"\((\d+) available\)")) == 0
    assert one(frame, "/author/Jane/", lambda c: X.last_path_part(c, "author")) == "Jane"
    assert one(frame, "12", X.digits_or_zero) == 12
    assert one(frame, "1.5", X.digits_or_zero) == 0
    assert one(frame, "Three", X.word_rating) == 3
    assert one(frame, "Ten", X.word_rating) is None
    for href, want in [("catalogue/a", "s/catalogue/a"), ("../../b", "s/catalogue/b"), ("c", "s/catalogue/c")]:
        assert one(frame, href, lambda c: X.absolute_url(c, "s")) == want
    assert frame("a string, b string", ("", "z"), (None, None)).select(X.first_filled(F.col("a"), F.col("b"))).collect() == [("z",), (None,)]


def test_ratio_and_clamp(frame):
    df = frame("a int, b int", (1, 2), (1, 0), (1, None))
    assert [r[0] for r in df.select(X.guarded_ratio(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0, 0.0]
    assert [one(frame, v, X.clamp, "x double") for v in (-1.0, 0.5, 2.0)] == [0.0, 0.5, 1.0]
