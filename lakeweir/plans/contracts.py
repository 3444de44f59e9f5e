"""Checks and column tests of the landing tables, staging views and marts."""

from __future__ import annotations

from lakeweir.operators.checks import Check, Reference, Test

HOUR, DAY = 3600, 86400

# Allowed codes.
COLORS = ("vert", "jaune", "orange", "rouge")
SEVERITIES = ("inconnu", "faible", "modere", "eleve")
CATEGORIES = ("naturel", "technologique")


def _present(*columns: str) -> list[Check]:
    return [Check(f"{c} is present", "missing_count", (c,), must=("=", 0)) for c in columns]


def _score(*columns: str) -> list[Check]:
    return [Check(f"{c} is 0 to 3", "invalid_count", (c,), must=("=", 0), valid_min=0, valid_max=3) for c in columns]


def _unique(*columns: str) -> Check:
    return Check(f"{', '.join(columns)} is unique", "duplicate_count", columns, must=("=", 0))


def _recent(must: float, warn: float | None = None, fail: float | None = None) -> Check:
    return Check(
        "extraction is recent", "freshness", ("extracted_at",), must=("<", must),
        warn=(">", warn) if warn else None, fail=(">", fail) if fail else None,
    )


def _bound(metric: str, column: str, condition: tuple) -> Check:
    return Check(f"{metric} of {column}", metric, (column,), must=condition, where=f"{column} IS NOT NULL")


_SOME_ROWS = Check("has rows", "row_count", must=(">", 0), warn=("=", 0))

TABLE_CHECKS: dict[str, list[Check]] = {
    "alerts": [
        _SOME_ROWS,
        _recent(4 * HOUR, 4 * HOUR, 8 * HOUR),
        *_present("department_code", "phenomenon_name", "color_level", "extraction_date"),
        Check("color_level is 1 to 4", "invalid_count", ("color_level",), must=("=", 0), valid_values=(1, 2, 3, 4)),
        Check("color_name is known", "invalid_count", ("color_name",), must=("=", 0), valid_values=COLORS),
        _unique("department_code", "phenomenon_id", "begin_time", "extraction_date"),
    ],
    "store_alerts": [
        _SOME_ROWS,
        _recent(4 * HOUR, 4 * HOUR, 8 * HOUR),
        *_present("gie_name", "phenomenon_name", "alert_level"),
        Check("alert_level is known", "invalid_count", ("alert_level",), must=("=", 0), valid_values=COLORS),
        _unique("gie_name", "phenomenon_name", "begin_time", "extraction_date"),
    ],
    "alert_metadata": [
        Check("all phenomena and colours", "row_count", must=(">=", 13)),
        Check("type is known", "invalid_count", ("type",), must=("=", 0), valid_values=("phenomenon", "color")),
        _unique("type", "code"),
    ],
    "commune_profiles": [
        _SOME_ROWS,
        _recent(8 * DAY, 8 * DAY, 14 * DAY),
        *_present("insee_code", "extraction_date"),
        *_score("max_severity_naturels", "max_severity_technologiques", "seisme_severity", "rga_severity"),
        _unique("insee_code", "extraction_date"),
        *[_bound("min", c, (">=", 0)) for c in ("total_risks", "naturels_count", "technologiques_count")],
    ],
    "store_risks": [
        _SOME_ROWS,
        Check("most stores are there", "row_count", must=(">=", 300), warn=("<", 300)),
        _recent(8 * DAY, 8 * DAY, 14 * DAY),
        *_present("gie_name", "insee_code"),
        *_score("max_severity_naturels"),
        _unique("gie_name", "extraction_date"),
    ],
    "risk_details": [
        Check("has rows", "row_count", must=(">", 0)),
        *_present("insee_code", "risk_key", "risk_category"),
        Check("risk_category is known", "invalid_count", ("risk_category",), must=("=", 0), valid_values=CATEGORIES),
        Check("severity_label is known", "invalid_count", ("severity_label",), must=("=", 0), valid_values=SEVERITIES),
        *_score("severity_score"),
        _unique("insee_code", "risk_key", "extraction_date"),
    ],
    "books": [
        Check("number of books", "row_count", fail=("=", 0), warn=("<", 900)),
        Check("not too many books", "row_count", must=("<", 1500)),
        *_present("upc", "title"),
        Check("category is mostly present", "missing_percent", ("category",), must=("<", 5)),
        Check("price is mostly present", "missing_percent", ("price",), must=("<", 1)),
        _unique("upc"),
        _bound("min", "price", (">=", 0)),
        _bound("max", "price", ("<=", 200)),
        _bound("min", "star_rating", (">=", 1)),
        _bound("max", "star_rating", ("<=", 5)),
        _bound("min", "stock_count", (">=", 0)),
        _recent(14 * DAY),
    ],
    "quotes": [
        Check("number of quotes", "row_count", fail=("=", 0), warn=("<", 80)),
        *_present("quote_hash", "text", "author_name"),
        _unique("quote_hash"),
        Check("length of quotes", "avg_length", ("text",), must=("between", 10, 500)),
        _recent(14 * DAY),
    ],
    "authors": [
        Check("number of authors", "row_count", fail=("=", 0), warn=("<", 30)),
        *_present("slug", "name"),
        _unique("slug"),
        _recent(14 * DAY),
    ],
}

REQUIRED_COLUMNS: dict[str, list[str]] = {
    "books": ["id", "upc", "title", "price"],
    "quotes": ["id", "quote_hash", "text", "author_name"],
    "authors": ["id", "slug", "name"],
}


def _key(*columns: str) -> list[Test]:
    return [Test(c, kind) for c in columns for kind in ("unique", "not_null")]


def _filled(*columns: str) -> list[Test]:
    return [Test(c, "not_null") for c in columns]


def _range(column: str, low: float | None = None, high: float | None = None) -> Test:
    return Test(column, "accepted_range", low=low, high=high)


# Facts and reports by the dimension that has to hold their keys.
REFERENCES = [
    Reference("fct_quotes", "author_key", "dim_authors", "author_key"),
    Reference("fct_quotes", "quote_hash", "stg_quotes", "quote_hash"),
    Reference("dim_books", "upc", "stg_books", "upc"),
    Reference("dim_communes", "insee_code", "stg_commune_profiles", "insee_code"),
    Reference("stg_risk_details", "insee_code", "stg_commune_profiles", "insee_code"),
    Reference("rpt_risk_summary", "department_code", "fct_alerts", "department_code"),
]

COLUMN_TESTS: dict[str, list[Test]] = {
    "stg_alerts": [
        *_key("alert_row_id"), *_filled("department_code", "phenomenon_name", "extraction_date"),
        _range("color_level", 0, 4),
    ],
    "stg_commune_profiles": [
        *_key("profile_row_id"), *_filled("insee_code", "total_risks", "extraction_date"), _range("total_risks", 0),
    ],
    "stg_risk_details": [
        *_key("detail_row_id"), *_filled("insee_code", "risk_key", "extraction_date"), _range("severity_score", 0, 3),
    ],
    "stg_books": [
        *_key("book_id", "upc"), *_filled("title"),
        Test("star_rating", "accepted_values", values=(1, 2, 3, 4, 5), where="star_rating is not null"),
    ],
    "stg_quotes": [*_key("quote_id", "quote_hash"), *_filled("author_name")],
    "dim_communes": [
        *_key("commune_id", "insee_code"), *_filled("department_code", "total_risks"), _range("total_risks", 0),
        _range("overall_max_severity", 0, 3),
    ],
    "fct_alerts": [
        *_key("alert_key"), *_filled("department_code", "phenomenon_name", "color_level", "extraction_date"),
        _range("color_level", 0, 4),
    ],
    "rpt_risk_summary": [
        *_key("department_code"), *_filled("monitored_communes", "active_alert_count"),
        _range("monitored_communes", 0), _range("active_alert_count", 0),
    ],
    "dim_books": [*_key("book_key", "upc"), *_filled("category")],
    "dim_authors": [*_key("author_key", "author_slug"), *_filled("author_name")],
    "fct_quotes": [*_key("quote_key", "quote_hash"), *_filled("author_key")],
    "rpt_book_stats": _key("category"),
    "rpt_quote_stats": _key("author_name"),
}
