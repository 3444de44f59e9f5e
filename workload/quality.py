"""Contracts, checks, tests, gates, density, anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.operators import anomaly, checks, contracts, density, health
from lakeweir.plans import marts, staging
from lakeweir.plans.contracts import COLUMN_TESTS, REFERENCES, TABLE_CHECKS
from workload import models
from workload.models import (
    DIM_AUTHORS,
    DIM_BOOKS,
    DIM_COMMUNES,
    FCT_ALERTS,
    FCT_QUOTES,
    STG_DETAILS,
    STG_PROFILES,
    STG_QUOTES,
)
from workload.registry import SQL, query
from workload.tables import ALERTS, AUTHORS, BOOKS, DETAILS, METRICS, PROFILES, QUOTES, Tables, spread

BOOK = contracts.CONTRACTS["book"]

# Raw book records: JSON objects with missing, mistyped and extra fields, by part key and size.


def _raw_books(t: Tables) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")

    def text(c):
        return F.concat(F.lit('"'), c, F.lit('"'))

    fields = [
        ("upc", text(key.cast("string"))),
        ("title", F.when(key % 13 == 0, key.cast("string")).otherwise(text(F.col("p_name")))),
        ("category", F.when(size == 7, F.lit("null")).otherwise(text(F.col("p_type")))),
        ("star_rating", F.when(size == 9, F.lit("3.7")).when(size == 10, F.lit('"4"')).when(size == 11, F.lit("2.0")).otherwise((key % 6).cast("string"))),
        ("price", F.when(size == 12, F.lit('"12.50"')).when(size == 13, F.lit('"cheap"')).when(size == 14, F.lit("-1")).otherwise((size * 1.5).cast("string"))),
        ("price_incl_tax", (size * 1.75).cast("string")),
        ("tax", F.when(size == 15, F.lit("true")).otherwise(F.lit("0"))),
        ("availability", F.lit('"In stock"')),
        ("stock_count", F.when(size == 16, F.lit("-3")).otherwise((key % 23).cast("string"))),
        ("image_url", F.lit('"i"')),
        ("product_url", F.lit('"p"')),
        ("extraction_date", F.lit('"2024-01-07"')),
    ]
    body = [F.concat(F.lit(f'"{n}":'), v) for n, v in fields]
    body.append(F.when(size != 17, F.lit('"extracted_at":"2024-01-07T03:00:00"')))
    body.append(F.when(size == 18, F.concat(F.lit('"brand":'), text(F.col("p_brand")), F.lit(',"size":18'))))
    body.append(F.when(size == 19, F.lit('"shelf":{"row":[1,2]}')))
    record = F.concat(F.lit("{"), F.concat_ws(",", *body), F.lit("}"))
    broken = F.when(size == 20, F.lit("[1, 2]")).when(size == 21, F.lit("{bad")).otherwise(record)
    return spread(t.part).select("p_partkey", broken.alias("record"))


RAW_BOOKS = """
b AS (SELECT *, p_size IN (20, 21) AS bad FROM part),
r AS (SELECT p_partkey, p_size, p_brand, bad,
   CASE WHEN bad THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS upc,
   CASE WHEN bad OR p_partkey % 13 = 0 THEN NULL ELSE p_name END AS title,
   CASE WHEN bad OR p_size = 7 THEN NULL ELSE p_type END AS category,
   CASE WHEN bad OR p_size = 9 THEN NULL WHEN p_size = 10 THEN 4 WHEN p_size = 11 THEN 2 ELSE p_partkey % 6 END AS star_rating,
   CASE WHEN bad OR p_size = 13 THEN NULL WHEN p_size = 12 THEN 12.5 WHEN p_size = 14 THEN -1.0 ELSE p_size * 1.5 END::DOUBLE AS price,
   CASE WHEN bad THEN NULL ELSE p_size * 1.75 END::DOUBLE AS price_incl_tax,
   CASE WHEN bad THEN NULL WHEN p_size = 15 THEN 1 ELSE 0 END::DOUBLE AS tax,
   CASE WHEN bad THEN NULL WHEN p_size = 16 THEN -3 ELSE p_partkey % 23 END AS stock_count FROM b),
v AS (SELECT *, list_filter([
   CASE WHEN bad THEN 'record:not_an_object' END,
   CASE WHEN length(upc) < 2 THEN 'upc:min_length' END,
   CASE WHEN NOT bad AND title IS NULL THEN 'title:type' END,
   CASE WHEN NOT bad AND category IS NULL THEN 'category:type' END,
   CASE WHEN NOT bad AND star_rating IS NULL THEN 'star_rating:type' END,
   CASE WHEN star_rating < 1 THEN 'star_rating:ge' END,
   CASE WHEN star_rating > 5 THEN 'star_rating:le' END,
   CASE WHEN NOT bad AND price IS NULL THEN 'price:type' END,
   CASE WHEN price < 0 THEN 'price:ge' END,
   CASE WHEN stock_count < 0 THEN 'stock_count:ge' END,
   CASE WHEN p_size = 17 THEN 'extracted_at:missing' END], lambda x: x IS NOT NULL) AS errors FROM r)"""


def _validated(t: Tables) -> DataFrame:
    return contracts.validate_json(_raw_books(t), "record", BOOK)


@query(
    f"""WITH {RAW_BOOKS}
    SELECT p_partkey, upc, title, category, star_rating, price, price_incl_tax, tax, stock_count,
           CASE WHEN p_size = 18 THEN '{{"brand":"' || p_brand || '","size":18}}'
                WHEN p_size = 19 THEN '{{"shelf":{{"row":[1,2]}}}}' END AS metadata_json,
           array_to_string(errors, ',') AS errors FROM v"""
)
def validate_books(t: Tables) -> DataFrame:
    columns = "p_partkey upc title category star_rating price price_incl_tax tax stock_count metadata_json".split()
    return _validated(t).select(*columns, F.array_join("errors", ",").alias("errors"))


@query(
    f"""WITH {RAW_BOOKS}
    SELECT 'books' AS pipeline, count(*) AS total_records, count(*) FILTER (WHERE len(errors) = 0) AS valid_records,
           count(*) FILTER (WHERE len(errors) > 0) AS error_records,
           count(*) FILTER (WHERE len(errors) = 0) / count(*) AS pass_rate FROM v"""
)
def validation_summary(t: Tables) -> DataFrame:
    return contracts.pass_rate(_validated(t), "books")


@query(f"WITH {RAW_BOOKS} SELECT rule, count(*) AS n FROM (SELECT unnest(errors) AS rule FROM v) GROUP BY rule")
def validation_errors(t: Tables) -> DataFrame:
    return contracts.error_summary(_validated(t))


@query(
    """SELECT CASE p_size WHEN 18 THEN 'brand,size' ELSE 'shelf' END AS extra_fields, 'description' AS missing_fields,
           count(*) AS records FROM part WHERE p_size IN (18, 19) GROUP BY p_size"""
)
def schema_drift(t: Tables) -> DataFrame:
    drift = contracts.schema_drift(_raw_books(t), "record", BOOK)
    return drift.withColumns({c: F.array_join(c, ",") for c in ("extra_fields", "missing_fields")})



@query(
    f"""WITH {ALERTS}
    SELECT department_code, phenomenon_name, color_level, errors, count(*) AS n FROM (
      SELECT department_code, phenomenon_name, CAST(color_level AS BIGINT) AS color_level,
             concat_ws(',', CASE WHEN department_code IS NULL THEN 'department_code:type' END,
                       CASE WHEN color_level IS NULL THEN 'color_level:type' END) AS errors FROM alerts)
    GROUP BY ALL"""
)
def validate_alert_rows(t: Tables) -> DataFrame:
    checked = contracts.validate_columns(t.alerts, contracts.CONTRACTS["alert"])
    return (
        checked.withColumn("errors", F.array_join("errors", ","))
        .groupBy("department_code", "phenomenon_name", "color_level", "errors")
        .agg(F.count("*").alias("n"))
    )


# Checks: one row per check. The SQL states each check's metric and limits on its own.

BOOK_AS_OF = "TIMESTAMP '2024-01-20 00:00:00'"


def _check_sql(ctes: str, rows: list[tuple[str, str, str, str]]) -> str:
    """``rows``: (name, metric, value SQL, outcome SQL over ``v``)."""
    selects = [
        f"SELECT '{name}' AS check_name, '{metric}' AS metric, CAST(v AS DOUBLE) AS value, {outcome} AS outcome FROM ({value}) s(v)"
        for name, metric, value, outcome in rows
    ]
    return f"WITH {ctes} " + " UNION ALL ".join(selects)


def _zero(name, metric, value):
    return (name, metric, value, "CASE WHEN v = 0 THEN 'pass' ELSE 'fail' END")


def _absent(table, *columns):
    return [_zero(f"{c} is present", "missing_count", f"SELECT count(*) FILTER (WHERE {c} IS NULL) FROM {table}") for c in columns]


def _repeated(table, *columns):
    keys = ", ".join(columns)
    known = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    value = f"SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {known} GROUP BY {keys} HAVING count(*) > 1)"
    return _zero(f"{keys} is unique", "duplicate_count", value)


def _odd(name, table, condition):
    return _zero(name, "invalid_count", f"SELECT count(*) FILTER (WHERE {condition}) FROM {table}")


def _limit(metric, table, column, condition):
    value = f"SELECT {metric}({column}) FROM {table} WHERE {column} IS NOT NULL"
    return (f"{metric} of {column}", metric, value, f"CASE WHEN v IS NULL THEN 'not_evaluated' WHEN v {condition} THEN 'pass' ELSE 'fail' END")


def _fresh(table, as_of, must=None, warn=None, fail=None):
    value = f"SELECT epoch({as_of} - max(extracted_at)) FROM {table}"
    tiers = f"WHEN v > {fail} THEN 'fail' WHEN v > {warn} THEN 'warn' ELSE 'pass'" if fail else f"WHEN v < {must} THEN 'pass' ELSE 'fail'"
    return ("extraction is recent", "freshness", value, f"CASE WHEN v IS NULL THEN 'fail' {tiers} END")


_ROWS = ("has rows", "row_count", "SELECT count(*) FROM {0}", "CASE WHEN v = 0 THEN 'warn' ELSE 'pass' END")


def _has_rows(table):
    name, metric, value, outcome = _ROWS
    return (name, metric, value.format(table), outcome)


HOUR, DAY = 3600, 86400


@query(
    _check_sql(
        ALERTS,
        [
            _has_rows("alerts"),
            _fresh("alerts", "TIMESTAMP '2024-01-31 05:00:00'", warn=4 * HOUR, fail=8 * HOUR),
            *_absent("alerts", "department_code", "phenomenon_name", "color_level", "extraction_date"),
            _odd("color_level is 1 to 4", "alerts", "color_level NOT IN (1, 2, 3, 4)"),
            _odd("color_name is known", "alerts", "color_name NOT IN ('vert', 'jaune', 'orange', 'rouge')"),
            _repeated("alerts", "department_code", "phenomenon_id", "begin_time", "extraction_date"),
        ],
    )
)
def contract_alerts(t: Tables) -> DataFrame:
    as_of = F.lit("2024-01-31 05:00:00").cast("timestamp_ntz")
    return checks.run_checks(t.alerts, TABLE_CHECKS["alerts"], as_of)


def _three(*columns):
    return [_odd(f"{c} is 0 to 3", "commune_profiles", f"{c} NOT BETWEEN 0 AND 3") for c in columns]


@query(
    _check_sql(
        PROFILES,
        [
            _has_rows("commune_profiles"),
            _fresh("commune_profiles", "TIMESTAMP '2001-01-11 00:00:00'", warn=8 * DAY, fail=14 * DAY),
            *_absent("commune_profiles", "insee_code", "extraction_date"),
            *_three("max_severity_naturels", "max_severity_technologiques", "seisme_severity", "rga_severity"),
            _repeated("commune_profiles", "insee_code", "extraction_date"),
            *[_limit("min", "commune_profiles", c, ">= 0") for c in ("total_risks", "naturels_count", "technologiques_count")],
        ],
    )
)
def contract_profiles(t: Tables) -> DataFrame:
    as_of = F.lit("2001-01-11 00:00:00").cast("timestamp_ntz")
    return checks.run_checks(t.commune_profiles, TABLE_CHECKS["commune_profiles"], as_of)


@query(
    _check_sql(
        DETAILS,
        [
            ("has rows", "row_count", "SELECT count(*) FROM risk_details", "CASE WHEN v > 0 THEN 'pass' ELSE 'fail' END"),
            *_absent("risk_details", "insee_code", "risk_key", "risk_category"),
            _odd("risk_category is known", "risk_details", "risk_category NOT IN ('naturel', 'technologique')"),
            _odd("severity_label is known", "risk_details", "severity_label NOT IN ('inconnu', 'faible', 'modere', 'eleve')"),
            _odd("severity_score is 0 to 3", "risk_details", "severity_score NOT BETWEEN 0 AND 3"),
            _repeated("risk_details", "insee_code", "risk_key", "extraction_date"),
        ],
    )
)
def contract_risks(t: Tables) -> DataFrame:
    return checks.run_checks(t.risk_details, TABLE_CHECKS["risk_details"])


def _percent(name, column, limit):
    value = f"SELECT count(*) FILTER (WHERE {column} IS NULL) * 100.0::DOUBLE / count(*) FROM books"
    return (name, "missing_percent", value, f"CASE WHEN v < {limit} THEN 'pass' ELSE 'fail' END")


@query(
    _check_sql(
        BOOKS,
        [
            ("number of books", "row_count", "SELECT count(*) FROM books", "CASE WHEN v = 0 THEN 'fail' WHEN v < 900 THEN 'warn' ELSE 'pass' END"),
            ("not too many books", "row_count", "SELECT count(*) FROM books", "CASE WHEN v < 1500 THEN 'pass' ELSE 'fail' END"),
            *_absent("books", "upc", "title"),
            _percent("category is mostly present", "category", 5),
            _percent("price is mostly present", "price", 1),
            _repeated("books", "upc"),
            _limit("min", "books", "price", ">= 0"),
            _limit("max", "books", "price", "<= 200"),
            _limit("min", "books", "star_rating", ">= 1"),
            _limit("max", "books", "star_rating", "<= 5"),
            _limit("min", "books", "stock_count", ">= 0"),
            _fresh("books", BOOK_AS_OF, must=14 * DAY),
        ],
    )
)
def contract_books(t: Tables) -> DataFrame:
    return checks.run_checks(t.books, TABLE_CHECKS["books"], F.lit("2024-01-20").cast("timestamp_ntz"))


@query(
    _check_sql(
        f"{QUOTES}, {AUTHORS}",
        [
            ("number of quotes", "row_count", "SELECT count(*) FROM quotes", "CASE WHEN v = 0 THEN 'fail' WHEN v < 80 THEN 'warn' ELSE 'pass' END"),
            *_absent("quotes", "quote_hash", "text", "author_name"),
            _repeated("quotes", "quote_hash"),
            ("length of quotes", "avg_length", "SELECT avg(length(text)) FROM quotes", "CASE WHEN v BETWEEN 10 AND 500 THEN 'pass' ELSE 'fail' END"),
            _fresh("quotes", "TIMESTAMP '2024-02-20 00:00:00'", must=14 * DAY),
            ("number of authors", "row_count", "SELECT count(*) FROM authors", "CASE WHEN v = 0 THEN 'fail' WHEN v < 30 THEN 'warn' ELSE 'pass' END"),
            *_absent("authors", "slug", "name"),
            _repeated("authors", "slug"),
            _fresh("authors", "TIMESTAMP '2024-02-20 00:00:00'", must=14 * DAY),
        ],
    )
)
def contract_quotes(t: Tables) -> DataFrame:
    as_of = F.lit("2024-02-20").cast("timestamp_ntz")
    quotes = checks.run_checks(t.quotes, TABLE_CHECKS["quotes"], as_of)
    return quotes.unionByName(checks.run_checks(t.authors, TABLE_CHECKS["authors"], as_of))


_PROPS = [
    checks.Check("props look like JSON", "failed_rows", must=("=", 0), condition=r"NOT props RLIKE '^[{\\[].*[}\\]]$'"),
    checks.Check("value is mostly small", "invalid_percent", ("value",), must=("<", 1), valid_max=300),
    checks.Check("key is short", "invalid_count", ("props",), must=("=", 0), valid_regex=r'^\{"k": [0-9]{1,2}\}$'),
    checks.Check("mean value", "avg", ("value",), must=("between", 1, 40), where="event_type <> 'error'"),
    checks.Check("enough rows", "row_count", must=("between", 100, 10000000), warn=("<", 1000)),
]


@query(
    r"""WITH s AS (SELECT
      count(*) FILTER (WHERE NOT regexp_matches(props, '^[{\[].*[}\]]$')) AS a,
      count(*) FILTER (WHERE value > 300) * 100.0::DOUBLE / count(*) AS b,
      count(*) FILTER (WHERE NOT regexp_matches(props, '^\{"k": [0-9]{1,2}\}$')) AS c,
      sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type <> 'error') / count(*) FILTER (WHERE event_type <> 'error') AS d,
      count(*) AS e FROM events)
    SELECT 'props look like JSON' AS check_name, 'failed_rows' AS metric, CAST(a AS DOUBLE) AS value,
           CASE WHEN a = 0 THEN 'pass' ELSE 'fail' END AS outcome FROM s
    UNION ALL SELECT 'value is mostly small', 'invalid_percent', round(b, 6), CASE WHEN b < 1 THEN 'pass' ELSE 'fail' END FROM s
    UNION ALL SELECT 'key is short', 'invalid_count', c, CASE WHEN c = 0 THEN 'pass' ELSE 'fail' END FROM s
    UNION ALL SELECT 'mean value', 'avg', round(d, 6), CASE WHEN d BETWEEN 1 AND 40 THEN 'pass' ELSE 'fail' END FROM s
    UNION ALL SELECT 'enough rows', 'row_count', e, CASE WHEN e < 1000 THEN 'warn' ELSE 'pass' END FROM s"""
)
def contract_events(t: Tables) -> DataFrame:
    return checks.run_checks(t.events, _PROPS).withColumn("value", F.round("value", 6))


@query(
    """SELECT o_orderkey, l_linenumber FROM (SELECT l_orderkey AS o_orderkey, l_linenumber FROM lineitem) l
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')"""
)
def ref_integrity(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    return checks.missing_references(lines, "o_orderkey", t.orders.where("o_orderstatus <> 'P'"), "o_orderkey")


@query(
    f"""WITH {METRICS}, r AS (SELECT source AS pipeline, run_date, items_extracted AS rows,
        lag(items_extracted) OVER (PARTITION BY source ORDER BY run_date) AS previous_rows,
        row_number() OVER (PARTITION BY source ORDER BY run_date DESC) AS rn FROM run_metrics)
    SELECT pipeline, run_date, rows, previous_rows,
           abs(rows - previous_rows) * 100.0::DOUBLE / previous_rows AS change_percent,
           CASE WHEN abs(rows - previous_rows) * 100.0 / previous_rows > 5 THEN 'warn' ELSE 'pass' END AS outcome
    FROM r WHERE rn = 1"""
)
def rowcount_change(t: Tables) -> DataFrame:
    counts = t.run_metrics.select(F.col("source").alias("pipeline"), "run_date", F.col("items_extracted").alias("total_records"))
    return checks.row_count_change(counts, 5.0)


def _test_sql(table: str, name: str) -> list[str]:
    out = []
    for test in COLUMN_TESTS[name]:
        c = test.column
        if test.kind == "unique":
            value = f"SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
        else:
            broken = {
                "not_null": f"{c} IS NULL",
                "accepted_range": f"{c} NOT BETWEEN {test.low if test.low is not None else '-1e18'} AND {test.high if test.high is not None else '1e18'}",
                "accepted_values": f"{c} NOT IN ({', '.join(map(str, test.values))})",
            }[test.kind]
            value = f"SELECT count(*) FROM {table} WHERE {broken}"
        out.append(
            f"SELECT '{name}' AS model, '{c}' AS column_name, '{test.kind}' AS test, n AS failures, "
            f"CASE WHEN n = 0 THEN 'pass' ELSE 'warn' END AS status FROM ({value}) s(n)"
        )
    return out


_TESTED = [
    ("stg_alerts", "stg_alerts"), ("fct_alerts", "fct_alerts"), ("stg_commune_profiles", "stg_profiles"),
    ("stg_risk_details", "stg_details"), ("stg_books", "stg_books"), ("dim_books", "dim_books"),
    ("stg_quotes", "stg_quotes"),
]


@query(
    f"WITH {FCT_ALERTS}, {STG_PROFILES}, {STG_DETAILS}, {DIM_BOOKS}, {STG_QUOTES} "
    + " UNION ALL ".join(s for name, table in _TESTED for s in _test_sql(table, name))
)
def column_tests(t: Tables) -> DataFrame:
    alerts, books = staging.stg_alerts(t.alerts), staging.stg_books(t.books)
    tested = {
        "stg_alerts": alerts,
        "fct_alerts": marts.fct_alerts(alerts),
        "stg_commune_profiles": staging.stg_commune_profiles(t.commune_profiles),
        "stg_risk_details": staging.stg_risk_details(t.risk_details),
        "stg_books": books,
        "dim_books": marts.dim_books(books),
        "stg_quotes": staging.stg_quotes(t.quotes, t.authors),
    }
    return checks.run_model_tests(tested, COLUMN_TESTS)


_ALL_MODELS = [*_TESTED, ("dim_communes", "dim_communes"), ("dim_authors", "dim_authors"), ("fct_quotes", "fct_quotes"),
               ("rpt_risk_summary", "rpt_risk_summary"), ("rpt_book_stats", "rpt_book_stats"), ("rpt_quote_stats", "rpt_quote_stats")]
_TABLE_OF = dict(_ALL_MODELS)


def _reference_sql(r: checks.Reference) -> str:
    child, parent = _TABLE_OF[r.model], _TABLE_OF[r.parent]
    return (
        f"SELECT '{r.model}' AS model, '{r.column}' AS column_name, 'relationship' AS test, n AS failures, "
        f"CASE WHEN n = 0 THEN 'pass' ELSE 'warn' END AS status FROM (SELECT count(*) FROM {child} "
        f"WHERE {r.column} IS NOT NULL AND {r.column} NOT IN (SELECT {r.parent_column} FROM {parent} WHERE {r.parent_column} IS NOT NULL)) s(n)"
    )


_REPORTS = {"rpt_risk_summary": "risk_summary", "rpt_book_stats": "book_stats", "rpt_quote_stats": "quote_stats"}


@query(
    f"WITH {FCT_ALERTS}, {DIM_COMMUNES}, {DIM_BOOKS}, {DIM_AUTHORS}, {FCT_QUOTES}, "
    + ", ".join(f"{name} AS ({SQL[report]})" for name, report in _REPORTS.items())
    + " " + " UNION ALL ".join([s for name, table in _ALL_MODELS for s in _test_sql(table, name)] + [_reference_sql(r) for r in REFERENCES])
)
def model_tests(t: Tables) -> DataFrame:
    """All column tests and references of all models, each model derived once."""
    alerts, books = staging.stg_alerts(t.alerts), staging.stg_books(t.books)
    profiles, details = staging.stg_commune_profiles(t.commune_profiles), staging.stg_risk_details(t.risk_details)
    quotes = staging.stg_quotes(t.quotes, t.authors)
    facts, dim_books, fct_quotes = marts.fct_alerts(alerts), marts.dim_books(books), marts.fct_quotes(quotes)
    communes, authors = marts.dim_communes(profiles, details), models._authors(t)
    return checks.run_model_tests({
        "stg_alerts": alerts, "stg_commune_profiles": profiles, "stg_risk_details": details, "stg_books": books,
        "stg_quotes": quotes, "fct_alerts": facts, "dim_communes": communes, "dim_books": dim_books, "dim_authors": authors,
        "fct_quotes": fct_quotes, "rpt_risk_summary": marts.rpt_risk_summary(facts, communes),
        "rpt_book_stats": marts.rpt_book_stats(dim_books), "rpt_quote_stats": marts.rpt_quote_stats(authors, fct_quotes),
    }, COLUMN_TESTS, REFERENCES)


@query(
    f"""WITH {ALERTS}, {PROFILES}, g AS (
      SELECT 'alerts' AS report, count(*) AS row_count, max(extraction_date) AS last_date FROM alerts
      UNION ALL SELECT 'commune_profiles', count(*), max(extraction_date) FROM commune_profiles
      UNION ALL SELECT 'shipments', count(*), CAST(max(l_shipdate) AS DATE) FROM lineitem
      UNION ALL SELECT 'no_orders', count(*), CAST(max(o_orderdate) AS DATE) FROM orders WHERE o_orderstatus = 'none')
    SELECT report, row_count, last_date,
           CASE WHEN row_count = 0 THEN 'empty' WHEN date_diff('day', last_date, DATE '2024-02-01') > 2
                THEN 'stale ' || CAST(date_diff('day', last_date, DATE '2024-02-01') AS VARCHAR) || 'd' END AS problem FROM g"""
)
def mart_gate(t: Tables) -> DataFrame:
    reports = {
        "alerts": (t.alerts, "extraction_date"),
        "commune_profiles": (t.commune_profiles, "extraction_date"),
        "shipments": (t.lineitem, "l_shipdate"),
        "no_orders": (t.orders.where("o_orderstatus = 'none'"), "o_orderdate"),
    }
    return health.mart_gate(reports, F.lit("2024-02-01").cast("date"))


def _sparse_orders(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.lit(" - ")).when(F.col("o_orderstatus") == "O", F.lit("\t")).otherwise("x").alias("mark"),
        F.when(F.col("o_totalprice") > 490000, F.col("o_totalprice")).alias("peak"),
        F.when(F.col("o_totalprice") > 490000, F.lit(1)).otherwise(0).alias("note"),
        (F.col("o_totalprice") > 495000).alias("top"),
        "o_orderdate",
    )


_EMPTY = {
    "o_orderkey": "o_orderkey = 0",
    "mark": "o_orderstatus IN ('F', 'O')",
    "peak": "NOT o_totalprice > 490000",
    "note": "NOT o_totalprice > 490000",
    "top": "NOT o_totalprice > 495000",
    "o_orderdate": "o_orderdate IS NULL",
}


_DENSITY = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) FILTER (WHERE {cond}) AS empty_count,
        round(count(*) FILTER (WHERE {cond}) / count(*), 3) AS null_rate,
        {'false' if c == 'note' else f'count(*) FILTER (WHERE {cond}) / count(*) > 0.9 AND count(*) >= 10'} AS sparse FROM orders"""
    for c, cond in _EMPTY.items()
)


@query(_DENSITY)
def column_density(t: Tables) -> DataFrame:
    return density.column_density(_sparse_orders(t))


@query(
    """WITH s(status) AS (
      SELECT CASE WHEN count(*) FILTER (WHERE NOT o_totalprice > 495000) / count(*) > 0.9 THEN 'SPARSE_COLUMNS' ELSE 'OK' END FROM orders
      UNION ALL SELECT CASE WHEN count(*) = 0 THEN 'EMPTY_OK' ELSE 'OK' END FROM orders WHERE o_orderstatus = 'none'
      UNION ALL SELECT 'OK' FROM (SELECT count(*) FROM customer)
      UNION ALL SELECT CASE WHEN count(*) = 0 THEN 'EMPTY_KPI' ELSE 'OK' END FROM lineitem WHERE l_returnflag = 'none')
    SELECT status, count(*) AS n FROM s GROUP BY status"""
)
def density_tally(t: Tables) -> DataFrame:
    frames = {
        "orders": _sparse_orders(t),
        "none": t.orders.where("o_orderstatus = 'none'"),
        "customers": t.customer.agg(F.count("*").alias("n")),
        "kpi": t.lineitem.where("l_returnflag = 'none'").agg(F.count("*").alias("n")),
    }
    merged = None
    for name, df in frames.items():
        status = density.density_status(density.column_density(df), name)
        merged = status if merged is None else merged.unionByName(status)
    return density.tally(merged)


_ANOMALIES = """
stats AS (SELECT avg(value) AS mv, stddev_samp(value) AS sv, avg(user_id) AS mu, stddev_samp(user_id) AS su FROM events),
z AS (SELECT event_id, event_type, value, user_id, (value - mv) / sv AS zv, (user_id - mu) / su AS zu FROM events, stats)"""
_REASON = "CASE WHEN abs({0}) > 3.0 THEN '{1} has outlier Z-score (' || printf('%.2f', {0}) || ' > 3.0)' END"


@query(
    f"""WITH {_ANOMALIES}
    SELECT event_id, event_type, value, abs(zv) > 3.0 OR abs(zu) > 3.0 AS is_anomaly,
           concat_ws(';', {_REASON.format('zv', 'value')}, {_REASON.format('zu', 'user_id')}) AS reasons FROM z"""
)
def anomalies(t: Tables) -> DataFrame:
    flagged = anomaly.detect_anomalies(t.events, ["value", "user_id", "not_there"])
    return flagged.select("event_id", "event_type", "value", "is_anomaly", F.array_join("anomaly_reasons", ";").alias("reasons"))


@query(
    f"""WITH {_ANOMALIES}
    SELECT CASE WHEN abs(zv) > 3.0 OR abs(zu) > 3.0 THEN 'quarantine' ELSE 'staging' END AS target, event_type,
           count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM z GROUP BY ALL"""
)
def anomaly_quarantine(t: Tables) -> DataFrame:
    flagged = anomaly.detect_anomalies(t.events, ["value", "user_id"])
    quarantine, clean = anomaly.split_anomalies(flagged)
    both = quarantine.select(F.lit("quarantine").alias("target"), "event_type", "event_id").unionByName(
        clean.select(F.lit("staging").alias("target"), "event_type", "event_id")
    )
    return both.groupBy("target", "event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))
