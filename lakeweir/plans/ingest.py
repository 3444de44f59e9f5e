"""Ingestion jobs: raw documents and pages to validated landing tables.

Each job derives its rows once, stages them in the shared folder, gates them on their contract and
upserts the valid ones. What fails the contract never reaches a landing table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.operators import normalize, pages
from lakeweir.operators.anomaly import detect_anomalies, split_anomalies
from lakeweir.operators.contracts import CONTRACTS, enforce_pass_rate, mark_errors, paired_pass_rate, pass_rate, split_valid
from lakeweir.operators.enrich import alerts_by_store, cut_groups, group_sizes, risks_by_store, settled_store_alerts
from lakeweir.operators.health import RunMetrics, track_run
from lakeweir.operators.snapshot import keep_first
from lakeweir.sources.sinks import append_log, replace_partitions, staged, upsert_landing, write_documents

RUN_LOG = "quality_runs"


def valid_rows(rows: DataFrame, contract: str, pipeline: str, base: str, as_of: str, minimum: float = 0.90) -> DataFrame:
    """Rows that fit the contract; logs the pass rate below ``base`` and raises if it is too low."""
    marked = staged(mark_errors(rows, CONTRACTS[contract]), pipeline)
    rate = pass_rate(marked, pipeline)
    append_log(rate, f"{base}/{RUN_LOG}", "logged_at", as_of)
    enforce_pass_rate(rate, minimum)
    return split_valid(marked)[0]


def ingest_alerts(documents: DataFrame, dictionaries: Mapping[str, DataFrame], base: str, as_of: str) -> None:
    """Alert documents to ``alerts``, ``store_alerts`` and ``alert_metadata``.

    Dictionaries: phenomena, colors, departments, stores.
    """
    phenomena, colors = dictionaries["phenomena"], dictionaries["colors"]
    stamp = F.lit(as_of).cast("timestamp_ntz")
    rows = normalize.alert_rows(documents, phenomena, colors, dictionaries["departments"])
    alerts = valid_rows(rows, "alert", "alerts", base, as_of)
    upsert_landing(alerts, base, "alerts", created_at=stamp, reread=True)
    land_store_alerts(alerts, dictionaries["stores"], base, as_of)
    upsert_landing(normalize.metadata_rows(phenomena, colors), base, "alert_metadata")


# Alerts at stores that one task writes, by the average of all, and stores whose names are sent to all tasks at most.
PER_TASK = 1_000_000
BROADCAST_NAMES = 1_000_000


def land_store_alerts(alerts: DataFrame, stores: DataFrame, base: str, as_of: str, minimum: float = 0.90) -> None:
    """Valid alerts at every valid store of their department to ``store_alerts``.

    There is a row per alert and store, so no row is made before it is written: each side is gated on its
    own rules, and of equal keys the row that stays is chosen before the join.
    """
    contract, own = CONTRACTS["store_alert"], ("gie_name",)
    marked = mark_errors(alerts.withColumn("alert_level", F.col("color_name")), contract.part(*own, without=True))
    places = mark_errors(stores.select("gie_name", "department_code"), contract.part(*own))
    rate = staged(paired_pass_rate(marked, places, "department_code", "store_alerts"), "store-alert-rate")
    append_log(rate, f"{base}/{RUN_LOG}", "logged_at", as_of)
    enforce_pass_rate(rate, minimum)
    chosen, names = (staged(side, "settled") for side in settled_store_alerts(split_valid(marked)[0], split_valid(places)[0]))
    rows, dates = dealt_store_alerts(chosen, names)
    stamp = F.lit(as_of).cast("timestamp_ntz")
    upsert_landing(rows, base, "store_alerts", created_at=stamp, reread=True, settled=dates)


def dealt_store_alerts(alerts: DataFrame, names: DataFrame) -> tuple[DataFrame, list]:
    """(rows, their dates) of settled sides, joined in tasks of about PER_TASK rows that need no further sort.

    Tasks are counted by the rows that are made, and take neighbours by date and group, so that a file holds
    the names of few groups and equal rows stand together: next to nothing but row ids then takes room. A group
    of far more stores than the average is cut, so that no task makes more than three times its share.
    """
    sizes = staged(group_sizes(alerts, names), "store-alert-groups")
    total = F.sum(F.col("alerts") * F.col("stores"))
    rows, kept, named = (n or 0 for n in sizes.agg(total, F.sum("alerts"), F.sum("stores")).first())
    alerts, names = cut_groups(alerts, names, sizes, 2 * (1 + rows // max(1, kept)))
    names = staged(names.orderBy("group", "gie_name"), "store-alert-names")
    dates = [r[0] for r in alerts.select("extraction_date").distinct().collect()]
    order = ["extraction_date", "group", *[c for c in alerts.columns if c not in ("extraction_date", "group")]]
    # Sorted here, a row per alert, the rows of the join come in the order of their write. The optimizer drops sorts
    # below a join, but not below a filter that it cannot move.
    dealt = alerts.repartitionByRange(1 + rows // PER_TASK, *order).sortWithinPartitions(*order)
    dealt = dealt.where(F.monotonically_increasing_id() >= 0)
    return alerts_by_store(dealt, F.broadcast(names) if named <= BROADCAST_NAMES else names, "group"), dates


def ingest_risks(documents: DataFrame, dictionaries: Mapping[str, DataFrame], base: str, as_of: str) -> None:
    """Risk reports of one extraction to ``commune_profiles``, ``risk_details`` and ``store_risks``.

    ``documents`` has ``document``, ``extracted_at`` and ``extraction_date``. Dictionaries:
    departments, risk_types, and store_places, or stores if they have the same columns. With a column
    ``position`` the first report of a commune by it counts, as members of one large file have.
    """
    stamp = F.lit(as_of).cast("timestamp_ntz")
    reports = normalize.parse_reports(normalize.split_reports(documents))
    if "position" in documents.columns:
        reports = keep_first(reports, ["insee_code", "extraction_date"], ["position"]).drop("position")
    parsed = staged(reports, "reports")
    rows = normalize.profile_rows(parsed, dictionaries["departments"])
    profiles = valid_rows(rows, "commune_profile", "commune_profiles", base, as_of)
    upsert_landing(profiles, base, "commune_profiles", created_at=stamp, reread=True)
    details = normalize.detail_rows(parsed, dictionaries["risk_types"])
    upsert_landing(valid_rows(details, "risk_detail", "risk_details", base, as_of), base, "risk_details", created_at=stamp, reread=True)
    stores = risks_by_store(dictionaries.get("store_places", dictionaries["stores"]), profiles).withColumns(
        {"extracted_at": stamp, "extraction_date": stamp.cast("date")}
    )
    upsert_landing(valid_rows(stores, "store_risk", "store_risks", base, as_of), base, "store_risks", created_at=stamp, reread=True)


def route_pages(parsed: DataFrame, source: str, page: str, base: str, as_of: str) -> tuple[DataFrame, int]:
    """Parsed pages, written once, to their sinks: records as gzip JSON documents, failures to ``page_errors``.

    Returns all rows without the error text, failures among them as records without values, which no
    contract accepts, so they count in the pass rate; and the number of failures.
    """
    rows = staged(parsed, f"{source}-parsed")
    failed = F.col("parse_error").isNotNull()
    day = F.lit(as_of).cast("timestamp_ntz").cast("date")
    errors = rows.where(failed).select(
        F.lit(source).alias("source"), day.alias("extraction_date"), F.col(page).alias("page"), "parse_error"
    )
    own = f"source={source}/extraction_date={as_of[:10]}"
    replace_partitions(errors, f"{base}/page_errors", ["source", "extraction_date"], [own])
    records = rows.where(~failed).drop("parse_error")
    write_documents(records, f"{base}/raw", "retail", source, F.col("extraction_date").cast("string"), as_of[:10])
    return rows.drop("parse_error"), rows.where(failed).count()


def ingest_books(
    listings: DataFrame, details: DataFrame, base: str, as_of: str, run: RunMetrics | None = None
) -> None:
    """Listing and detail pages to ``books``; anomalies go to ``anomalies/books`` by date instead.

    Pages are parsed once. ``run`` takes the counts: pages read into records or failed, rows loaded.
    """
    stamp, run = F.lit(as_of).cast("timestamp_ntz"), run or RunMetrics()
    landed, failed = route_pages(pages.land_books(listings, details, stamp, errors=True), "books", "product_url", base, as_of)
    run.items_extracted += landed.count() - failed
    run.errors += failed
    valid = valid_rows(landed, "book", "books", base, as_of)
    flagged = staged(detect_anomalies(valid, ["price", "stock_count"]), "books-flagged")
    anomalies, clean = split_anomalies(flagged)
    replace_partitions(anomalies, f"{base}/anomalies/books", "extraction_date", [f"extraction_date={as_of[:10]}"])
    upsert_landing(clean, base, "books", created_at=stamp, reread=True)
    run.items_loaded += clean.count()


def ingest_quotes(
    quote_pages: DataFrame, author_pages: DataFrame, base: str, as_of: str, run: RunMetrics | None = None
) -> None:
    """Quote pages (page_no, url, html) and author pages (slug, html) to ``quotes`` and ``authors``."""
    stamp, run = F.lit(as_of).cast("timestamp_ntz"), run or RunMetrics()
    landed, failed = route_pages(pages.land_quotes(quote_pages, stamp, errors=True), "quotes", "page_url", base, as_of)
    quotes = valid_rows(landed.drop("page_url"), "quote", "quotes", base, as_of)
    upsert_landing(quotes, base, "quotes", created_at=stamp, reread=True)
    run.items_extracted += landed.count() - failed
    run.errors += failed
    run.items_loaded += quotes.count()
    parsed, lost = route_pages(pages.author_records(author_pages, stamp, errors=True), "authors", "slug", base, as_of)
    authors = valid_rows(parsed, "author", "authors", base, as_of)
    upsert_landing(authors, base, "authors", created_at=stamp, reread=True)
    run.errors += lost


# Rows that a run has to load at least.
MINIMUM = {"books": 100, "quotes": 50}


def tracked(
    spark: SparkSession, source: str, base: str, as_of: str, job: Callable[[RunMetrics], None], minimum: int | None = None
) -> None:
    """Run a job and land its metrics row in ``run_metrics``, also if it fails; too few rows raise (MINIMUM)."""
    least = MINIMUM.get(source, 0) if minimum is None else minimum
    record = lambda row: upsert_landing(row, base, "run_metrics")
    with track_run(spark, source, f"{source}_ingestion", as_of[:10], record, min_records=least) as run:
        job(run)
