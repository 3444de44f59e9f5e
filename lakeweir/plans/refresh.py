"""The modelling run: landing tables to staging snapshots, marts, reports and the gate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.operators.checks import CheckFailure, check_schema
from lakeweir.operators.health import enforce_mart_gate, mart_gate
from lakeweir.plans import marts, staging
from lakeweir.plans.contracts import REQUIRED_COLUMNS
from lakeweir.plans.history import extraction_history, refresh_history
from lakeweir.plans.incremental import refresh_alert_facts
from lakeweir.sources.catalog import Catalog, Dataset
from lakeweir.sources.sinks import replace_partitions, replace_snapshot
from lakeweir.sources.versions import read_table

DATED = ("stg_alerts", "stg_commune_profiles", "stg_risk_details")


# Days that a report's newest data may be old at the time of the run; books and quotes come weekly at most.
MAX_DATA_AGE = {"rpt_risk_summary": 2, "rpt_book_stats": 31, "rpt_quote_stats": 31}


def build_staging(landing: Catalog | Mapping[str, DataFrame], *, latest_only: bool = True) -> dict[str, DataFrame]:
    """The staging views; ``latest_only`` keeps the newest extraction of books and quotes."""
    return {
        "stg_alerts": staging.stg_alerts(landing["alerts"]),
        "stg_commune_profiles": staging.stg_commune_profiles(landing["commune_profiles"]),
        "stg_risk_details": staging.stg_risk_details(landing["risk_details"]),
        "stg_books": staging.stg_books(landing["books"], latest_only=latest_only),
        "stg_quotes": staging.stg_quotes(landing["quotes"], landing["authors"], latest_only=latest_only),
    }


def enforce_required(tables: Mapping[str, DataFrame]) -> None:
    """Raise if a landing table lacks a column that its contract requires; only the plans are looked at."""
    broken = [
        f"{name}: {column} is {rule}"
        for name, df in tables.items()
        for rule, column, _ in check_schema(df, required=REQUIRED_COLUMNS.get(name, ()))
    ]
    if broken:
        raise CheckFailure("; ".join(broken))


def export_staging(spark: SparkSession, views: Mapping[str, DataFrame], base: str, *, by_date: bool = False) -> Catalog:
    """Snapshot the staging views; dated ones by partition, the others whole.

    ``by_date``: the views read landing tables that are stored by date, so their files have few dates each,
    or hold few dates in all.
    """
    catalog = Catalog(spark)
    for name, df in views.items():
        path = f"{base}/{name}"
        if name in DATED:
            replace_partitions(df, path, "extraction_date", gather=not by_date)
            day = df.schema["extraction_date"]
            files = df.drop("extraction_date").schema
            catalog.add(name, Dataset(path, "partitioned", files, day))
        else:
            replace_snapshot(df, path)
            catalog.add(name, Dataset(path, "snapshot", df.schema))
    return catalog


def refresh(
    spark: SparkSession,
    landing: Catalog | Mapping[str, DataFrame],
    base: str,
    as_of: str,
    *,
    max_age_days: int = 2,
    lookback_days: int = 0,
    latest_only: bool = True,
    max_data_age_days: Mapping[str, int] | None = None,
    by_date: bool = False,
) -> dict[str, int]:
    """Run staging, marts and reports below ``base``; returns row counts per report or raises.

    ``latest_only`` models the newest extraction of books and quotes; without it every extraction
    counts again. ``as_of`` is the run's timestamp; it stamps the reports, so a rerun gives the same
    files. The gate judges the stamps, and the newest extraction behind each report by
    ``max_data_age_days`` (default MAX_DATA_AGE). Dimensions that several marts read are written
    once and read back. ``by_date`` says that the landing tables are stored by date, as the ingestion
    jobs store them, or have FEW_PARTITIONS dates at most; their snapshots are then written without a shuffle.
    """
    enforce_required({name: landing[name] for name in REQUIRED_COLUMNS})
    views = export_staging(spark, build_staging(landing, latest_only=latest_only), f"{base}/landing", by_date=by_date)

    def table(name: str, df: DataFrame) -> DataFrame:
        path = f"{base}/marts/{name}"
        replace_snapshot(df, path)
        return read_table(spark, path, df.schema)

    facts = f"{base}/marts/fct_alerts"
    refresh_alert_facts(spark, views["stg_alerts"], facts, lookback_days, reread=True)
    alerts = read_table(spark, facts, marts.fct_alerts(views["stg_alerts"]).schema)
    history = extraction_history(refresh_history(spark, views["stg_commune_profiles"], f"{base}/state/commune_history"))
    communes = table("dim_communes", marts.dim_communes(views["stg_commune_profiles"], views["stg_risk_details"], history))
    books = table("dim_books", marts.dim_books(views["stg_books"]))
    authors = table("dim_authors", marts.dim_authors(views["stg_quotes"]))
    quotes = table("fct_quotes", marts.fct_quotes(views["stg_quotes"]))
    stamp = F.lit(as_of).cast("timestamp_ntz")
    reports = {
        "rpt_risk_summary": table("rpt_risk_summary", marts.rpt_risk_summary(alerts, communes, stamp)),
        "rpt_book_stats": table("rpt_book_stats", marts.rpt_book_stats(books, stamp)),
        "rpt_quote_stats": table("rpt_quote_stats", marts.rpt_quote_stats(authors, quotes, stamp)),
    }
    today = F.lit(as_of).cast("date")
    counts = enforce_mart_gate(mart_gate({name: (df, "generated_at") for name, df in reports.items()}, today, max_age_days))
    sources = {"rpt_risk_summary": alerts, "rpt_book_stats": books, "rpt_quote_stats": quotes}
    for name, days in (MAX_DATA_AGE if max_data_age_days is None else max_data_age_days).items():
        enforce_mart_gate(mart_gate({f"data of {name}": (sources[name], "extraction_date")}, today, days))
    return counts
