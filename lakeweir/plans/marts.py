"""Dimensions, facts and reports on top of staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.functions import hours_between, rounded_average, rounded_decimal, surrogate_key
from lakeweir.operators.snapshot import latest_snapshot


def dim_books(books: DataFrame) -> DataFrame:
    return books.select(
        surrogate_key(F.col("upc")).alias("book_key"),
        "upc", "title", "category", "star_rating", "price", "price_incl_tax", "tax",
        "availability_text", "stock_count", "is_in_stock", "price_tier", "rating_category",
        "product_url", "image_url", "extracted_at", "extraction_date",
    )


def dim_authors(quotes: DataFrame) -> DataFrame:
    """Distinct authors of the staged quotes; the key is hashed after the distinct, once per author."""
    columns = ["author_slug", "author_name", "author_born_date", "author_born_location"]
    distinct = quotes.where(F.col("author_slug").isNotNull()).select(*columns).distinct()
    return distinct.select(surrogate_key(F.col("author_slug")).alias("author_key"), *columns)


def fct_quotes(quotes: DataFrame) -> DataFrame:
    """Quotes by author key. Quotes without author share the key of NULL."""
    return quotes.select(
        surrogate_key(F.col("quote_hash")).alias("quote_key"),
        "quote_hash",
        surrogate_key(F.col("author_slug")).alias("author_key"),
        "quote_text", "tags_json", "quote_length", "quote_length_category", "extracted_at", "extraction_date",
    )


def fct_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.select(
        surrogate_key(*[F.col(c) for c in ("department_code", "phenomenon_id", "begin_time", "extraction_date")]).alias("alert_key"),
        surrogate_key(F.col("department_code")).alias("department_key"),
        "department_code", "department_name", "phenomenon_id", "phenomenon_name", "color_name",
        "color_level", "color_hex",
        hours_between(F.col("begin_time"), F.col("end_time")).alias("duration_hours"),
        "begin_time", "end_time", "extraction_date", "extracted_at",
    )


def extraction_history(profiles: DataFrame) -> DataFrame:
    """First and last date and number of distinct dates per commune.

    Dates are made distinct by a grouping of their own, which combines before its shuffle.
    """
    return (
        profiles.select("insee_code", "extraction_date")
        .distinct()
        .groupBy("insee_code")
        .agg(
            F.min("extraction_date").alias("first_extraction"),
            F.max("extraction_date").alias("last_extraction"),
            F.count("extraction_date").alias("extraction_count"),
        )
    )


def dim_communes(profiles: DataFrame, details: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Communes of the newest extraction, with the list of their present risks and their history.

    Only the newest date is read in full. ``history`` is the columns of ``extraction_history`` from a
    state that is kept (plans/history.py); without it the key and date of all profiles are read. Profiles are
    keyed by (insee_code, extraction_date) and details by (insee_code, risk_key, extraction_date),
    so a commune's list is as long as there are risk keys.
    """
    newest = profiles.agg(F.max("extraction_date").alias("d")).scalar()
    listed = (
        details.where(F.col("extraction_date") == newest)
        .groupBy("insee_code")
        .agg(
            F.expr(
                "listagg(CASE WHEN present THEN risk_libelle END, ', ') "
                "WITHIN GROUP (ORDER BY risk_category, risk_key)"
            ).alias("active_risks_list")
        )
    )
    wide = (
        profiles.where(F.col("extraction_date") == newest)
        .join(listed, "insee_code", "left")
        .join(extraction_history(profiles) if history is None else history, "insee_code", "left")
    )
    columns = [
        "commune", "code_postal", "department_code", "department_name", "region", "naturels_count",
        "technologiques_count", "total_risks", "max_severity_naturels", "max_severity_technologiques",
        "seisme_present", "seisme_severity", "rga_present", "rga_severity", "radon_present",
        "radon_severity", "inondation_present", "inondation_severity", "icpe_present", "nucleaire_present",
    ]
    return wide.select(
        surrogate_key(F.col("insee_code")).alias("commune_id"),
        "insee_code",
        *columns,
        "active_risks_list",
        F.greatest("max_severity_naturels", "max_severity_technologiques").alias("overall_max_severity"),
        "first_extraction",
        "last_extraction",
        "extraction_count",
    )


def active_risk_counts(details: DataFrame, newest: Column) -> DataFrame:
    """Present risks per commune and category at the newest date."""
    present = F.col("present")
    return (
        details.where(F.col("extraction_date") == newest)
        .groupBy("insee_code")
        .agg(
            F.count_if(present & (F.col("risk_category") == "naturel")).alias("active_natural_risks"),
            F.count_if(present & (F.col("risk_category") == "technologique")).alias("active_techno_risks"),
        )
    )


def rpt_book_stats(books: DataFrame, generated_at: Column | None = None) -> DataFrame:
    report = books.groupBy("category").agg(
        F.count("*").alias("book_count"),
        rounded_average(F.col("price"), 2).alias("avg_price"),
        rounded_average(F.col("star_rating"), 1).alias("avg_rating"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum("stock_count").alias("total_stock"),
        F.count_if(F.col("star_rating") >= 4).alias("highly_rated_count"),
    )
    return _stamped(report, generated_at)


def rpt_quote_stats(authors: DataFrame, quotes: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """Quote counts and lengths per author, authors without quotes included.

    Quotes are summed per author key before the join, so an author with very many quotes is one
    row there. Authors that share name and birth data are summed together afterwards.
    """
    per_key = quotes.groupBy("author_key").agg(
        F.count("quote_key").alias("n"),
        F.count("quote_length").alias("measured"),
        F.sum("quote_length").alias("total"),
        F.min("quote_length").alias("shortest"),
        F.max("quote_length").alias("longest"),
    )
    average = rounded_decimal(F.sum("total") / F.nullif(F.sum("measured"), F.lit(0)), 1)
    report = (
        authors.join(per_key, "author_key", "left")
        .groupBy("author_name", "author_born_date", "author_born_location")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("quote_count"),
            average.alias("avg_quote_length"),
            F.min("shortest").alias("min_quote_length"),
            F.max("longest").alias("max_quote_length"),
        )
    )
    return _stamped(report, generated_at)


def department_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts of the newest date per department.

    The list of distinct ``phenomenon (colour)`` texts is built from a distinct set: alerts are
    counted per department and text first, so the list's group holds a few texts, not all alerts.
    """
    label = F.concat("phenomenon_name", F.lit(" ("), "color_name", F.lit(")"))
    counted = (
        latest_snapshot(alerts, "extraction_date")
        .groupBy("department_code", "department_name", label.alias("label"))
        .agg(
            F.count("*").alias("n"),
            F.max("color_level").alias("level"),
            F.count_if(F.col("color_level") >= 3).alias("high"),
        )
    )
    return counted.groupBy("department_code", "department_name").agg(
        F.sum("n").alias("active_alert_count"),
        F.max("level").alias("max_alert_level"),
        F.expr("listagg(label, ', ') WITHIN GROUP (ORDER BY label)").alias("active_alerts_list"),
        F.sum("high").alias("orange_red_count"),
    )


def place_risks(communes: DataFrame) -> DataFrame:
    """Communes summed per department, department name and region."""

    def sums(column: str) -> list[Column]:
        return [F.sum(column).alias(f"sum_{column}"), F.count(column).alias(f"n_{column}")]

    return communes.groupBy("department_code", "department_name", "region").agg(
        F.count("*").alias("commune_count"),
        F.max("total_risks").alias("max_risks_in_dept"),
        *[c for column in _AVERAGED for c in sums(column)],
        *[F.count_if(f"{risk}_present").alias(f"communes_with_{risk}") for risk in _COUNTED],
    )


_AVERAGED = {
    "total_risks": "avg_risks_per_commune",
    "max_severity_naturels": "avg_severity_naturels",
    "max_severity_technologiques": "avg_severity_technologiques",
}
_COUNTED = ("seisme", "inondation", "radon", "icpe", "nucleaire")


def department_risks(places: DataFrame) -> DataFrame:
    """Departments from ``place_risks``: counts, greatest and average risks."""

    def average(column: str) -> Column:
        return F.sum(f"sum_{column}") / F.nullif(F.sum(f"n_{column}"), F.lit(0))

    return places.groupBy("department_code").agg(
        F.sum("commune_count").alias("commune_count"),
        F.max("max_risks_in_dept").alias("max_risks_in_dept"),
        *[rounded_decimal(average(column), 1).alias(name) for column, name in _AVERAGED.items()],
        *[F.sum(f"communes_with_{risk}").alias(f"communes_with_{risk}") for risk in _COUNTED],
    )


def rpt_risk_summary(
    alerts: DataFrame, communes: DataFrame, generated_at: Column | None = None, *, ordered: bool = True
) -> DataFrame:
    """Departments with their structural risks and current alerts, either side may be missing.

    Figures and names of departments both come from one sum per place, so the communes are read
    and shuffled once.
    """
    per_place = place_risks(communes)
    risks, warnings = department_risks(per_place).alias("r"), department_alerts(alerts).alias("a")
    places = per_place.select("department_code", "department_name", "region").alias("c")
    both = risks.join(warnings, F.col("r.department_code") == F.col("a.department_code"), "full").withColumn(
        "code", F.coalesce("r.department_code", "a.department_code")
    )
    joined = both.join(places, F.col("code") == F.col("c.department_code"), "left")

    def counted(column: str, name: str | None = None) -> Column:
        return F.coalesce(column, F.lit(0)).alias(name or column.split(".")[1])

    report = joined.select(
        F.col("code").alias("department_code"),
        F.coalesce("a.department_name", "c.department_name").alias("department_name"),
        "c.region",
        counted("r.commune_count", "monitored_communes"),
        counted("r.avg_risks_per_commune"),
        counted("r.max_risks_in_dept"),
        "r.avg_severity_naturels",
        "r.avg_severity_technologiques",
        counted("r.communes_with_seisme"),
        counted("r.communes_with_inondation"),
        counted("r.communes_with_radon"),
        counted("r.communes_with_icpe"),
        counted("r.communes_with_nucleaire"),
        counted("a.active_alert_count"),
        counted("a.max_alert_level"),
        "a.active_alerts_list",
        counted("a.orange_red_count"),
    )
    report = _stamped(report, generated_at)
    if ordered:
        report = report.orderBy(F.desc("max_alert_level"), F.desc("max_risks_in_dept"), "department_code")
    return report


def _stamped(report: DataFrame, generated_at: Column | None) -> DataFrame:
    return report if generated_at is None else report.withColumn("generated_at", generated_at)
