"""Staging: landing tables cleaned, one row in, at most one row out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.functions import band, clean, flag_positive, title_case
from lakeweir.operators.snapshot import latest_snapshot

# Limits of the price, rating and length bands.
PRICE_BANDS = [(15, "Budget"), (35, "Mid-range"), (55, "Premium")]
RATING_BANDS = [(4, "Excellent"), (3, "Good"), (2, "Average")]
LENGTH_BANDS = [(100, "Short"), (250, "Medium")]

COUNT_COLUMNS = [
    "naturels_count", "technologiques_count", "total_risks", "max_severity_naturels",
    "max_severity_technologiques", "seisme_severity", "rga_severity", "radon_severity",
    "inondation_severity",
]
FLAG_COLUMNS = [
    "seisme_present", "rga_present", "radon_present", "inondation_present", "icpe_present",
    "nucleaire_present",
]


def _trimmed(*names: str):
    return [clean(F.col(n)).alias(n) for n in names]


def _defaulted(names, value):
    return [F.coalesce(n, F.lit(value)).alias(n) for n in names]


def stg_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.where(F.col("department_code").isNotNull() & F.col("phenomenon_name").isNotNull()).select(
        F.col("id").alias("alert_row_id"),
        *_trimmed("department_code", "department_name"),
        "phenomenon_id",
        *_trimmed("phenomenon_name"),
        "begin_time",
        "end_time",
        "color_id",
        *_trimmed("color_name"),
        *_defaulted(["color_level"], 0),
        *_trimmed("color_hex"),
        "extracted_at",
        "extraction_date",
        "created_at",
    )


def stg_commune_profiles(profiles: DataFrame) -> DataFrame:
    return profiles.where(F.col("insee_code").isNotNull()).select(
        F.col("id").alias("profile_row_id"),
        *_trimmed("insee_code", "commune", "code_postal", "department_code", "department_name", "region"),
        *_defaulted(COUNT_COLUMNS, 0),
        *_defaulted(FLAG_COLUMNS, False),
        "extracted_at",
        "extraction_date",
        "created_at",
    )


def stg_risk_details(details: DataFrame) -> DataFrame:
    return details.where(F.col("insee_code").isNotNull() & F.col("risk_key").isNotNull()).select(
        F.col("id").alias("detail_row_id"),
        *_trimmed("insee_code", "risk_category", "risk_key", "risk_libelle"),
        *_defaulted(["present"], False),
        *_trimmed("statut_commune", "statut_adresse", "severity_label"),
        *_defaulted(["severity_score"], 0),
        "extracted_at",
        "extraction_date",
        "created_at",
    )


def stg_books(books: DataFrame, *, latest_only: bool = False) -> DataFrame:
    """Books with price and rating bands; ``latest_only`` keeps the newest extraction.

    NULL prices fall to Luxury, NULL ratings to Poor, NULL stock counts as out of stock.
    """
    if latest_only:
        books = latest_snapshot(books, "extraction_date")
    return books.where(F.col("upc").isNotNull() & (F.length(clean(F.col("upc"))) >= 2)).select(
        F.col("id").alias("book_id"),
        *_trimmed("upc", "title"),
        title_case(clean(F.col("category"))).alias("category"),
        "star_rating",
        "price",
        "price_incl_tax",
        "tax",
        clean(F.col("availability")).alias("availability_text"),
        "stock_count",
        flag_positive(F.col("stock_count")).alias("is_in_stock"),
        *_trimmed("description"),
        "image_url",
        "product_url",
        band(F.col("price"), PRICE_BANDS, "Luxury").alias("price_tier"),
        band(F.col("star_rating"), RATING_BANDS, "Poor", at_least=True).alias("rating_category"),
        "extracted_at",
        "extraction_date",
        "created_at",
    )


def stg_quotes(quotes: DataFrame, authors: DataFrame, *, latest_only: bool = False) -> DataFrame:
    """Quotes with their author's birth data. The length is that of the untrimmed text.

    Without ``latest_only`` an author extracted on several dates repeats the quote, as the model
    this follows does.
    """
    if latest_only:
        quotes, authors = latest_snapshot(quotes, "extraction_date"), latest_snapshot(authors, "extraction_date")
    born = authors.select("slug", "born_date", "born_location")
    joined = quotes.where(F.col("quote_hash").isNotNull()).join(
        born, F.col("author_slug") == F.col("slug"), "left"
    )
    length = F.length("text")
    return joined.select(
        F.col("id").alias("quote_id"),
        "quote_hash",
        "author_slug",
        clean(F.col("text")).alias("quote_text"),
        *_trimmed("author_name"),
        F.col("tags").alias("tags_json"),
        F.col("born_date").alias("author_born_date"),
        F.col("born_location").alias("author_born_location"),
        length.alias("quote_length"),
        band(length, LENGTH_BANDS, "Long").alias("quote_length_category"),
        "extracted_at",
        "extraction_date",
        "created_at",
    )
