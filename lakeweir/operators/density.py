"""Share of empty values per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, IntegralType, StringType

# Columns that may be sparse, rows below which nothing is judged, tolerated share.
TOLERATED = {"score", "points", "url", "note", "rating"}
MIN_ROWS = 10
MAX_EMPTY = 0.9


def is_empty(df: DataFrame, column: str) -> Column:
    """NULL, blank or ``-`` text, zero, false. Decimal and date values are empty only when NULL."""
    c, kind = F.col(f"`{column}`"), df.schema[column].dataType
    if isinstance(kind, StringType):
        blank = c.rlike(r"(?U)^\s*-?\s*$")
    elif isinstance(kind, BooleanType):
        blank = ~c
    elif isinstance(kind, (IntegralType, DoubleType, FloatType)):
        blank = c == 0
    else:
        blank = F.lit(False)
    return c.isNull() | blank


def column_density(df: DataFrame, *, min_rows: int = MIN_ROWS, max_empty: float = MAX_EMPTY) -> DataFrame:
    """One row per column: (column, rows, empty_count, null_rate, sparse), from one aggregate."""
    counts = df.agg(
        F.count("*").alias("rows"), *[F.count_if(is_empty(df, c)).alias(f"e{i}") for i, c in enumerate(df.columns)]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(c.lower() in TOLERATED).alias("tolerated"),
                F.col(f"e{i}").alias("empty_count"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    rate = F.when(F.col("rows") > 0, F.col("empty_count") / F.col("rows"))
    judged = (F.col("rows") >= min_rows) & ~F.col("tolerated")
    return counts.select("rows", F.inline(entries)).select(
        "column",
        "rows",
        "empty_count",
        F.round(rate, 3).alias("null_rate"),
        (judged & F.coalesce(rate > max_empty, F.lit(False))).alias("sparse"),
    )


def density_status(profile: DataFrame, name: str) -> DataFrame:
    """(name, status, sparse_columns) of a profile from ``column_density``."""
    totals = profile.agg(
        F.max("rows").alias("rows"),
        F.count("*").alias("columns"),
        F.max("empty_count").alias("empty"),
        F.count_if("sparse").alias("sparse_columns"),
    )
    status = (
        F.when((F.col("rows") == 1) & (F.col("columns") == 1) & (F.col("empty") == 1), "EMPTY_KPI")
        .when(F.col("rows") == 0, "EMPTY_OK")
        .when(F.col("sparse_columns") > 0, "SPARSE_COLUMNS")
        .otherwise("OK")
    )
    return totals.select(F.lit(name).alias("name"), status.alias("status"), "sparse_columns")


def tally(statuses: DataFrame) -> DataFrame:
    return statuses.groupBy("status").agg(F.count("*").alias("n"))
