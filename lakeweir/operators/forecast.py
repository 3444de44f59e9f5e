"""Daily linear-trend price forecast, many series in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Shortest history that is fitted, lowest price that is forecast.
MIN_POINTS = 3
FLOOR = 0.01


def forecast_prices(
    prices: DataFrame,
    series: Sequence[str],
    date_col: str = "extraction_date",
    price_col: str = "price",
    days: int = 7,
) -> DataFrame:
    """History and forecast: (series, extraction_date, price, forecasted_price, is_forecast).

    Prices are averaged per day first; that aggregate combines before its shuffle, so a series
    with most of the rows leaves one row per day. The line is fitted over the rank of the day
    (gaps do not count) and the forecast goes on over calendar days. Ranks are numbered within a
    series, over days only.
    """
    daily = prices.groupBy(*series, F.col(date_col).cast("date").alias("extraction_date")).agg(
        F.avg(price_col).alias("price")
    )
    by_day = Window.partitionBy(*series).orderBy("extraction_date")
    ranked = daily.withColumn("x", F.row_number().over(by_day) - 1)
    fits = (
        ranked.groupBy(*series)
        .agg(
            F.count("*").alias("n"),
            F.max("extraction_date").alias("last_day"),
            F.regr_slope("price", "x").alias("slope"),
            F.regr_intercept("price", "x").alias("intercept"),
        )
        .where(F.col("n") >= MIN_POINTS)
    )
    future = fits.select(
        *series, "n", "last_day", "slope", "intercept", F.explode(F.sequence(F.lit(1), F.lit(days))).alias("step")
    ).select(
        *series,
        F.expr("date_add(last_day, step)").alias("extraction_date"),
        F.lit(None).cast("double").alias("price"),
        F.greatest(
            F.col("slope") * (F.col("n") + F.col("step") - 1) + F.col("intercept"), F.lit(FLOOR)
        ).alias("forecasted_price"),
        F.lit(True).alias("is_forecast"),
    )
    history = daily.select(
        *series,
        "extraction_date",
        "price",
        F.col("price").alias("forecasted_price"),
        F.lit(False).alias("is_forecast"),
    )
    return history.unionByName(future)
