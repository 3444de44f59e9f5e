"""High-water incremental merge of the alert facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.operators.snapshot import above_high_water
from lakeweir.operators.upsert import upsert
from lakeweir.plans.marts import fct_alerts
from lakeweir.sources.documents import path_exists
from lakeweir.sources.sinks import upsert_table
from lakeweir.sources.versions import read_table

KEYS = ["alert_key", "extraction_date"]


def merge_new_alerts(target: DataFrame, alerts: DataFrame, lookback_days: int = 0) -> DataFrame:
    """``target`` facts with the staged alerts above its high-water date merged in by alert key.

    ``lookback_days=0`` leaves out same-day re-extractions; 1 merges the newest day again. The
    date is part of what ``alert_key`` hashes, so joining on both is joining on the key.
    """
    fresh = fct_alerts(above_high_water(alerts, "extraction_date", target, lookback_days))
    return upsert(target, fresh, KEYS)


def refresh_alert_facts(
    spark: SparkSession, alerts: DataFrame, path: str, lookback_days: int = 0, *, reread: bool = False
) -> None:
    """The same on a Parquet table partitioned by date; only touched dates are rewritten.

    The mark is read first and used as a literal, so the scan of ``alerts`` is pruned by it. ``reread``
    says that ``alerts`` are read from files with no shuffle, as a snapshot of staging is.
    """
    schema = fct_alerts(alerts).schema
    if path_exists(spark, path):
        mark = read_table(spark, path, schema).agg(F.max("extraction_date")).first()[0]
        if mark is not None:
            alerts = alerts.where(F.col("extraction_date") > F.date_sub(F.lit(mark), lookback_days))
    upsert_table(fct_alerts(alerts), path, schema, KEYS, partition_by="extraction_date", reread=reread)
