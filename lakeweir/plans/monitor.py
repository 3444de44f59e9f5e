"""The source-health run: freshness, breaker states and quality scores, appended to their logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.operators import health
from lakeweir.operators.breaker import COOLDOWN, MAX_FAILURES, breaker_states
from lakeweir.sources.catalog import Catalog
from lakeweir.sources.sinks import append_log, staged


def source_health(
    spark: SparkSession,
    catalog: Catalog,
    metrics: DataFrame,
    calls: DataFrame,
    base: str,
    as_of: str,
    *,
    definitions: list[tuple] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Quality scores of all defined sources; freshness, breakers and scores are logged below ``base``.

    ``catalog`` holds the tables the definitions name, ``metrics`` the run metrics and ``calls``
    the (source, ts, ok) log of extraction calls.
    """
    stamp = F.lit(as_of).cast("timestamp_ntz")
    defined = health.source_definitions(spark, definitions)
    tables = health.readable_tables(catalog, definitions)
    if tables:
        last = health.last_extractions(tables).drop("row_count")
    else:
        last = spark.createDataFrame([], "source string, last_extraction timestamp_ntz")
    freshness = staged(health.assess_freshness(last, defined, stamp), "freshness")
    breakers = staged(breaker_states(calls, stamp), "breakers")
    scores = staged(
        health.quality_scores(
            health.health_inputs(freshness, health.latest_metrics(metrics), breakers, strict=strict)
        ),
        "scores",
    )
    append_log(freshness, f"{base}/source_freshness", "checked_at", as_of)
    status = breakers.select(
        "source", "state", F.col("failure_count").cast("int").alias("failure_count"),
        F.lit(MAX_FAILURES).alias("max_failures"), F.lit(COOLDOWN).alias("cooldown_seconds"),
    )
    append_log(status, f"{base}/breaker_status", "checked_at", as_of)
    append_log(scores, f"{base}/quality_scores", "computed_at", as_of)
    return scores
