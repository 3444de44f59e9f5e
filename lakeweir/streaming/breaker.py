"""Breaker states kept up to date from a stream of calls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from lakeweir.operators.breaker import COOLDOWN, MAX_FAILURES, breaker_states
from lakeweir.sources.documents import path_exists


def latest_states(states: DataFrame, before: int | None = None) -> DataFrame:
    """States after the newest micro-batch, or after the newest one before ``before``."""
    if before is not None:
        states = states.where(F.col("batch") < before)
    newest = states.agg(F.max("batch").alias("b")).scalar()
    return states.where(F.col("batch") == newest).drop("batch")


def breaker_stream(
    calls: DataFrame,
    path: str,
    checkpoint: str,
    *,
    at: str = "ts",
    order: list[str] | None = None,
    max_failures: int = MAX_FAILURES,
    cooldown: float = COOLDOWN,
) -> StreamingQuery:
    """Start a query that writes every source's state after each micro-batch below ``path``.

    A micro-batch runs through the same parallel operator as a whole history, starting from the
    states before it, so no source's calls are gathered in one task. Each micro-batch replaces
    its own folder, which makes running one again harmless. States are as of the micro-batch's
    last call; read them with ``latest_states``.
    """

    def follow(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        initial = None
        if path_exists(spark, path):
            initial = latest_states(spark.read.schema(_SCHEMA).parquet(path), number)
        last = batch.agg(F.max(at).alias("last")).first()["last"]
        if last is None:
            return
        states = breaker_states(
            batch, F.lit(last).cast("timestamp_ntz"), at=at, order=order, max_failures=max_failures,
            cooldown=cooldown, initial=initial,
        )
        (
            states.withColumn("batch", F.lit(number).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(path)
        )

    return (
        calls.writeStream.foreachBatch(follow)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


_SCHEMA = (
    "source string, state string, failure_count bigint, trips bigint, last_failure_at timestamp_ntz, batch bigint"
)
