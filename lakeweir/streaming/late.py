"""Deduplication of a stream with a moving watermark; late rows go to a table of their own instead of being lost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from lakeweir.operators.snapshot import keep_first
from lakeweir.session import working_path
from lakeweir.sources import versions

LATE_BY = "late_micros"
BATCH = "batch"


def _micros(time_column: str) -> Column:
    return F.unix_micros(F.col(time_column).cast("timestamp"))


def dedup_with_late_rows(
    stream: DataFrame, path: str, late_path: str, checkpoint: str, keys: Sequence[str], time_column: str, delay_seconds: int,
    *, partition_by: str, order: Sequence[str] = (),
) -> StreamingQuery:
    """Start a query that keeps the earliest row per key at ``path`` and puts late rows to ``late_path``.

    * The watermark of a batch is the greatest time of all batches before it, less the delay. Rows
      below it are late, and so are rows without a time once there is a watermark: they are written
      with all their columns, the batch and by how much they are late (``late_micros``).
    * Of all other rows, of any batch, the earliest per key stays; ``order`` and then the rows'
      other columns decide between equal times, so the table does not depend on how rows are dealt
      to batches, but for what is late.
    * ``partition_by`` is part of the key. Only partitions that a batch has rows of are read and
      written again, and rows on time lie in those the watermark has not passed, so the work of a
      batch follows the delay and not the table.
    * Watermark and batch number are committed with the batch's rows. A batch that runs again finds
      itself committed and leaves the table alone; its late rows replace themselves.
    """
    if partition_by not in keys:
        raise ValueError("the partition column has to be part of the key")
    mark_name = f"{checkpoint}#watermark"
    rest = [c for c in stream.columns if c not in keys and c != time_column and c not in order]
    picked_by = [time_column, *order, *rest]

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        base = versions.begin(spark, path)
        ledger = base[0].ledger if base[0] else {}
        if ledger.get(checkpoint, -1) >= batch_id:
            return
        own = working_path(spark, "late-batch")
        batch.write.parquet(own)
        rows = spark.read.schema(batch.schema).parquet(own)
        mark, micros = ledger.get(mark_name), _micros(time_column)
        late = F.lit(False) if mark is None else F.coalesce(micros < mark, F.lit(True))
        if mark is not None:
            aside = rows.where(late).withColumns({LATE_BY: F.lit(mark) - micros, BATCH: F.lit(batch_id).cast("long")})
            versions.commit(aside, late_path, [BATCH])
        fresh = rows.where(~late)
        # One row per folder that the batch touches.
        touched = [r[0] for r in fresh.select(partition_by).distinct().collect()]
        if base[0] is not None:
            hit = F.col(partition_by).isin([t for t in touched if t is not None])
            held = versions.read_table(spark, path, batch.schema)
            fresh = held.where(hit | F.col(partition_by).isNull() if None in touched else hit).unionByName(fresh)
        newest = rows.agg(F.max(micros)).first()[0]
        known = [m for m in (mark, None if newest is None else newest - delay_seconds * 1_000_000) if m is not None]
        moved = {mark_name: max(known)} if known else {}
        versions.commit(
            keep_first(fresh, list(keys), picked_by), path, [partition_by], base=base, ledger={checkpoint: batch_id, **moved}
        )
        versions.remove(spark, own)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_rows(spark: SparkSession, late_path: str, schema) -> DataFrame:
    """The late rows so far; none if no batch had any."""
    if not versions.exists(spark, late_path):
        return spark.createDataFrame([], schema).withColumns({LATE_BY: F.lit(0).cast("long"), BATCH: F.lit(0).cast("long")})
    return versions.read_table(spark, late_path)


def late_counts(late: DataFrame) -> DataFrame:
    """Per batch: number of late rows and by how much the latest one came late."""
    return late.groupBy(BATCH).agg(F.count("*").alias("late_rows"), F.max(LATE_BY).alias("most_late_micros"))
