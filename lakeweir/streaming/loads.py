"""Landing files as a stream: keyed upserts and deduplication."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from lakeweir.sources import versions
from lakeweir.sources.sinks import upsert_table


def stream_files(
    spark: SparkSession, folder: str, schema: StructType, *, fmt: str = "parquet", pattern: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """New files below ``folder`` as a stream; ``files_per_batch`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def upsert_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    *,
    partition_by: str | None = None,
    newest_by: str | None = "extracted_at",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Start a query that upserts every micro-batch into the Parquet table at ``path``.

    The table's commits hold a ledger: the newest batch of every stream, by its checkpoint, written
    with the rows of that batch. A batch that the stream runs again, because it stopped before its
    own checkpoint, is found there and left out, so that it cannot undo what others wrote since.
    The query ends when all files that are there have been read.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        committed, _ = versions.begin(batch.sparkSession, path)
        if committed is not None and committed.ledger.get(checkpoint, -1) >= batch_id:
            return
        rows = prepare(batch) if prepare else batch
        upsert_table(
            rows, path, rows.schema, keys, update_columns, partition_by=partition_by, newest_by=newest_by,
            ledger={checkpoint: batch_id},
        )

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedup_stream(stream: DataFrame, keys: Sequence[str], time_column: str, delay: str) -> DataFrame:
    """First row per key; keys are forgotten once the watermark is ``delay`` past them."""
    return stream.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(list(keys))


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Write everything that is there to Parquet at ``path``, then stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
