"""Exact deduplication as a stateful stream: digests in disk-backed state, full texts compared on hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.session import working_path
from lakeweir.sources.sinks import staged

# State lives in an embedded store on the executor's disk, with bounded memory and its changes in the checkpoint.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    # Many small stores would each reserve megabytes of disk ahead.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.metricsEnabled": "false",
}
BYTES_PER_BATCH = 64 << 30


def whole_text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own for the state settings; the caller's stay as they are."""
    session = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.session.timeZone"):
        if (value := spark.conf.get(key, None)) is not None:
            session.conf.set(key, value)
    for key, value in STATE.items():
        session.conf.set(key, value)
    return session


def digest_classes(spark: SparkSession, path: str, digest=sha256, checkpoint: str | None = None, **reader) -> DataFrame:
    """Stream the Parquet table at ``path`` and keep, for every digest seen, its state.

    State per digest, without expiry: how many rows, and the row that stays - its doc_id as stable
    identifier and the file and row of its content as locator. Rows of a batch combine before they
    reach the state, so a group with a third of all rows sends one row per task. Batches append
    what changed; both counts and ids only grow, so the newest state of a digest is its largest.
    With the same ``checkpoint`` a later run takes only new files.
    """
    session = _stream_session(spark)
    base = checkpoint or working_path(spark, "exact-dedup")
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    options = reader or {"maxBytesPerTrigger": BYTES_PER_BATCH}
    # As a pattern that matches just this name, the source takes one file as well as a folder of files.
    rows = session.readStream.schema(schema).options(**options).parquet(f"{path[:-1]}[{path[-1]}]")
    seen = rows.select(
        digest(whole_text()).alias("digest"),
        F.struct(
            F.col("doc_id"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
        ).alias("stays"),
    )
    state = seen.groupBy("digest").agg(F.count("*").alias("n"), F.max("stays").alias("stays"))

    def append(batch: DataFrame, number: int) -> None:
        # Overwriting its own folder makes a repeated batch harmless.
        batch.write.mode("overwrite").parquet(f"{base}/classes/batch={number}")

    query = (
        state.writeStream.outputMode("update").trigger(availableNow=True)
        .option("checkpointLocation", f"{base}/state").foreachBatch(append).start()
    )
    query.awaitTermination()
    parts = spark.read.schema(
        "digest string, n long, stays struct<doc_id: long, file: string, row: long>, batch long"
    ).parquet(f"{base}/classes")
    newest = parts.groupBy("digest").agg(F.max("n").alias("group_size"), F.max("stays").alias("stays"))
    return newest if parts.select("batch").distinct().count() > 1 else parts.select(
        "digest", F.col("n").alias("group_size"), "stays"
    )


def deduplicate(spark: SparkSession, path: str, digest=sha256, checkpoint: str | None = None, **reader) -> DataFrame:
    """One row per row of the table at ``path``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; the row with the largest doc_id stays. Digests alone do not
    decide: every row whose digest was hit is compared in full with the content at the locator of
    its class, and if any differs the classes of that digest are formed again by their whole texts.
    Only rows of hit digests are written out and compared.

    A null text counts as empty; null ids are smaller than all others, so a null id stays only
    where its group has no other; of repeated rows with the largest id one is kept; an empty table
    gives an empty result.
    """
    docs = spark.read.parquet(path)
    if docs.isEmpty():
        empty = "doc_id long, keep_id long, group_size long, kept boolean, text_sha256 string"
        return spark.createDataFrame([], empty)
    classes = digest_classes(spark, path, digest, checkpoint, **reader)
    rows = docs.select(
        "doc_id",
        whole_text().alias("text"),
        digest(whole_text()).alias("digest"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    joined = rows.join(classes, "digest").select(
        "doc_id", "digest", "group_size",
        F.col("stays.doc_id").alias("keep_id"),
        ((F.col("file") == F.col("stays.file")) & (F.col("row") == F.col("stays.row"))).alias("kept"),
        F.when(F.col("group_size") > 1, F.col("text")).alias("text"),
        *([] if digest is sha256 else [sha256(F.col("text")).alias("text_sha256")]),
    )
    if digest is sha256:
        joined = joined.withColumn("text_sha256", F.col("digest"))
    found = staged(joined, "exact-rows")
    hit = found.where("group_size > 1").select("digest", "text", "kept")
    content = hit.where("kept").select("digest", F.col("text").alias("content"))
    collided = hit.join(content, "digest").where("text != content").select("digest").distinct()
    result = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    if collided.isEmpty():
        return found.select(*result)
    again = found.join(collided, "digest", "left_semi").select("doc_id", "text", "text_sha256", "kept")
    by_text = again.groupBy(F.col("text").alias("content")).agg(
        F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id")
    )
    split = again.join(by_text, F.col("text") == F.col("content"))
    one = split.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    rest = found.join(collided, "digest", "left_anti")
    return rest.select(*result).unionByName(one.select(*result))
