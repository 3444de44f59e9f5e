"""Sinks on plain Parquet: snapshots, partitions, keyed upserts, logs, quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeweir.functions.times import date_parts
from lakeweir.operators.upsert import upsert
from lakeweir.session import working_path
from lakeweir.sources import versions
from lakeweir.sources.documents import path_exists
from lakeweir.sources.schemas import LANDING


def replace_snapshot(df: DataFrame, path: str) -> None:
    """Replace the Parquet snapshot at ``path``, whole or not at all. ``df`` may read ``path``."""
    versions.commit(df, path)


# Fixed value: of so many partitions every task may write a file of its own, so that no shuffle has to gather them.
FEW_PARTITIONS = 31


def few_values(column: DataFrame) -> bool:
    """Whether a frame of partition values holds FEW_PARTITIONS of them at most."""
    return column.distinct().limit(FEW_PARTITIONS + 1).count() <= FEW_PARTITIONS


def replace_partitions(
    df: DataFrame, path: str, by: str | Sequence[str], also: Sequence[str] = (), *, gather: bool = True
) -> None:
    """Replace only the partitions present in ``df``, all of them or none; all others stay as they are.

    ``also`` names folders of partitions that are replaced even if ``df`` has no row of them. Rows that
    come from files of the same partitions need not be gathered by a shuffle again (``gather=False``).
    """
    versions.commit(df, path, [by] if isinstance(by, str) else list(by), also=also, gather=gather)


def upsert_table(
    batch: DataFrame,
    path: str,
    schema: StructType,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    *,
    partition_by: str | None = None,
    newest_by: str | None = "extracted_at",
    strict: bool = False,
    stamps: Sequence[str] = (),
    guards: Mapping[str, Column] | None = None,
    ledger: Mapping[str, int] | None = None,
    reread: bool = False,
    settled: Sequence | None = None,
) -> None:
    """Upsert ``batch`` into the Parquet table at ``path``, whole or not at all.

    With ``partition_by`` (part of the key) only the partitions named in the batch are read and
    rewritten; the batch is then written once to the shared folder, so that what it is derived from
    runs once for its partitions and its rows. A batch that is read from files with no shuffle
    (``reread``) is read twice instead. Up to FEW_PARTITIONS are written by the tasks that merge the
    rows; more are gathered by a shuffle first. Where the table has none of the batch's partitions yet,
    rows that are alone with their key are not shuffled. A batch with its partitions named (``settled``) is as
    an upsert into an empty table would leave it, dealt to tasks by partition: there it is written as it stands.
    """
    spark = batch.sparkSession
    if partition_by is not None and partition_by not in keys:
        raise ValueError("the partition column has to be part of the key")
    base = versions.begin(spark, path)
    target, by, own, gather, alone = _stored(spark, path, schema), [], None, True, None
    if partition_by is not None:
        by = [partition_by]
        if not reread:
            own = working_path(spark, "upsert")
            batch.write.parquet(own)
            batch = spark.read.schema(batch.schema).parquet(own)
        # Partition values are few (one folder each), so they fit the driver.
        touched = [r[0] for r in batch.select(partition_by).distinct().collect()] if settled is None else [*settled]
        hit = F.col(partition_by).isin([t for t in touched if t is not None])
        target = target.where(hit | F.col(partition_by).isNull() if None in touched else hit)
        gather = len(touched) > FEW_PARTITIONS
        if _untouched(spark, path, partition_by, touched):
            if settled is not None:
                alone, gather = batch, False
            else:
                alone, batch = _standing_alone(batch, keys)
    if alone is not None:
        alone = alone.select(*[F.col(c).cast(t).alias(c) for c, t in target.dtypes])
    if alone is not None and settled is not None:
        merged = alone
    else:
        merged = upsert(target, batch, keys, update_columns, newest_by=newest_by, strict=strict, stamps=stamps, guards=guards)
        if alone is not None:
            merged = alone.unionByName(merged)
    versions.commit(merged, path, by, base=base, ledger=ledger, gather=gather)
    if own is not None:
        versions.remove(spark, own)


# Fixed value: repeated keys of a batch that are sent to all tasks at most.
REPEATED_KEYS = 100_000


def _untouched(spark: SparkSession, path: str, partition_by: str, values: Sequence) -> bool:
    """Whether the table has none of the partitions; said of dates and whole numbers only, whose folders are named as they are."""
    if any(type(v) not in (date, int) for v in values):
        return False
    return not {f"{partition_by}={v}" for v in values} & set(versions.data_children(spark, path))


def _standing_alone(batch: DataFrame, keys: Sequence[str]) -> tuple[DataFrame | None, DataFrame]:
    """(rows that are the only one of their key, all others) of a batch, None and all if too many keys repeat.

    Only keys are shuffled for it. Where the table has no rows to merge with, a row alone with its key
    is stored as it stands; whole rows are shuffled for repeated keys, and keys with a NULL.
    """
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    counted = batch.where(whole).groupBy(*keys).agg(F.count("*").alias("__n"))
    repeated = staged(counted.where("__n > 1").select(*keys), "repeated-keys")
    n = repeated.count()
    if n > REPEATED_KEYS:
        return None, batch
    partial = batch.where(~whole)
    if not n:
        return batch.where(whole), partial
    few = F.broadcast(repeated)
    again = batch.where(whole).join(few, list(keys), "left_semi")
    return batch.where(whole).join(few, list(keys), "left_anti"), again.unionByName(partial)


def _stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return versions.read_table(spark, path, schema) if path_exists(spark, path) else spark.createDataFrame([], schema)


LANDING_STAMPS = ("id", "extracted_at", "created_at")


def landing_rows(batch: DataFrame, name: str, created_at: Column | None = None) -> DataFrame:
    """Rows as the landing table ``name`` stores them.

    ``id`` is a hash of the natural key, NULLs marked, and of all columns but the stamps where the
    key has a NULL, so a rerun gives the same ids. ``created_at`` defaults to the time of extraction.
    """
    table = LANDING[name]
    if not table.row_id:
        return batch.select(*table.columns)
    key = [part for k in table.key for part in (F.col(k), F.col(k).isNull())]
    partial = reduce(or_, [F.col(k).isNull() for k in table.key])
    others = [c for c in table.columns if c not in table.key and c not in LANDING_STAMPS]
    number = F.when(partial, F.xxhash64(*key, *others)).otherwise(F.xxhash64(*key))
    stamp = F.col("extracted_at") if created_at is None else created_at
    return batch.select(number.alias("id"), *table.columns, stamp.alias("created_at"))


def upsert_landing(
    batch: DataFrame, base: str, name: str, *, strict: bool = False, created_at: Column | None = None,
    ledger: Mapping[str, int] | None = None, reread: bool = False, settled: Sequence | None = None,
) -> None:
    """Upsert into the landing table ``name`` below ``base`` by its own key and updated columns."""
    table = LANDING[name]
    dated = "extraction_date" if "extraction_date" in table.key else None
    upsert_table(
        landing_rows(batch, name, created_at), f"{base}/{name}", table.landing_schema, table.key, table.updated_columns(),
        partition_by=dated, strict=strict, stamps=LANDING_STAMPS, guards={c: F.expr(sql) for c, sql in table.guards},
        ledger=ledger, reread=reread, settled=settled,
    )


def read_landing(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The landing table ``name`` below ``base``, empty if nothing has been landed."""
    return _stored(spark, f"{base}/{name}", LANDING[name].landing_schema)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, for rows that several outputs need."""
    path = working_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_documents(
    df: DataFrame, base: str, domain: str, source: str, date_text: Column | str, run_date: Column | str
) -> None:
    """gzip JSON lines below domain=/source=/year=/month=/day=.

    ``date_text`` is ISO text; rows whose text is no date go under ``run_date``.
    """
    text = F.col(date_text) if isinstance(date_text, str) else date_text
    run = F.lit(run_date).cast("date") if isinstance(run_date, str) else run_date
    parts = {"domain": F.lit(domain), "source": F.lit(source), **date_parts(text, run)}
    (
        df.withColumns({f"__{k}": v for k, v in parts.items()})
        .withColumnsRenamed({f"__{k}": k for k in parts})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .partitionBy(*parts)
        .json(base)
    )


def append_log(df: DataFrame, path: str, stamp: str, as_of: str) -> None:
    """Append monitoring rows stamped with ``as_of``, one folder per day."""
    stamped = df.withColumn(stamp, F.lit(as_of).cast("timestamp_ntz")).withColumn(
        "log_date", F.lit(as_of).cast("timestamp_ntz").cast("date")
    )
    stamped.write.mode("append").partitionBy("log_date").parquet(path)


def latest_entries(log: DataFrame, stamp: str, keep: int = 1000) -> DataFrame:
    """The newest ``keep`` log entries; the log keeps all of them, readers take the tail."""
    rest = [F.col(c) for c in log.columns if c != stamp]
    return log.orderBy(F.col(stamp).desc(), *rest).limit(keep)


def split_quarantine(
    flagged: DataFrame, clean_path: str, quarantine_path: str, helpers: Sequence[str] = ("is_anomaly", "anomaly_reasons")
) -> None:
    """Write rows flagged in ``helpers[0]`` to quarantine and the others, without helpers, to ``clean_path``.

    The flagged rows are written once to the shared folder, so the scan and the statistics behind
    the flag run once and both outputs see the same flags.
    """
    spark = flagged.sparkSession
    staged = working_path(spark, "quarantine")
    flagged.write.parquet(staged)
    rows = spark.read.schema(flagged.schema).parquet(staged)
    replace_snapshot(rows.where(F.col(helpers[0])), quarantine_path)
    replace_snapshot(rows.where(~F.col(helpers[0])).drop(*helpers), clean_path)
    versions.remove(spark, staged)


def write_report_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Replace a serving table in a database, keeping its definition (truncate, then insert)."""
    df.write.format("jdbc").options(url=url, dbtable=table, truncate="true", **options).mode("overwrite").save()


def materialize(df: DataFrame, name: str, kind: str = "view", **incremental) -> None:
    """Make a model known by name: ``view``, ``table`` or ``incremental``.

    ``incremental`` takes the arguments of ``upsert_table`` and registers its files as a view.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        df.write.mode("overwrite").saveAsTable(name)
    elif kind == "incremental":
        upsert_table(df, schema=df.schema, **incremental)
        versions.read_table(spark, incremental["path"], df.schema).createOrReplaceTempView(name)
    else:
        raise ValueError(f"{name}: kind {kind!r}")
