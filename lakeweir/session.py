"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Semantics (time zone, partition typing, overwrite scope), run-time re-planning and files that take less room.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

# Sizes for a large cluster: many small shuffle partitions that adaptive execution merges to the
# advisory size, so a shuffle of any size gets partitions that fit an executor.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's settings to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """Session for jobs of our own; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        given = spark.sparkContext.getConf()
        for key, value in CLUSTER_SETTINGS.items():
            if not given.contains(key):
                spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it in spark.checkpoint.dir.

    A local session without the setting gets a temporary folder. A cluster session without it is
    an error, since a machine-local path would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="lakeweir-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_handed_out: list[str] = []


def working_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what jobs within wrote to working paths. Frames that read it must have been written by then."""
    before = len(_handed_out)
    try:
        yield
    finally:
        made = _handed_out[before:]
        del _handed_out[before:]
        for path in made:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
