"""A training corpus from raw documents: each stage is one operator, written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeweir.llm import decontamination, mixing, near_dedup, sharding, toxicity
from lakeweir.llm.common import table
from lakeweir.session import scratch, working_path
from lakeweir.sources.versions import remove


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text the factorization machine does not reject."""
    return toxicity.keep_harmless(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return near_dedup.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once per copy that the mix takes, in the order of training."""
    return mixing.mix(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and slot."""
    return sharding.shard_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]

# The trained classifier, signatures and drawn permutations have no SQL form; tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents. What a stage wrote on its way goes when its rows are written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = working_path(spark, f"pipeline-{name}")
        with scratch(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
