"""Logical dataset names, resolved to DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from lakeweir.sources.versions import read_table


@dataclass(frozen=True)
class Dataset:
    """Where a logical name lives.

    ``layout`` is one of

    * ``snapshot``: Parquet files at ``location``, no partition columns, as of its newest commit if it has any;
    * ``partitioned``: Hive-style folders by ``partition_by``, exposed as columns and prunable;
    * ``table``: a catalog table or view called ``location``;
    * ``jdbc``: a database table, read in ``options['numPartitions']`` ranges of
      ``options['partitionColumn']``.
    """

    location: str
    layout: str = "snapshot"
    schema: StructType | None = None
    partition_by: StructField | None = None
    options: dict[str, str] = field(default_factory=dict)


class Catalog:
    """One logical name to one DataFrame, whatever the layout behind it."""

    def __init__(self, spark: SparkSession, datasets: dict[str, Dataset] | None = None):
        self.spark = spark
        self.datasets = dict(datasets or {})

    def add(self, name: str, dataset: Dataset) -> None:
        self.datasets[name] = dataset

    def __getitem__(self, name: str) -> DataFrame:
        dataset = self.datasets.get(name)
        if dataset is None:
            raise KeyError(f"unknown dataset {name!r}; known: {sorted(self.datasets)}")
        if dataset.layout == "table":
            return self.spark.table(dataset.location)
        if dataset.layout == "jdbc":
            return self.spark.read.format("jdbc").options(**dataset.options, dbtable=dataset.location).load()
        if dataset.layout not in ("snapshot", "partitioned"):
            raise ValueError(f"{name}: layout {dataset.layout!r}")
        schema = dataset.schema
        if dataset.partition_by is not None and schema is not None:
            names = schema.fieldNames()
            if dataset.partition_by.name not in names:
                schema = StructType([*schema.fields, dataset.partition_by])
        return read_table(self.spark, dataset.location, schema, **dataset.options)
