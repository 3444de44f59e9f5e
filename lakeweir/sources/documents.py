"""Raw documents: JSON, HTML pages, dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.globStatus(hadoop_path))


def read_documents(spark: SparkSession, path: str, schema: StructType | str, *, lines: bool = False) -> DataFrame:
    """JSON documents, one per file or (``lines``) one per line; .gz is read by its suffix.

    A gzip file cannot be split, so large feeds should come as many files or as JSON lines.
    """
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(url, html) of whole HTML files below ``path``; the file name stands for the url."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("url"), F.col("value").alias("html")
    )


def read_map_dictionary(
    spark: SparkSession, path: str, key: str, value: StructType | str, *, lone: str | None = None
) -> DataFrame:
    """A dictionary document shaped as one object, {key: entry}: one row per key.

    ``value`` is the entry's schema as columns; with ``lone`` an entry is a plain value, which goes
    under that name. Entries of another shape are left out; a missing or unreadable file is an
    empty dictionary.
    """
    fields = value if isinstance(value, StructType) else StructType.fromDDL(value)
    schema = StructType([StructField(key, StringType()), *fields.fields])
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    texts = spark.read.text(path, wholetext=True)
    pairs = texts.select(F.explode(F.from_json("value", "map<string,string>")).alias(key, "__entry"))
    if lone is not None:
        plain = pairs.where(~F.trim("__entry").rlike(r"^[{\[]"))
        return plain.select(key, F.col("__entry").try_cast(fields[lone].dataType).alias(lone))
    objects = pairs.where(F.ltrim("__entry").startswith("{"))
    return objects.select(key, F.from_json("__entry", fields).alias("__entry")).select(key, "__entry.*")


def read_dictionaries(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The dictionaries of the ingestion jobs from their documents below ``folder``.

    ``dictionary.json`` lists phenomena and colors; ``departments.json``, ``risk_types.json`` and
    ``gie_mapping.json`` are objects by code, risk key and store. A store's entry is a department
    code (``stores``, for alerts) or an object with its commune (``store_places``, for risks).
    """
    listed = read_dictionary(
        spark, f"{folder}/dictionary.json",
        "phenomenons array<struct<id: string, name: string>>, colors array<struct<id: string, name: string, level: int, hexaCode: string>>",
    )
    stores = f"{folder}/gie_mapping.json"
    places = read_map_dictionary(spark, stores, "gie_name", "insee_code string, commune string, postal_code string")
    codes = read_map_dictionary(spark, stores, "gie_name", "department_code string", lone="department_code")
    return {
        "phenomena": listed.select(F.inline("phenomenons")),
        "colors": listed.select(F.inline("colors")),
        "departments": read_map_dictionary(spark, f"{folder}/departments.json", "code", "name string, region string"),
        "risk_types": read_map_dictionary(spark, f"{folder}/risk_types.json", "key", "label string", lone="label"),
        "stores": codes,
        "store_places": places,
    }


def read_dictionary(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Dictionary document; a missing or unreadable file is an empty dictionary."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)
