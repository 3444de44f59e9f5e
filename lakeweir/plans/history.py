"""Extraction history per commune as a state that each extraction is merged into."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeweir.sources import versions

STATE = "insee_code string, dates array<date>, latest struct<extraction_date: date, overall_max_severity: int>"
MARK = "commune_history#newest_day"
_EPOCH = "1970-01-01"


def history_of(profiles: DataFrame) -> DataFrame:
    """State of staged profiles: per commune its distinct dates in order, and its newest severity."""
    worst = F.greatest("max_severity_naturels", "max_severity_technologiques")
    return profiles.groupBy("insee_code").agg(
        F.array_sort(F.collect_set("extraction_date")).alias("dates"),
        F.max(F.struct("extraction_date", worst.alias("overall_max_severity"))).alias("latest"),
    )


def merged_history(state: DataFrame, more: DataFrame) -> DataFrame:
    """Both states as one. The order of merging does not matter, and merging again changes nothing."""
    dates = F.array_sort(F.array_distinct(F.flatten(F.collect_list("dates"))))
    return state.unionByName(more).groupBy("insee_code").agg(dates.alias("dates"), F.max("latest").alias("latest"))


def refresh_history(spark: SparkSession, profiles: DataFrame, path: str, since: str | None = None) -> DataFrame:
    """Merge the extractions of staged ``profiles`` from the newest merged day on into the state at ``path``.

    The day itself is merged again, as it may have been extracted again. ``since`` goes back further,
    for days that were filled in late. Older dates are not read: the day is a literal, so it prunes
    partitions. A commune's state grows by a date per extraction.
    """
    base, schema = versions.begin(spark, path), StructType.fromDDL(STATE)
    mark = base[0].ledger.get(MARK) if base[0] else None
    rows = profiles
    if since is not None:
        rows = profiles.where(F.col("extraction_date") >= F.lit(since).cast("date"))
    elif mark is not None:
        rows = profiles.where(F.col("extraction_date") >= F.date_add(F.lit(_EPOCH).cast("date"), mark))
    newest = rows.agg(F.max(F.unix_date("extraction_date"))).first()[0]
    if newest is None:
        return versions.read_table(spark, path, schema) if base[0] else spark.createDataFrame([], schema)
    state = history_of(rows)
    if base[0] is not None:
        state = merged_history(versions.read_table(spark, path, schema), state)
    versions.commit(state, path, base=base, ledger={MARK: max(newest, mark if mark is not None else newest)})
    return versions.read_table(spark, path, schema)


def extraction_history(state: DataFrame) -> DataFrame:
    """The columns of ``marts.extraction_history`` from the state."""
    return state.select(
        "insee_code",
        F.array_min("dates").alias("first_extraction"),
        F.array_max("dates").alias("last_extraction"),
        F.size("dates").cast("long").alias("extraction_count"),
    )
