"""One large JSON object in one file, read by many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeweir.sources.sinks import staged


def object_members(spark: SparkSession, path: str) -> DataFrame:
    """The members of the JSON objects in the files at ``path``: path, position, document.

    Each ``document`` is a small JSON object with one member whose value is an object, behind any
    members before it that are scalars or arrays of scalars; ``position`` numbers them per file. A
    member with objects in an array is one document as well.

    The reader cuts files at closing braces, wherever its byte ranges fall, so every task of a file
    gets a run of pieces without knowing what stands before it. Whether a piece begins within a
    string follows from the number of quotes before it, and how deep it begins from the braces and
    brackets outside of strings before it. Both are sums: over the pieces of a range, in a window
    of one range, and over the ranges of a file, a row each. A member ends where a closing brace
    leaves the outermost object open alone; the pieces of one member are put together by its
    number. So a task holds a range's pieces or a member, never a file. Compressed files cannot be
    cut and are read by one task each.
    """
    quote = F.lit('"')
    bare = F.regexp_replace("text", r"(?s)\\.", "")  # a backslash takes the character after it along
    read = spark.read.option("lineSep", "}").text(path).select(
        F.col("value").alias("text"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("row"),
    )
    pieces = staged(
        read.withColumn("bare", bare).select(
            "path", "range", "row", "text",
            (F.length("bare") - F.length(F.replace("bare", quote, F.lit("")))).alias("quotes"),
            _opened(F.col("bare")).alias("steps"),
            _opened(F.concat(quote, F.col("bare"))).alias("steps_quoted"),
        ),
        "members-pieces",
    )
    # From here to the end only numbers move, a few octets per piece.
    begun = _counted(pieces.drop("text"), "quotes", "quotes_before")
    quoted, ends_quoted = F.col("quotes_before") % 2 == 1, (F.col("quotes_before") + F.col("quotes")) % 2 == 1
    brace = F.when(ends_quoted, 0).otherwise(1)
    deep = begun.select(
        "path", "range", "row", brace.alias("brace"),
        (F.when(quoted, F.col("steps_quoted")).otherwise(F.col("steps")) - brace).alias("deeper"),
    )
    placed = _counted(deep, "deeper", "depth")
    ends = ((F.col("brace") == 1) & (F.col("depth") + F.col("deeper") == 1)).cast("int")
    numbered = _counted(placed.select("path", "range", "row", ends.alias("ends")), "ends", "position")
    members = (
        pieces.select("path", "range", "row", "text")
        .join(numbered, ["path", "range", "row"])
        .groupBy("path", "position")
        .agg(F.array_sort(F.collect_list(F.struct("range", "row", "text"))).alias("pieces"), F.max("ends").alias("ends"))
    )
    body = F.regexp_replace(F.array_join(F.col("pieces.text"), "}"), r"\A\s*[{,]", "")
    return members.where(F.col("ends") == 1).select("path", "position", F.concat(F.lit("{"), body, F.lit("}}")).alias("document"))


def _opened(text: Column) -> Column:
    """Braces and brackets that a piece opens less those it closes, outside of strings."""
    outside = F.regexp_replace(text, r'(?s)"[^"]*("|\z)', "")
    return F.length(F.regexp_replace(outside, r"[^{\[]", "")) - F.length(F.regexp_replace(outside, r"[^}\]]", ""))


def _counted(pieces: DataFrame, column: str, into: str) -> DataFrame:
    """Add the sum of ``column`` over all earlier pieces of the file."""
    ranges = pieces.groupBy("path", "range").agg(F.sum(column).alias("__sum"))
    earlier = Window.partitionBy("path").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("path", "range", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"))
    within = Window.partitionBy("path", "range").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    counted = pieces.withColumn("__within", F.coalesce(F.sum(column).over(within), F.lit(0)))
    return counted.join(offsets, ["path", "range"]).withColumn(into, F.col("__within") + F.col("__offset")).drop("__within", "__offset")
