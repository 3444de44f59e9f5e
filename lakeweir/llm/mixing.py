"""Mixing sources to target weights along a curriculum. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeweir.llm.common import WORD, bucket_sums, ranked
from lakeweir.sources.sinks import staged

WEIGHTS = (3, 1, 2)  # of the sources in order of their names, repeating; null comes last
SHARE = 1.5  # words of the mix against all words
MOST = 2  # times a source, and so a document, may be taken
SLOPES = (0.6, 0.0, -0.6)  # of the weight schedules, repeating: positive sources come late


def size() -> Column:
    """Words of a text."""
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def order() -> Column:
    """The order of a source's documents: by a digest of the id."""
    return F.coalesce(F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit(""))


def bucket() -> Column:
    """The first three digits of the order."""
    return F.coalesce(F.conv(F.substring("__order", 1, 3), 16, 10).cast("int"), F.lit(-1))


def _cycle(place: Column, values: Sequence[float]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(place - 1, F.lit(len(values))) + 1).cast("int"))


def targets(sizes: DataFrame) -> DataFrame:
    """Words to take of each source, from ``sizes`` (source, source_size): one row per source.

    The mix is shared by weight; sources that would be taken more than MOST times stop there and
    the rest is shared again. With sources ordered by the level at which they stop, the capped ones
    come first, so the final level follows from running sums instead of rounds.
    """
    every = Window.partitionBy()
    named = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weighed = (
        named.withColumn("weight", _cycle(F.col("place"), WEIGHTS))
        .withColumn("slope", _cycle(F.col("place"), [float(s) for s in SLOPES]))
        .withColumn("cap", F.col("source_size") * MOST)
        .withColumn("stop", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(every) * SHARE)
    )
    by_stop = Window.orderBy("stop", "place")
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    after = by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = weighed.withColumn(
        "level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    ).withColumn("capped", F.col("stop") <= F.col("level"))
    final = F.max(F.when(~F.col("capped"), F.col("level"))).over(every)
    shared = levels.withColumn(
        "target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * final)
    )
    return shared.withColumn("tilt", F.sum(F.col("target") * F.col("slope")).over(every)).select(
        "source", "source_size", "target", "slope", "total", "tilt"
    )


def planned(sized: DataFrame) -> DataFrame:
    """Rows with doc_id, source and __size, and what the mix takes of them: __source_size, __target,
    __taken, __copies, and what positions need.

    A source's words are numbered in the order of the digests. Of the target, whole passes over
    the source are taken by every document, and the words that remain are the first of one more
    pass; there the last document is taken in part. ``sized`` is read twice, once for sums only.
    """
    marked = sized.withColumn("__source", F.col("source")).withColumn("__order", order())
    sums = staged(bucket_sums(marked, ["__source"], bucket(), F.col("__size")), "mix-sums")
    plan = targets(sums.groupBy(F.col("__source").alias("source")).agg(F.sum("__sum").alias("source_size")))
    plan = plan.withColumnsRenamed({c: f"__{c}" for c in plan.columns if c != "source"})
    plan = plan.withColumnRenamed("source", "__planned")
    placed = ranked(marked, sums, ["__source"], ["__order", "__size"], bucket(), F.col("__size"), "__before")
    passes = F.when(F.col("__source_size") > 0, F.floor(F.col("__target") / F.col("__source_size"))).otherwise(0)
    rest = F.round(F.col("__target") - F.col("__passes") * F.col("__source_size")).cast("long")
    extra = F.greatest(F.lit(0), F.least(F.col("__size"), rest - F.col("__before")))
    whole = F.col("__passes") * (F.col("__size") > 0).cast("int")
    more = (F.col("__extra") > 0) & (F.col("__extra") * 2 >= F.col("__size"))
    return (
        placed.join(plan, F.col("__source").eqNullSafe(F.col("__planned")))
        .withColumn("__passes", passes.cast("long"))
        .withColumn("__extra", extra)
        .withColumn("__taken", F.col("__passes") * F.col("__size") + F.col("__extra"))
        .withColumn("__copies", (whole + more.cast("int")).cast("int"))
    )


def position(turn: Column) -> Column:
    """Training position, in words of the mix, of a document's pass number ``turn``.

    A source's weight at time t in [0, 1] is 1 + slope * (2t - 1) of its mean, so its demand up to t
    is the integral t + slope * (t*t - t) of its target. The middle of the document's words is a
    share y of that demand; solving for t gives its time, and the demand of all sources up to t
    its position.
    """
    words = turn * F.col("__source_size") + F.col("__before") + F.col("__size") / 2
    y = F.least(F.lit(1.0), F.when(F.col("__target") > 0, words / F.col("__target")).otherwise(0.0))
    a = F.col("__slope")
    root = (a - 1 + F.sqrt((1 - a) * (1 - a) + 4 * a * y)) / (2 * a)
    t = F.when(a == 0, y).otherwise(root)
    return F.round(F.col("__total") * t + F.col("__tilt") * (t * t - t), 3)


def plan_mix(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, copies, position.

    ``taken`` counts words, repeats included, and sums to the source's target up to rounding;
    ``copies`` is how often the whole document stands in the mix; ``position`` is that of its
    first copy, null without one. Null texts have size 0 and are never taken; null sources are one
    source; null ids come first in their source; repeated rows each take their share; an empty
    table gives an empty result. Texts are read once; what is shuffled is narrow.
    """
    narrow = docs.select("doc_id", "source", size().alias("__size"))
    sized = planned(staged(narrow, "mix-sizes"))
    return sized.select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        F.col("__taken").alias("taken"),
        F.col("__copies").alias("copies"),
        F.when(F.col("__copies") > 0, position(F.lit(0))).alias("position"),
    )


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: the rows of ``docs``, all columns, once per copy, sorted by training position.

    A document whose last pass is partial stands there whole if at least half of it is taken.
    Columns whose names begin with two underscores are dropped. Texts are shuffled twice: into
    buckets of a source, and by ranges of the position.
    """
    own = [c for c in docs.columns if not c.startswith("__")]
    rows = planned(docs.select(*own, size().alias("__size"))).where(F.col("__copies") > 0)
    turns = rows.withColumn("__turn", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
    return turns.orderBy(position(F.col("__turn")), "__order").select(*own)
