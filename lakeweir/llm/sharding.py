"""Sharding: a uniform shuffle with exact shard sizes. DataFrame functions only on the rows."""

from __future__ import annotations

import random
from itertools import accumulate
from math import exp, log, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeweir.llm.common import bucket_sums, ranked
from lakeweir.sources.sinks import staged

SHARDS = 8
SEED = 20
PARTITION_ROWS = 50_000  # rows that are permuted together, as long as that needs fewer partitions than
MOST_PARTITIONS = 4096  # this: the matrix has so many rows at most
CHUNK = 10_000  # copies of a row that one task numbers together
SLOT_BITS = 12  # leading bits of the second permutation's key: buckets of a shard


def size() -> Column:
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")


def checksum() -> Column:
    return F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long")


def hypergeometric(dice: random.Random, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` balls out of ``good`` and ``bad`` ones are good: inverse of the exact law.

    Probabilities follow from their ratios, going out from the most likely value until what is left
    is below rounding.
    """
    low, high = max(0, drawn - bad), min(drawn, good)
    if low == high:
        return low
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (good + bad + 2)))
    spread = sqrt(drawn * good * bad * max(1, good + bad - drawn)) / (good + bad) ** 1.5 + 1
    reach = int(14 * spread) + 14
    odds, value = {mode: 0.0}, 0.0
    for k in range(mode, min(high, mode + reach)):
        value += log(good - k) + log(drawn - k) - log(k + 1) - log(bad - drawn + k + 1)
        odds[k + 1] = value
    value = 0.0
    for k in range(mode, max(low, mode - reach), -1):
        value += log(k) + log(bad - drawn + k) - log(good - k + 1) - log(drawn - k + 1)
        odds[k - 1] = value
    places = sorted(odds)
    sums = list(accumulate(exp(odds[k]) for k in places))
    point = dice.random() * sums[-1]
    return next(k for k, s in zip(places, sums) if s >= point)


def communication_matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows that each partition sends to each shard: drawn as if all rows were permuted at once.

    Row sums are ``counts``; column sums are exact shard sizes, at most one apart.
    """
    dice, total = random.Random(seed), sum(counts)
    room = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = []
    for count in counts:
        row, left, space = [], count, sum(room)
        for j in range(shards):
            space -= room[j]
            got = hypergeometric(dice, room[j], space, left)
            row.append(got)
            left -= got
        room = [r - g for r, g in zip(room, row)]
        matrix.append(row)
    return matrix


SAME = ["doc_id", "__size", "__crc"]
COPY = "__copy"


def _key(name: str, seed: int, copy: bool = True) -> Column:
    """Hash of a row; with ``copy`` equal rows differ by their number, so they are permuted like any others."""
    return F.xxhash64(F.lit(f"{name}-{seed}"), F.col("doc_id"), F.col("__crc"), F.col("__size"), *([F.col(COPY)] if copy else []))


def numbered(rows: DataFrame) -> DataFrame:
    """Rows of the columns SAME alone, equal ones numbered from 0 in COPY.

    Equal rows are counted, which combines before its shuffle, and dealt out again in chunks, so that
    no task makes all copies of a row, even if a third of all rows are one.
    """
    counted = rows.groupBy(*SAME).agg(F.count("*").alias("__n"))
    chunks = counted.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / CHUNK))))
    first = F.col("__chunk") * CHUNK
    numbers = F.sequence(first, F.least(first + CHUNK, F.col("__n")) - 1)
    return chunks.repartition(*SAME, "__chunk").select(*SAME, F.explode(numbers).alias(COPY))


def _placed(rows: DataFrame, partitions: int, cuts: DataFrame, shards: int, seed: int) -> DataFrame:
    """Permute each partition and deal its rows out: the first ones to shard 0, and so on.

    ``cuts`` is broadcast: it has at most MOST_PARTITIONS rows of one number per shard.
    """
    local = Window.partitionBy("__part").orderBy("__local")
    dealt = rows.withColumn("__part", _part(rows, partitions, seed))
    if COPY not in rows.columns:
        # Equal rows are in one partition then, and are numbered there; dealt out once for both windows.
        dealt = dealt.repartition("__part").withColumn(COPY, F.row_number().over(Window.partitionBy("__part", *SAME).orderBy("__crc")).cast("long"))
    dealt = dealt.withColumn("__local", _key("local", seed))
    ordered = dealt.withColumn("__row", F.row_number().over(local) - 1)
    shard = sum([(F.col("__row") >= F.col("__cuts")[j]).cast("int") for j in range(shards - 1)], F.lit(0))
    return (
        ordered.join(F.broadcast(cuts), F.col("__part") == F.col("__of"))
        .withColumn("__shard", shard.cast("int"))
        .withColumn("__again", _key("again", seed))
        .drop("__part", "__local", "__row", "__of", "__cuts")
    )


def _part(rows: DataFrame, partitions: int, seed: int) -> Column:
    return F.pmod(_key("part", seed, COPY in rows.columns), F.lit(partitions))


def shuffle_rows(rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Rows with doc_id, __size and __crc, and their __shard and __slot.

    Partitions are hash classes of the row, so reruns and retries see the same ones. Equal rows differ
    by a number (COPY, made here if the rows have none) in both permutations. The driver
    holds one count per partition and shard, no more than MOST_PARTITIONS times ``shards``. Slots
    come from a second permutation in buckets. ``rows`` is read three times, twice without
    the columns that only travel along; equal rows are interchangeable.
    """
    narrow = rows.select(*SAME, *([COPY] if COPY in rows.columns else []))
    partitions = max(shards, min(MOST_PARTITIONS, -(-rows.count() // PARTITION_ROWS)))
    found = {r["part"]: r["n"] for r in narrow.groupBy(_part(rows, partitions, seed).alias("part")).agg(F.count("*").alias("n")).collect()}
    counts = [found.get(p, 0) for p in range(partitions)]
    matrix = communication_matrix(counts, shards, seed)
    cuts = rows.sparkSession.sql(_literal_rows(matrix))
    bucket = F.shiftright("__again", 64 - SLOT_BITS)
    one = F.lit(1)
    sums = staged(bucket_sums(_placed(narrow, partitions, cuts, shards, seed), ["__shard"], bucket, one), "shard-sums")
    placed = _placed(rows, partitions, cuts, shards, seed)
    return ranked(placed, sums, ["__shard"], ["__again"], bucket, one, "__slot")


def _literal_rows(matrix: list[list[int]]) -> str:
    """The cuts of every partition as literals: rows the JVM makes, which no Python worker has to serve."""
    rows = ",".join(f"({p}L, array({','.join(f'{n}L' for n in accumulate(row))}))" for p, row in enumerate(matrix))
    return f"SELECT * FROM VALUES {rows} AS cuts(__of, __cuts)"


def assign_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Every assignment with these shard sizes is equally likely over the seeds; the law is ``rows``:
    counts differ by at most one. A null text has size 1 and crc 0; null ids are hashed as null;
    repeated rows are placed like any others; an empty table gives an empty result.
    """
    narrow = staged(numbered(docs.select("doc_id", size().alias("__size"), checksum().alias("__crc"))), "shard-rows")
    return shuffle_rows(narrow, shards, seed).select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("__shard").alias("shard"),
        F.col("__slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, all columns, with shard and slot (in place of columns of these names).

    Null texts have size 1 and checksum 0, null ids are hashed as null; rows that repeat are permuted
    like any others; an empty table gives an empty result.
    """
    own = [c for c in docs.columns if not c.startswith("__") and c not in ("shard", "slot")]
    rows = docs.select(*own, size().alias("__size"), checksum().alias("__crc"))
    placed = shuffle_rows(rows, shards, seed)
    return placed.select(*own, F.col("__shard").alias("shard"), F.col("__slot").alias("slot"))
