"""Keyed upsert as a pure DataFrame function."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """A batch names one key twice and strict mode is on."""


def _complete(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def check_unique(batch: DataFrame, keys: Sequence[str]) -> None:
    repeated = batch.where(_complete(keys)).groupBy(*keys).count().where("count > 1").limit(1).collect()
    if repeated:
        raise DuplicateKeyError(f"key repeated in one batch: {repeated[0].asDict()}")


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    *,
    newest_by: str | None = "extracted_at",
    strict: bool = False,
    stamps: Sequence[str] = (),
    guards: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``target`` after inserting ``batch``; a key already there has ``update_columns`` replaced.

    * ``update_columns=None`` updates every column outside the key, ``[]`` keeps existing rows.
      ``guards`` name a condition for columns that not every new row may update.
    * New values win even when NULL: presence decides, not ``coalesce``.
    * Rows with a NULL in the key never match a row that differs from them: all their columns but
      ``stamps``, compared null-safely, are their identity. So each is inserted, equal ones as
      often as they stand in the batch, and the same batch again changes nothing.
    * Within a batch the row with the greatest ``newest_by`` wins, then the greatest row;
      ``strict`` raises instead.

    Both inputs are read once: their union, marked by side, is reduced to one row per identity by
    an aggregate that combines before its shuffle. A key repeated very often costs one row per
    task, and rows with a NULL in the key spread by their other columns.
    """
    columns, kinds = target.columns, {f.name: f.dataType for f in target.schema.fields}
    rest = [c for c in columns if c not in keys]
    if update_columns is None:
        update_columns = rest
    unknown = (set(update_columns) | set(keys)) - set(columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    if strict:
        check_unique(batch, keys)
    sides = [
        target.select(*columns, F.lit(False).alias("__fresh")),
        batch.select(*[F.col(c).cast(kinds[c]).alias(c) for c in columns], F.lit(True).alias("__fresh")),
    ]
    others = [c for c in rest if c not in stamps]
    alone = F.when(~_complete(keys), F.struct(*others)) if others else F.lit(None)
    row = F.struct(*sorted(rest, key=lambda c: c != newest_by), F.lit(True).alias("__there"))
    merged = (
        sides[0]
        .unionByName(sides[1])
        .groupBy(*keys, alone.alias("__alone"))
        .agg(
            F.max(F.when(~F.col("__fresh"), row)).alias("__old"),
            F.max(F.when(F.col("__fresh"), row)).alias("__new"),
            F.count_if(~F.col("__fresh")).alias("__n_old"),
            F.count_if(F.col("__fresh")).alias("__n_new"),
        )
    )

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        before, after = F.col(f"__old.{c}"), F.col(f"__new.{c}")
        if c not in update_columns:
            return F.when(F.col("__old").isNotNull(), before).otherwise(after).alias(c)
        takes = F.col("__new").isNotNull()
        if guards and c in guards:
            takes = takes & (F.col("__old").isNull() | guards[c])
        return F.when(takes, after).otherwise(before).alias(c)

    copies = F.when(_complete(keys), 1).otherwise(F.greatest("__n_old", "__n_new")).cast("int")
    return merged.withColumn("__copy", F.explode(F.sequence(F.lit(1), copies))).select(*[value(c) for c in columns])
