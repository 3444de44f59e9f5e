"""Latest-snapshot and high-water filters, keep-first and latest-per-key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_snapshot(df: DataFrame, date_col: str, dates: DataFrame | None = None) -> DataFrame:
    """Rows at the greatest date of ``dates`` (default: of ``df`` itself).

    The date is a scalar subquery, which prunes date partitions; a cross join with a one-row
    aggregate would read them all.
    """
    source = df if dates is None else dates
    newest = source.agg(F.max(date_col).alias("newest")).scalar()
    return df.where(F.col(date_col) == newest)


def above_high_water(df: DataFrame, date_col: str, target: DataFrame, lookback_days: int = 0) -> DataFrame:
    """Rows dated after the target's greatest date, less ``lookback_days``.

    An empty target lets every row through (a plain ``>`` with NULL would load nothing, ever).
    """
    mark = target.agg(F.date_sub(F.max(date_col), lookback_days).alias("mark")).scalar()
    return df.where(F.coalesce(F.col(date_col) > mark, mark.isNull()))


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    by = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order_cols)])
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), by).alias("chosen"))
    return chosen.select(*[F.col(k) if k in keys else F.col(f"chosen.{k}").alias(k) for k in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first by ``order``, which has to be total within a key.

    This is an aggregate, not a window: each task keeps one row per key before the shuffle, so a
    key that holds a third of all rows sends one row per task.
    """
    return _pick(df, keys, order, F.min_by)


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the last by ``order``; combines before the shuffle as ``keep_first`` does."""
    return _pick(df, keys, order, F.max_by)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct values of ``key`` that are neither NULL nor empty."""
    return df.select(key).where(F.col(key) != "").distinct()
