"""Row helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with ``columns`` worked out once per row.

    Columns of an inlined array are values, not expressions: filters and selections above use
    them as they are. A plain projection may be copied into every use, so that costly text
    parsing would run again for each of them.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
