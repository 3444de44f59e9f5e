"""Z-score anomalies over a whole batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.functions import fixed_text, to_number
from lakeweir.operators.rows import computed


def detect_anomalies(df: DataFrame, columns: Sequence[str], threshold: float = 3.0) -> DataFrame:
    """Add ``is_anomaly`` and ``anomaly_reasons`` for values beyond ``threshold`` standard deviations.

    Mean and sample deviation of all columns come from one aggregate, read back as one scalar
    subquery, so rows are not shuffled. Columns the frame lacks are skipped, as are values that
    are no number and columns whose deviation is 0 or undefined.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.withColumns({"is_anomaly": F.lit(False), "anomaly_reasons": F.array().cast("array<string>")})
    numbers = {c: to_number(F.col(c).cast("string")) if _is_text(df, c) else F.col(c).cast("double") for c in present}
    # pandas skips NaN; here it is kept out of the statistics the same way.
    usable = {c: F.when(~F.isnan(n), n) for c, n in numbers.items()}
    stats = df.agg(
        F.struct(
            *[F.avg(usable[c]).alias(f"mean_{i}") for i, c in enumerate(present)],
            *[F.stddev_samp(usable[c]).alias(f"std_{i}") for i, c in enumerate(present)],
        ).alias("stats")
    ).scalar()
    with_stats = computed(df, {"__stats": stats})
    reasons = []
    for i, c in enumerate(present):
        mean, std = F.col(f"__stats.mean_{i}"), F.col(f"__stats.std_{i}")
        z = F.when(std > 0, (usable[c] - mean) / std)
        text = F.concat(F.lit(f"{c} has outlier Z-score ("), fixed_text(z), F.lit(f" > {threshold})"))
        reasons.append(F.when(F.abs(z) > threshold, text))
    listed = computed(with_stats, {"anomaly_reasons": F.array_compact(F.array(*reasons))}).drop("__stats")
    return listed.withColumn("is_anomaly", F.size("anomaly_reasons") > 0)


def _is_text(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.simpleString() == "string"


def split_anomalies(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(anomalies with their reasons, clean rows without the helper columns)."""
    return flagged.where("is_anomaly"), flagged.where("not is_anomaly").drop("is_anomaly", "anomaly_reasons")
