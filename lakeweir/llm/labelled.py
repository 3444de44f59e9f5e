"""A bounded sample of labelled documents, shared by the two classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_labels(labels: DataFrame, label: str, fold: Column, held_out: int, per_class: int) -> DataFrame:
    """At most ``per_class`` training ids of each class, in hash order: doc_id, label.

    One label per id (the larger one where rows disagree); rows without id or label and rows of the
    held-out fold are left out. The bound makes the sample safe to broadcast whatever the
    size of ``labels``.
    """
    clean = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold != held_out))
        .groupBy("doc_id")
        .agg(F.max(F.col(label)).cast("int").alias("label"))
    )
    parts = [
        clean.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


def one_per_id(picked: DataFrame) -> DataFrame:
    """One row per doc_id of (doc_id, text, label), that with the smallest hash of the text, so that rows
    that repeat an id do not exceed the sample's bound."""
    first = F.min(F.struct(F.xxhash64("text"), "text")).alias("first")
    return picked.groupBy("doc_id").agg(first, F.max("label").alias("label")).select("doc_id", "first.text", "label")


def balanced(labels: np.ndarray) -> np.ndarray:
    """Weights of rows by which both classes count alike."""
    counts = {c: max(1, int((labels == c).sum())) for c in (0, 1)}
    return np.array([len(labels) / 2 / counts[int(c)] for c in labels])
