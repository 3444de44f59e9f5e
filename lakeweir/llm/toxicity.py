"""Toxicity: a factorization machine over hashed terms, with pairwise interactions."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.common import BY_TERM, U, by_text, fold, fold_of, map_frames, plain, text_pieces, words_of
from lakeweir.llm.labelled import balanced, one_per_id, sample_labels

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
BUCKET_BITS = 22
PART = 4  # octets of the inner runs of a word that count as terms too
RANK = 6
PER_CLASS = 3000  # bound of the training sample: rows of each class
SUPPORT = 2  # training rows that hold a bucket, at least, for it to get weights and factors
BATCH = 256  # training rows of a step
PASSES, STEPS = 20, 400  # over the sample; and steps at least, where the sample is small


class Model(NamedTuple):
    """buckets: those that have weights; score = bias + sum(linear) + sum over pairs of (factor . factor)."""

    buckets: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def place(self) -> np.ndarray:
        """Bucket to feature, or -1."""
        out = np.full(1 << BUCKET_BITS, -1, dtype=np.int32)
        out[self.buckets] = np.arange(len(self.buckets))
        return out


def terms_of(texts) -> list[np.ndarray]:
    """The distinct hashed terms of each whole text: words of letters and digits, and every run of
    ``PART`` octets inside a word, A-Z lower-cased. The runs catch inflected and joined words."""
    out: list[np.ndarray] = []
    for begin, end in text_pieces(texts, 1 << 18):
        part = texts[begin:end]
        words = words_of(part, BY_TERM)
        buckets = (words.hashes >> U(64 - BUCKET_BITS)).astype(np.int32)
        raw = [b"" if t is None else t.encode("utf-8", "surrogatepass").lower() for t in part]
        data = np.frombuffer(b"\n".join(raw) + b"\n" * PART, dtype=np.uint8)
        inside = BY_TERM[data] > 0
        n = len(data) - PART + 1
        key, whole = np.zeros(n, U), np.ones(n, dtype=bool)
        for k in range(PART):
            key = (key << U(8)) | data[k : n + k]
            whole &= inside[k : n + k]
        runs = ((key * U(0xD6E8FEB86659FD93)) >> U(64 - BUCKET_BITS)).astype(np.int32)
        at = np.cumsum([0, *(len(r) + 1 for r in raw)])
        for i, (a, b) in enumerate(zip(words.starts[:-1], words.starts[1:])):
            own = slice(at[i], min(at[i + 1], n))
            out.append(np.unique(np.concatenate([buckets[a:b], runs[own][whole[own]]])))
    return out


def known(place: np.ndarray, terms: list[np.ndarray]) -> list[np.ndarray]:
    """The features among the terms of each text."""
    return [(p := place[t])[p >= 0] for t in terms]


def margins(model: Model, features: list[np.ndarray]) -> np.ndarray:
    """Of texts given as features of the model."""
    flat = np.concatenate([*features, np.zeros(0, np.int32)]).astype(np.int64)
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    n, rank = len(features), model.factors.shape[1]
    out = model.bias + np.bincount(row, model.linear[flat], n)
    for k in range(rank):
        v = model.factors[flat, k]
        out += 0.5 * (np.bincount(row, v, n) ** 2 - np.bincount(row, v * v, n))
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def evidence(found: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Likelihood-ratio statistic of each bucket's presence against the class, from its rows per class."""
    pooled = found.sum(axis=0) / rows.sum()
    out = np.zeros(found.shape[1])
    for seen, n in zip(found, rows):
        for part, expected in ((seen, pooled * n), (n - seen, (1 - pooled) * n)):
            out += 2 * np.where(part > 0, part * np.log(np.maximum(part, 1e-9) / np.maximum(expected, 1e-9)), 0)
    return np.maximum(out, 0)


def fit(terms: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, rate: float = 0.02, decay: float = 1e-5,
        doubt: float = 0.3, factor_decay: float = 3e-3) -> Model:
    """Weighted logistic loss, BATCH rows per step, moments of the gradient per weight; fixed seed.

    Every bucket that SUPPORT rows hold has a linear weight and factors, so that terms which tell
    nothing apart can tell the classes apart together. Linear weights decay by up to ``doubt``
    where presence alone says little; factors all decay alike. One class alone, or no rows, leaves
    the share of that class (a half without rows) as the score.
    """
    chosen = np.zeros(0, dtype=np.int64)
    positive = float(weights[labels == 1].sum())
    negative = float(weights[labels == 0].sum())
    bias = float(np.log((positive + 0.5) / (negative + 0.5)))
    rows = np.array([float((labels == c).sum()) for c in (0, 1)])
    if rows.min() > 0:
        # Rows of each class per bucket, added up row by row: a row holds a bucket once.
        found = np.zeros((2, 1 << BUCKET_BITS), np.uint16)
        for row, label in zip(terms, labels):
            found[int(label), row] += np.uint16(1)
        chosen = np.flatnonzero(found[0] + found[1] >= SUPPORT)
        found = found[:, chosen].astype(np.float32)
    size = len(chosen)
    dice = np.random.default_rng(7)
    model = Model(chosen, bias, np.zeros(size, np.float32), np.zeros((size, RANK), np.float32))
    if size == 0:
        return model
    features = known(model.place(), terms)
    linear_decay = decay + doubt / (1 + evidence(found, rows) ** 4 / 100)
    linear_decay = linear_decay.astype(np.float32)
    # The bias, linear weights, factors. All state is single precision and changed in place, as the
    # driver holds it: a weight takes 20 octets with its gradient and moments.
    value = np.zeros(1 + size * (1 + RANK), np.float32)
    value[0] = bias
    value[1 + size :] = dice.normal(0, 0.02, size * RANK)
    first, second, gradient, spare = (np.zeros_like(value) for _ in range(4))
    del found
    batches = -(-len(features) // BATCH)
    last = max(STEPS, PASSES * batches)
    for step in range(last):
        if step % batches == 0:
            order = dice.permutation(len(features))
        own = order[step % batches * BATCH :][:BATCH]
        flat = np.concatenate([features[i] for i in own]).astype(np.int64)
        row = np.repeat(np.arange(len(own)), [len(features[i]) for i in own])
        margin = value[0] + np.bincount(row, value[1 : 1 + size][flat], len(own))
        held, sums = [], []
        for factor in value[1 + size :].reshape(RANK, size):
            held.append(factor[flat])
            sums.append(np.bincount(row, held[-1], len(own)).astype(np.float32))
            margin += 0.5 * (sums[-1] ** 2 - np.bincount(row, held[-1] ** 2, len(own)))
        gap = weights[own] * (sigmoid(margin) - labels[own]) / len(own)
        gradient[0] = gap.sum()
        gradient[1 : 1 + size] = np.bincount(flat, gap[row], size)
        for k, (v, total) in enumerate(zip(held, sums)):
            gradient[1 + size * (1 + k) :][:size] = np.bincount(flat, gap[row] * (total[row] - v), size)
        np.multiply(value, factor_decay, out=spare)
        spare[0] = 0
        np.multiply(value[1 : 1 + size], linear_decay, out=spare[1 : 1 + size])
        gradient += spare
        first += np.float32(0.1) * (np.subtract(gradient, first, out=spare))
        np.square(gradient, out=gradient)
        second += np.float32(0.01) * (np.subtract(gradient, second, out=spare))
        np.sqrt(np.divide(second, 1 - 0.99 ** (step + 1), out=spare), out=spare)
        spare += np.float32(1e-4)
        np.divide(first, spare, out=spare)
        spare *= np.float32(rate * (1 - step / last) / (1 - 0.9 ** (step + 1)))
        value -= spare
    factors = value[1 + size :].reshape(RANK, size).T
    return Model(chosen, float(value[0]), value[1 : 1 + size].copy(), np.ascontiguousarray(factors))


def score_texts(model: Model, texts, place: np.ndarray | None = None) -> np.ndarray:
    """Scores between 0 and 1; texts without known terms get the score of the bias alone."""
    return sigmoid(margins(model, known(model.place() if place is None else place, terms_of(texts))))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Fit on at most ``per_class`` rows of each class outside the held-out fold.

    The sampled ids (bounded, so broadcast) select the texts in one scan, one per id; hashed terms
    of the sample reach the driver. Equal texts count once, so a group of copies weighs as one. Terms
    of one sampled row alone (SUPPORT) have no weight.
    """
    sample = sample_labels(labels, "toxic", fold(F.col("doc_id"), FOLDS), HELD_OUT, per_class)
    picked = one_per_id(docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(sample), "doc_id"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                terms = [t.tobytes() for t in terms_of(batch["text"].tolist())]
                yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "terms": terms})

    got = map_frames(picked, hashed, "doc_id long, label int, terms binary").collect()
    unique = {(hashlib.sha256(r["terms"]).digest(), r["label"]): r for r in sorted(got, key=lambda r: r["doc_id"])}
    rows = sorted(unique.values(), key=lambda r: r["doc_id"])
    y = np.array([r["label"] for r in rows], dtype=float)
    return fit([np.frombuffer(r["terms"], np.int32) for r in rows], y, balanced(y))


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    A scan without any shuffle; the model has a fixed size. Only the text enters the score.
    Null and empty texts get the bias's score; a null doc_id stays null and counts as fold 0;
    repeated rows give repeated results; an empty table gives an empty one.
    """

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = model.place()
        for batch in batches:
            score = score_texts(model, plain(batch["text"]), place)
            ids = batch["doc_id"]
            yield pd.DataFrame({
                "doc_id": ids,
                "held_out": [fold_of(None if pd.isna(i) else i, FOLDS) == HELD_OUT for i in ids],
                "score": score,
                "predicted": (score >= THRESHOLD).astype(np.int32),
            })

    return map_frames(
        docs.select("doc_id", "text"), scored, "doc_id long, held_out boolean, score double, predicted int"
    )


def keep_harmless(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose whole text scores below the threshold."""

    def scorer():
        place = model.place()
        return lambda texts: score_texts(model, texts, place)

    return docs.where(by_text(F.col("text"), scorer, "double") < THRESHOLD)
