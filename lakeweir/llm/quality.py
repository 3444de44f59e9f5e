"""Quality: a byte-level convolutional network over overlapping chunks of the whole text, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.common import fold, fold_of, map_frames, pieces
from lakeweir.llm.labelled import balanced, one_per_id, sample_labels

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
PER_CLASS = 1500  # bound of the training sample: rows of each class
LONGEST = 100_000  # octets; longer labelled texts are scored like any other but not learned from
STEP = 4  # octets between positions of a filter, which sees 2 * STEP octets
UNIT = 32  # positions whose largest value is kept; a chunk is two neighbouring units
FILTERS = 24
ROWS = 1 << 20  # octets worked on at once


def _octet_features() -> np.ndarray:
    """Fixed description of an octet: its class, and a random sign code that tells octets apart."""
    chars = [chr(b) for b in range(256)]
    kinds = [
        [b < 128 and c.islower() for b, c in enumerate(chars)],
        [b < 128 and c.isupper() for b, c in enumerate(chars)],
        [b < 128 and c.isdigit() for b, c in enumerate(chars)],
        [c in " \t\n\r" for c in chars],
        [32 < b < 127 and not c.isalnum() for b, c in enumerate(chars)],
        [b >= 128 for b in range(256)],
    ]
    codes = np.random.default_rng(11).choice([-0.5, 0.5], (256, 6))
    codes[0] = 0  # the padding
    return np.concatenate([np.array(kinds, dtype=float).T, codes], axis=1).astype(np.float32)


OCTETS = _octet_features()
WIDTH = OCTETS.shape[1] * STEP


class Network(NamedTuple):
    """filters: [2 * WIDTH, FILTERS] with their offsets; weights of the pooled values and their offset."""

    filters: np.ndarray
    offsets: np.ndarray
    weights: np.ndarray
    offset: np.ndarray


class Pass(NamedTuple):
    """What the gradient needs from one run over some texts."""

    inputs: np.ndarray
    units: np.ndarray
    first: np.ndarray
    counts: np.ndarray
    chunks: np.ndarray
    pooled: np.ndarray
    margin: np.ndarray


def run(net: Network, texts: list[bytes]) -> Pass:
    """Filters at every position, the largest per unit and per chunk, then largest, mean and
    smallest over a text's chunks. Each text is padded to whole units; every octet is covered."""
    span = STEP * UNIT
    counts = np.array([max(1, -(-len(t) // span)) for t in texts])
    data = np.frombuffer(b"".join(t.ljust(n * span, b"\0") for t, n in zip(texts, counts)), dtype=np.uint8)
    cells = OCTETS[data].reshape(-1, WIDTH)
    inputs = np.empty((len(cells), 2 * WIDTH), dtype=np.float32)
    inputs[:, :WIDTH] = cells
    inputs[:-1, WIDTH:] = cells[1:]
    inputs[np.cumsum(counts) * UNIT - 1, WIDTH:] = 0  # nothing of the next text
    values = np.maximum(inputs @ net.filters + net.offsets, 0)
    units = values.reshape(-1, UNIT, values.shape[1]).max(axis=1)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    chunks = units.copy()
    paired = np.ones(len(units), dtype=bool)
    paired[np.cumsum(counts) - 1] = False  # a text's last unit has no neighbour
    inner = np.flatnonzero(paired)
    chunks[inner] = np.maximum(units[inner], units[inner + 1])
    pooled = np.concatenate([
        np.maximum.reduceat(chunks, first),
        np.add.reduceat(chunks, first) / counts[:, None],
        np.minimum.reduceat(chunks, first),
    ], axis=1)
    return Pass(inputs, units, first, counts, chunks, pooled, pooled @ net.weights + net.offset[0])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def gradient(net: Network, out: Pass, gap: np.ndarray) -> Network:
    """Of the loss whose derivative by the margins is ``gap``; ties share it."""
    n = net.filters.shape[1]
    row = np.repeat(np.arange(len(gap)), out.counts)
    by_pool = gap[:, None] * net.weights[None, :]
    back = by_pool[:, n : 2 * n][row] / out.counts[row][:, None]
    for part, k in ((out.pooled[:, :n], 0), (out.pooled[:, 2 * n :], 2)):
        same = out.chunks == part[row]
        ties = np.add.reduceat(same.astype(np.float32), out.first)
        back += same * (by_pool[:, k * n : (k + 1) * n] / ties)[row]
    to_units = np.where(out.chunks == out.units, back, 0)
    right = back - to_units
    to_units[1:] += right[:-1]
    to_units = np.where(out.units > 0, to_units, 0)
    values = np.maximum(out.inputs @ net.filters + net.offsets, 0).reshape(len(out.units), UNIT, n)
    place = values.argmax(axis=1) + (np.arange(len(out.units)) * UNIT)[:, None]
    filters = np.stack([to_units[:, f] @ out.inputs[place[:, f]] for f in range(n)], axis=1)
    return Network(filters, to_units.sum(axis=0), out.pooled.T @ gap, np.array([gap.sum()]))


def fit(texts: list[bytes], labels: np.ndarray, rounds: int = 14, batch: int = 64, rate: float = 0.01,
        decay: float = 1e-4) -> Network:
    """Weighted logistic loss over random batches; fixed seed. One class alone, or no rows, gives a
    constant score: the share of label 1 (a half without rows)."""
    dice = np.random.default_rng(5)
    net = Network(
        dice.normal(0, 0.25, (2 * WIDTH, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
        np.zeros(3 * FILTERS), np.zeros(1),
    )
    positive = float((labels == 1).sum())
    if positive == 0 or positive == len(labels):
        return net._replace(offset=np.array([np.log((positive + 0.5) / (len(labels) - positive + 0.5))]))
    weights = balanced(labels)
    state, step = [[np.zeros(v.shape) for v in net] for _ in range(2)], 0
    for turn in range(rounds):
        order = dice.permutation(len(texts))
        for begin in range(0, len(order), batch):
            chosen = order[begin : begin + batch]
            out = run(net, [texts[i] for i in chosen])
            gap = weights[chosen] * (sigmoid(out.margin) - labels[chosen]) / len(chosen)
            step += 1
            speed = rate * (1 - turn / rounds) + 0.0005
            values = []
            for k, (value, slope) in enumerate(zip(net, gradient(net, out, gap))):
                slope = slope + decay * value
                state[0][k] = 0.9 * state[0][k] + 0.1 * slope
                state[1][k] = 0.99 * state[1][k] + 0.01 * slope**2
                move = (state[0][k] / (1 - 0.9**step)) / (np.sqrt(state[1][k] / (1 - 0.99**step)) + 1e-8)
                values.append((value - speed * move).astype(value.dtype))
            net = Network(*values)
    return net


def octets(text) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def long_margin(net: Network, text: bytes) -> float:
    """Margin of one text too long to be worked on at once, from slices that share a unit."""
    span, n = STEP * UNIT, net.filters.shape[1]
    units = []
    for begin in range(0, len(text), ROWS):
        # One octet cell more than the slice, so that its last positions see what follows.
        part = text[begin : begin + ROWS + span]
        found = run(net, [part]).units
        units.append(found[: ROWS // span])
    units = np.concatenate(units)
    chunks = np.concatenate([np.maximum(units[:-1], units[1:]), units[-1:]])
    pooled = np.concatenate([chunks.max(axis=0), chunks.sum(axis=0) / len(chunks), chunks.min(axis=0)])
    return float(pooled[: 3 * n] @ net.weights + net.offset[0])


def score_texts(net: Network, texts) -> np.ndarray:
    """Scores of whole texts between 0 and 1; null and empty texts are one unit of padding."""
    raw = [octets(t) for t in texts]
    out = [np.zeros(0)]
    for begin, end in pieces([len(r) for r in raw], ROWS):
        if end - begin == 1 and len(raw[begin]) > ROWS:
            out.append(np.array([long_margin(net, raw[begin])]))
        else:
            out.append(run(net, raw[begin:end]).margin)
    return sigmoid(np.concatenate(out))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Network:
    """Fit on at most ``per_class`` rows of each class outside the held-out fold, none over LONGEST octets.

    The sampled ids (bounded, so broadcast) select the texts in one scan, one per id. Equal texts
    count once.
    """
    sample = sample_labels(labels, "quality", fold(F.col("doc_id"), FOLDS), HELD_OUT, per_class)
    picked = docs.select("doc_id", "text").where(F.octet_length("text") <= LONGEST)
    got = one_per_id(picked.join(F.broadcast(sample), "doc_id")).collect()
    unique = {(r["text"], r["label"]): r for r in sorted(got, key=lambda r: r["doc_id"])}
    rows = sorted(unique.values(), key=lambda r: r["doc_id"])
    return fit([octets(r["text"]) for r in rows], np.array([r["label"] for r in rows], dtype=float))


def score_quality(docs: DataFrame, net: Network) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (higher: better), predicted.

    A scan without any shuffle; the network has a fixed size. Only the text enters the score.
    Null and empty texts score like padding; a null doc_id stays null and counts as fold 0; repeated
    rows give repeated results; an empty table gives an empty one.
    """

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            score = score_texts(net, batch["text"])
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
