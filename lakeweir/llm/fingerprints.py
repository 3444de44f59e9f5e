"""Fingerprints of documents: all shingle hashes below a fixed fraction of the hash range."""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.common import U, mix, powers

SHINGLE = 16
FRACTION = 32
BELOW = U((1 << 64) // FRACTION)
# Octets hashed at once; longer texts are hashed in blocks that overlap by a shingle less one octet.
BLOCK = 1 << 19
# Sampled keys of a range; the driver gets them for all ranges, of which there are as many as shuffle partitions.
SAMPLES = 8
_BASE = 0xD1B54A32D192ED03
_INVERSE = pow(_BASE, -1, 1 << 64)
COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, jaccard_edited double, jaccard_next double"
)


def _blocks(raw: Sequence[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """(text, octets) in lists of about BLOCK octets, each shingle whole in one of them."""
    out: list[tuple[int, bytes]] = []
    size = 0
    for k, octets in enumerate(raw):
        for begin in range(0, max(1, len(octets) - SHINGLE + 1), BLOCK):
            piece = octets[begin : begin + BLOCK + SHINGLE - 1]
            if size and size + len(piece) > BLOCK:
                yield out
                out, size = [], 0
            out.append((k, piece))
            size += len(piece)
    if out:
        yield out


def _shingle_hashes(pieces: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle, and the text it is of."""
    lengths = np.array([len(p) for _, p in pieces], np.int64)
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(p for _, p in pieces), np.uint8).astype(U) + U(1)
    total = np.concatenate([np.zeros(1, U), np.cumsum(data * powers(_BASE, len(data)), dtype=U)])
    # A text shorter than a shingle is one shingle of its own.
    counts = np.where(lengths >= SHINGLE, lengths - SHINGLE + 1, np.minimum(lengths, 1))
    before = np.cumsum(counts) - counts
    first = np.arange(int(counts.sum())) - np.repeat(before - (ends - lengths), counts)
    size = np.repeat(np.minimum(lengths, SHINGLE), counts)
    value = (total[first + size] - total[first]) * powers(_INVERSE, max(1, len(data)))[first]
    return mix(value + size.astype(U) * U(0x9E3779B97F4A7C15)), np.repeat(np.array([k for k, _ in pieces]), counts)


def merge(sketches: Sequence[np.ndarray]) -> np.ndarray:
    """The sketch of all texts together: hashes below the fraction, or else the smallest one."""
    together = np.unique(np.concatenate([*sketches, np.zeros(0, U)]))
    below = together[together < BELOW]
    return below if len(below) else together[:1]


def sketches(texts: Sequence[str]) -> list[np.ndarray]:
    """Per text its sorted distinct shingle hashes below the fraction; if none is, the smallest. Empty texts have none."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    kept: list[list[np.ndarray]] = [[] for _ in raw]
    for pieces in _blocks(raw):
        hashes, owner = _shingle_hashes(pieces)
        below = np.flatnonzero(hashes < BELOW)
        bounds = np.searchsorted(owner[below], np.arange(pieces[0][0], pieces[-1][0] + 2))
        begins = np.searchsorted(owner, np.arange(pieces[0][0], pieces[-1][0] + 2))
        for k, (a, b, c, d) in enumerate(zip(bounds, bounds[1:], begins, begins[1:]), pieces[0][0]):
            if b > a:
                kept[k].append(hashes[below[a:b]])
            elif d > c:
                kept[k].append(hashes[c:d].min(keepdims=True))
    return [merge(k) for k in kept]


def to_text(sketch: np.ndarray) -> str:
    """Base64 of the hashes in ascending order, eight octets each, big-endian."""
    return base64.b64encode(sketch.astype(">u8").tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), ">u8").astype(U)


def containment(one: np.ndarray, other: np.ndarray) -> float:
    """Estimated share of the shingles of the text with fewer that the other has too; 1 for two empty texts."""
    smaller = min(len(one), len(other))
    if not smaller:
        return float(len(one) == len(other))
    return len(np.intersect1d(one, other, assume_unique=True)) / smaller


def jaccard(one: np.ndarray, other: np.ndarray) -> float:
    """Estimated share of the shingles of both that are in each; 1 for two empty texts."""
    union = merge([one, other])
    if not len(union):
        return 1.0
    return len(np.intersect1d(np.intersect1d(one, other, assume_unique=True), union, assume_unique=True)) / len(union)


def order_key() -> Column:
    """Text that orders rows by doc_id, null first, then by a hash of the whole text."""
    flip = F.lit(-(1 << 63)).cast("long")
    number = F.lpad(F.hex(F.col("doc_id").cast("long").bitwiseXOR(flip)), 16, "0")
    tie = F.lpad(F.hex(F.xxhash64(F.coalesce("text", F.lit("")))), 16, "0")
    return F.concat(F.when(F.col("doc_id").isNull(), "0").otherwise(F.concat(F.lit("1"), number)), tie)


def in_ranges(docs: DataFrame, ranges: int) -> DataFrame:
    """Rows dealt to ``ranges`` ranges of their order, and to each range also the row that follows it.

    Adds part, follows and key. Bounds are keys of rows, from a sample of SAMPLES keys a range that
    a hash of the key draws. The row at a bound begins its range and follows the one before; the
    smallest follows the last.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", order_key())
    rows, least = keyed.agg(F.count("*"), F.min("key")).first()
    step = max(1, rows // (ranges * SAMPLES))
    drawn = keyed.where(F.pmod(F.xxhash64("key"), F.lit(step)) == 0).select("key").distinct()
    sample = sorted(r[0] for r in drawn.where(F.col("key") != least).collect()) if rows else []
    count = min(ranges - 1, len(sample))
    bounds = sorted({sample[(k + 1) * len(sample) // (count + 1)] for k in range(count)})
    last = len(bounds)

    def parts(keys: pd.Series) -> pd.Series:
        return pd.Series([
            [bisect_right(bounds, k)]
            + [at for at in [bisect_left(bounds, k)] if at < last and bounds[at] == k]
            + [last] * (k == least)
            for k in keys
        ])

    # The first part is the row's own, the others it follows.
    places = F.pandas_udf(parts, "array<int>")(F.col("key"))
    dealt = keyed.select("doc_id", "text", "key", F.posexplode(places).alias("follows", "part"))
    return dealt.withColumn("follows", F.col("follows") > 0)


def _rows_of(texts: list[str], following: str, ids: list, known: list[np.ndarray]) -> tuple[dict, np.ndarray]:
    """Result columns of consecutive documents, and the sketch of the one after them; ``known``: the first sketch, if any."""
    nexts = [*texts[1:], following]
    edited = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for t, n in zip(texts, nexts)]
    all_sketches = sketches([*[*texts, following][len(known) :], *edited])
    mine = [*known, *all_sketches][: len(texts) + 1]
    theirs = all_sketches[len(texts) + 1 - len(known) :]
    return {
        "doc_id": pa.array(ids, pa.int64()),
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(e.encode()).hexdigest() for e in edited],
        "fingerprint": [to_text(s) for s in mine[:-1]],
        "edited_fingerprint": [to_text(s) for s in theirs],
        "near_edited": [containment(a, b) for a, b in zip(mine, theirs)],
        "near_next": [containment(a, b) for a, b in zip(mine, mine[1:])],
        "jaccard_edited": [jaccard(a, b) for a, b in zip(mine, theirs)],
        "jaccard_next": [jaccard(a, b) for a, b in zip(mine, mine[1:])],
    }, mine[-1]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole ranges in order: fingerprints of each text, its edited text and the text after it."""
    texts: list[str] = []
    ids: list = []
    known: list[np.ndarray] = []
    size, now, closed = 0, None, False
    for batch in batches:
        for part, follows, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "follows", "doc_id", "text"))):
            if part != now:
                now, closed, known = part, False, []
            if closed:
                # Only the first of equal rows follows.
                continue
            if texts and (follows or size > BLOCK):
                columns, after = _rows_of(texts, text, ids, known)
                yield pa.RecordBatch.from_pydict(columns)
                texts, ids, size, known = [], [], 0, [after]
            closed = follows
            if not follows:
                texts.append(text)
                ids.append(doc_id)
                size += len(text)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """One row per document with its fingerprint, its edited text's, and how near they and the next document's are.

    The next document is the next by ascending doc_id, null first, equal ids by a hash of the text;
    after the last comes the first, which is its own next if alone. Null texts are empty and have an
    empty fingerprint; two empty texts are alike (1), an empty one and another are not (0). Repeated
    rows are documents of their own. Other columns are not read. An empty table gives an empty
    result. near_* is the containment of the text with fewer shingles, jaccard_* the resemblance.

    Texts are shuffled once, by ranges of the id, so that neighbours meet in one task; a range with
    most of the rows of one id is cut by the texts' hashes.
    """
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = in_ranges(docs, ranges)
    together = dealt.repartitionById(ranges, F.col("part")).sortWithinPartitions("part", "follows", "key")
    return together.select("part", "follows", "doc_id", "text").mapInArrow(_compare, COLUMNS)
