"""What several operators share: reading documents, words as hashes, exact ranks without one large group."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

WORD = r"[^\x20\x09-\x0D]+"

SINGLE = 2
# Kinds of octets: white space or not; and white space, letters with all beyond ASCII, digits, others.
BY_SPACE = np.ones(256, dtype=np.uint8)
BY_SPACE[[0x20, *range(0x09, 0x0E)]] = 0
BY_CLASS = np.array([1 if b >= 0x80 or chr(b).isalpha() else SINGLE if chr(b).isdigit() else 3 for b in range(256)],
                    dtype=np.uint8) * BY_SPACE
# Letters and digits are words, everything else in ASCII is between them.
BY_TERM = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)], dtype=np.uint8)

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return frame.select(*columns) if columns else frame


ROWS = 1000


def map_frames(df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], ddl: str,
               rows: int = ROWS) -> DataFrame:
    """``df.mapInPandas(run, ddl)`` with whole numbers as they are, NULLs among them, and ``rows`` rows at once.

    A column of numbers with a NULL would come as floating point, which loses digits of ids beyond
    2**53. Long texts, and sets made of them, stand in a worker as often as its steps copy them, so
    few rows are turned into pandas at once, whatever the session's batches are.
    """
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = (
            batch.slice(begin, rows).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
            for batch in batches
            for begin in range(0, batch.num_rows, rows)
        )
        for frame in run(slices):
            yield pa.RecordBatch.from_pandas(frame, schema=schema, preserve_index=False)

    return df.mapInArrow(work, ddl)


def by_text(texts: Column, decide: Callable[[], Callable[[list], np.ndarray]], kind: str, rows: int = ROWS) -> Column:
    """What the function that ``decide`` makes once per task gives for each text, ``rows`` texts at once."""

    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = decide()
        for batch in batches:
            parts = [run(batch.slice(begin, rows).to_pylist()) for begin in range(0, len(batch), rows)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return F.arrow_udf(work, kind)(texts)


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; a null id falls into fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus, F.lit(0))


def fold_of(doc_id: int | None, modulus: int) -> int:
    return 0 if doc_id is None else zlib.crc32(str(int(doc_id)).encode()) % modulus


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, dtype=U)
        have[0] = 1
        _powers[base] = have = np.cumprod(have, dtype=U)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Words(NamedTuple):
    """Words of several texts in order: 64-bit hash of each, and where each text's words begin."""

    hashes: np.ndarray
    starts: np.ndarray

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.starts[i] : self.starts[i + 1]]


def words_of(texts: Sequence[str | None], kinds: np.ndarray = BY_SPACE) -> Words:
    """Whole texts, A-Z lower-cased, cut at ASCII white space. A null text has no words.

    With other ``kinds`` of octets (0: between words) words also end where the kind changes, and
    every octet of kind SINGLE is a word.
    """
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    return hashed_runs(raw, kinds)[0]


def hashed_runs(raw: list[bytes], kinds: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts, with all octets and where each word begins and ends in them."""
    ends = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, np.int64)
    data = np.frombuffer((b"\n".join(raw) + b"\n").lower(), dtype=np.uint8)
    kind = kinds[data]
    change = np.ones(len(data) + 1, dtype=bool)
    np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
    if (kinds == SINGLE).any():
        change[:-1] |= kind == SINGLE
        change[1:] |= kind == SINGLE
    edge = np.flatnonzero(change)
    real = kind[edge[:-1]] != 0
    first, last = edge[:-1][real], edge[1:][real]
    total = np.concatenate([np.zeros(1, U), np.cumsum((data.astype(U) + U(1)) * powers(_BASE, len(data)), dtype=U)])
    value = (total[last] - total[first]) * powers(_INVERSE, len(data))[first]
    hashes = mix(value + (last - first).astype(U) * U(0xD6E8FEB86659FD93))
    starts = np.concatenate([[0], np.searchsorted(first, ends, side="left")]).astype(np.int64)
    return Words(hashes, starts), data, first, last


def grams_of(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words of one text; fewer words have none."""
    if len(words) < n:
        return words[:0]
    out = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        out = mix(out + U(0x9E3779B97F4A7C15)) + words[k : len(words) - n + 1 + k]
    return mix(out)


def pieces(lengths: Sequence[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose lengths sum to about ``limit``; one longer entry is a range of its own."""
    begin = total = 0
    for i, n in enumerate(lengths):
        if i > begin and total + n > limit:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        yield begin, len(lengths)


def plain(texts: Iterable) -> list[str | None]:
    """Texts of a pandas column; what is no text is None."""
    return [t if isinstance(t, str) else None for t in texts]


def text_pieces(texts: Sequence[str | None], limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    return pieces([0 if t is None else len(t) for t in texts], limit)


def bucket_sums(df: DataFrame, group: Sequence[str], bucket: Column, amount: Column) -> DataFrame:
    """One row per (group, bucket): __bucket, __sum. Combines before its shuffle, so hot groups are cheap."""
    marked = df.withColumn("__bucket", bucket).withColumn("__amount", amount.cast("long"))
    return marked.groupBy(*group, "__bucket").agg(F.sum("__amount").alias("__sum"))


def ranked(df: DataFrame, sums: DataFrame, group: Sequence[str], order: Sequence[str], bucket: Column, amount: Column,
           into: str) -> DataFrame:
    """Add the sum of ``amount`` over the rows before each row of its group, in ``order``.

    ``bucket`` rises with ``order`` and ``sums`` holds its ``bucket_sums``. Sums are added up over
    one row per bucket, and rows meet only within a bucket, so no task holds a whole group, even
    when one group has a third of all rows. Rows that tie in ``order`` come in any order.
    """
    keys = [*group, "__bucket"]
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(k).alias(f"__o{i}") for i, k in enumerate(keys)],
        F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"),
    )
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = (
        df.withColumn("__bucket", bucket)
        .withColumn("__amount", amount.cast("long"))
        .withColumn(into, F.coalesce(F.sum("__amount").over(within), F.lit(0)))
    )
    on = [F.col(k).eqNullSafe(F.col(f"__o{i}")) for i, k in enumerate(keys)]
    return (
        inner.join(offsets, on, "left")
        .withColumn(into, F.col(into) + F.col("__offset"))
        .drop("__bucket", "__amount", "__offset", *[f"__o{i}" for i in range(len(keys))])
    )
