"""Token files: ids in patched frame-of-reference blocks, written in document order and read back."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeweir.llm.common import BY_CLASS, U, WORD, hashed_runs, map_frames, pieces, plain
from lakeweir.session import working_path

BLOCK = 256  # ids of a block
SHARE = 0.95  # of a block's ids fit its width; the others are exceptions
END = 2  # id appended to every document
SEGMENT = 1 << 19  # characters of the documents that go into one segment; a longer one has its own
MOST_WORDS = 1_000_000  # pieces whose ids a worker remembers

MAGIC = b"PFB1"
# Octets of a segment: magic; numbers of documents, ids, blocks and exceptions; then, one after the
# other, doc ids, which of them are null, tokens per document, starts of the packed blocks, their least
# ids and widths, first exceptions of the blocks, places and high parts of exceptions, packed blocks.
HEADER = struct.Struct("<4sIIII")


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of rows of BLOCK values, first bit first."""
    room = 16 if width <= 16 else 32
    octets = values.astype(f">u{room // 8}").view(np.uint8).reshape(len(values), BLOCK, room // 8)
    return np.packbits(np.unpackbits(octets, axis=2)[:, :, room - width :].reshape(len(values), -1), axis=1)


def unpack(packed: np.ndarray, width: int) -> np.ndarray:
    room = 16 if width <= 16 else 32
    full = np.zeros((len(packed), BLOCK, room), dtype=np.uint8)
    full[:, :, room - width :] = np.unpackbits(packed, axis=1, count=BLOCK * width).reshape(-1, BLOCK, width)
    return np.packbits(full, axis=2).view(f">u{room // 8}").reshape(len(packed), BLOCK).astype(np.uint32)


def encode_ids(ids: np.ndarray) -> tuple[bytes, int, int]:
    """Blocks of ids as octets, with the numbers of blocks and exceptions.

    From each block its least id is taken off. The width is that of the value at the SHARE-th place
    of the sorted rest. What exceeds it goes to the exceptions with its place; the low bits stay.
    """
    blocks = -(-len(ids) // BLOCK)
    table = np.zeros((blocks, BLOCK), dtype=np.uint32)
    if blocks:
        table.ravel()[: len(ids)] = ids
        table.ravel()[len(ids) :] = ids[-1]
    least = table.min(axis=1) if blocks else np.zeros(0, np.uint32)
    rest = table - least[:, None]
    at = min(BLOCK - 1, int(np.ceil(SHARE * BLOCK)) - 1)
    limit = np.partition(rest, at, axis=1)[:, at] if blocks else least
    width = np.ceil(np.log2(limit.astype(np.float64) + 1)).astype(np.uint8)
    high = (rest.astype(np.uint64) >> width.astype(np.uint64)[:, None]).astype(np.uint32)
    row, place = np.nonzero(high)
    first = np.searchsorted(row, np.arange(blocks + 1)).astype("<u4")
    size = BLOCK // 8 * width.astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(size)])
    body = np.zeros(int(starts[-1]), dtype=np.uint8)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            body[starts[own][:, None] + np.arange(BLOCK // 8 * int(w))] = pack(rest[own], int(w))
    parts = [starts[:-1].astype("<u4"), least.astype("<u4"), width, first, place.astype(np.uint8),
             high[row, place].astype("<u4"), body]
    return b"".join(p.tobytes() for p in parts), blocks, len(row)


def write_segment(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment: documents in order and all their ids."""
    body, blocks, exceptions = encode_ids(ids)
    head = HEADER.pack(MAGIC, len(doc_ids), len(ids), blocks, exceptions)
    named = np.array([0 if i is None else i for i in doc_ids], dtype="<i8")
    missing = np.array([i is None for i in doc_ids], dtype=np.uint8)
    return b"".join([head, named.tobytes(), missing.tobytes(), np.asarray(lengths, "<u4").tobytes(), body])


def read_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Documents, their numbers of ids, and the ids of a segment."""
    magic, docs, n, blocks, exceptions = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("no token segment")
    at = HEADER.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, dtype=kind, count=count, offset=at)
        at += out.nbytes
        return out

    named, missing, lengths = take("<i8", docs), take("u1", docs), take("<u4", docs)
    starts, least, width, first = take("<u4", blocks), take("<u4", blocks), take("u1", blocks), take("<u4", blocks + 1)
    place, high = take("u1", exceptions), take("<u4", exceptions)
    body = np.frombuffer(data, dtype=np.uint8, offset=at)
    rest = np.zeros((blocks, BLOCK), dtype=np.uint32)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            packed = body[starts[own].astype(np.int64)[:, None] + np.arange(BLOCK // 8 * int(w))]
            rest[own] = unpack(packed, int(w))
    row = np.repeat(np.arange(blocks), np.diff(first.astype(np.int64)))
    rest[row, place] |= (high.astype(np.uint64) << width[row].astype(np.uint64)).astype(np.uint32)
    ids = (rest + least[:, None]).ravel()[:n]
    return [None if m else int(i) for i, m in zip(named, missing)], lengths, ids


# How the vocabulary cuts lower-cased text, for texts whose characters all lie below U+0250; there its
# letters, numbers and spaces are these. Such texts are composed already.
CUT = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+"
    "|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]"
    "|[^a-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
    "\x09-\x0d\x20\x85\xa0]+"
)
BEYOND = re.compile("[^\x00-\u024f]")
# Beyond ASCII only letters that one lower-case letter of the same range stands for.
UNPLAIN = re.compile("[^\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]")


class Tokenizer:
    """Ids of whole texts for vocabularies that lower-case, cut as CUT does and then join within a cut.

    Each piece is encoded by the library once and remembered. Plain texts (letters below U+0250,
    ASCII, no apostrophe) are cut and looked up as arrays by the pieces' 64-bit hashes. Other texts
    whose characters lie below U+0250 are cut by the pattern. The rest, and texts with
    the opening of a special token, are cut at ASCII white space only, which nothing is joined
    across, and the library does what remains.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Vocabulary

        self.vocabulary = Vocabulary.from_file(path)
        self.words = re.compile(WORD)
        self.forget()

    def forget(self) -> None:
        self.flat = np.zeros(0, np.uint32)
        self.known, self.place = np.zeros(0, U), np.zeros(0, np.int64)
        self.firsts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def places(self, hashes: np.ndarray, spell) -> np.ndarray:
        """Where the pieces stand in ``firsts`` and ``sizes``; new ones are learned.

        ``spell`` gives the text of the pieces at some indexes of ``hashes``.
        """
        unique, index, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(unique) > MOST_WORDS:
            self.forget()
        at = np.minimum(np.searchsorted(self.known, unique), max(0, len(self.known) - 1))
        new = np.flatnonzero(self.known[at] != unique) if len(self.known) else np.arange(len(unique))
        if len(new):
            found = [e.ids for e in self.vocabulary.encode_batch_fast(spell(index[new]), add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
            self.firsts = np.concatenate([self.firsts, len(self.flat) + np.cumsum(sizes) - sizes])
            self.place = np.concatenate([self.place, len(self.sizes) + np.arange(len(new))])
            self.sizes, self.flat = np.concatenate([self.sizes, sizes]), np.concatenate([self.flat, ids])
            self.known = np.concatenate([self.known, unique[new]])
            order = np.argsort(self.known, kind="stable")
            self.known, self.place = self.known[order], self.place[order]
        return self.place[np.searchsorted(self.known, unique)][back]

    def cut_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of all pieces of plain lower-case texts, and how many each text has."""
        words, data, first, last = hashed_runs([t.encode() for t in texts], BY_CLASS)
        octets = data.tobytes()
        spell = lambda at: [octets[a:b].decode() for a, b in zip(first[at].tolist(), last[at].tolist())]
        return self.places(words.hashes, spell), np.diff(words.starts)

    def cut_other(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts that are not plain."""
        cut = []
        for text in texts:
            low = text.lower()
            whole = "<|" in text or BEYOND.search(text) or BEYOND.search(low)
            cut.append(self.words.findall(text) if whole else CUT.findall(low))
        flat = list(chain.from_iterable(cut))
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in flat), U, len(flat))
        return self.places(hashes, lambda at: [flat[i] for i in at]), np.array([len(c) for c in cut], dtype=np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, END after each, and the number of ids of each."""
        texts = [t or "" for t in texts]
        plain_ones = [k for k, t in enumerate(texts) if is_plain(t)]
        others = sorted({*range(len(texts))} - {*plain_ones})
        counts, parts = np.zeros(len(texts), dtype=np.int64), {}
        for chosen, cut in ((plain_ones, self.cut_plain), (others, self.cut_other)):
            if not chosen:
                continue
            place, counts[chosen] = cut([texts[k].lower() if cut == self.cut_plain else texts[k] for k in chosen])
            # What is remembered may be forgotten by the next cut, so ids are taken now.
            sizes = self.sizes[place]
            before = np.concatenate([[0], np.cumsum(sizes)])
            source = np.repeat(self.firsts[place] - before[:-1], sizes) + np.arange(int(before[-1]))
            ends = before[np.cumsum(counts[chosen])]
            lengths = np.diff(ends, prepend=0) + 1
            ids = np.insert(self.flat[source], ends, END).astype(np.uint32)
            if len(chosen) == len(texts):
                return ids, lengths
            stops = np.cumsum(lengths)
            parts |= {k: ids[e - n : e] for k, e, n in zip(chosen, stops.tolist(), lengths.tolist())}
        if not texts:
            return np.zeros(0, np.uint32), counts
        ordered = [parts[k] for k in range(len(texts))]
        return np.concatenate(ordered), np.array([len(p) for p in ordered], dtype=np.int64)


def is_plain(text: str) -> bool:
    return "'" not in text and "<|" not in text and (text.isascii() or not UNPLAIN.search(text))


_tokenizers: dict[str, Tokenizer] = {}


def tokenizer_of(path: str) -> Tokenizer:
    """One per worker process, so that the tasks it runs share what it remembers."""
    if path not in _tokenizers:
        _tokenizers[path] = Tokenizer(path)
    return _tokenizers[path]


def write_token_files(docs: DataFrame, vocabulary: str, path: str) -> None:
    """Write the ids of all documents to ``path``, in ascending order of doc_id, null ids first.

    Documents are sorted by ranges of the id; each task encodes its range and writes segments of
    about SEGMENT characters. Parquet holds the segments, one per row with its part, the number of
    ids before it in the part and its own, so that any store and the usual commit of task output serve.
    """

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer, part, before = tokenizer_of(vocabulary), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
            texts = plain(batch["text"])
            for begin, end in pieces([len(t or "") for t in texts], SEGMENT):
                tokens, lengths = tokenizer.encode(texts[begin:end])
                row = (part, before, len(tokens), write_segment(ids[begin:end], lengths, tokens))
                yield pd.DataFrame([row], columns=["part", "before", "n_ids", "content"])
                before += len(tokens)

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    segments = map_frames(ordered, encode, "part int, before long, n_ids long, content binary")
    segments.write.mode("overwrite").parquet(path)


def read_token_files(spark, path: str) -> DataFrame:
    """One row per document of the files at ``path``: doc_id, start, n_tokens, ids_crc32.

    Segments know how many ids come before them in their part; the ids of earlier parts are added
    from a row per part, of which there are as many as the sort had partitions, so it is broadcast.
    """
    segments = spark.read.parquet(path)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("of"), F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("offset"))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start, content in zip(batch["start"], batch["content"]):
                doc_ids, lengths, ids = read_segment(content)
                ends = np.cumsum(lengths.astype(np.int64))
                octets = memoryview(ids.astype("<u4").tobytes())
                yield pd.DataFrame({
                    "doc_id": pd.array(doc_ids, dtype="Int64"),
                    "start": start + ends - lengths,
                    "n_tokens": lengths.astype(np.int64),
                    "ids_crc32": [zlib.crc32(octets[4 * (e - n) : 4 * e]) for e, n in zip(ends, lengths.astype(np.int64))],
                })

    placed = segments.join(F.broadcast(parts), F.col("part") == F.col("of"))
    return map_frames(
        placed.select((F.col("before") + F.col("offset")).alias("start"), "content"), decode,
        "doc_id long, start long, n_tokens long, ids_crc32 long", 16,
    )


def tokenize(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder and return what they hold per document.

    Null and empty texts hold the end id alone; null ids come first; repeated rows are documents of
    their own; an empty table gives an empty result. ``vocabulary`` is a path that all executors have.
    """
    path = working_path(docs.sparkSession, "token-files")
    write_token_files(docs, vocabulary, path)
    return read_token_files(docs.sparkSession, path)
