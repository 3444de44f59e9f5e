"""Language model scoring: n-gram counts of the whole corpus in sharded Elias-Fano tries.

P(w | v) = (c(v w) + PRIOR * P(w)) / (c(v) + PRIOR) with P(w) = (c(w) + 1) / (N + V + 1), a bigram
smoothed towards the unigram. Every token is predicted once and is once the context of the next one
(the end of a text also stands before its first word), so the logarithm of a text's probability
is a sum over its tokens w of log(c(v w) + PRIOR * P(w)) - log(c(w) + PRIOR). Both terms need only what
is known about w. So tokens are dealt to shards by word, each shard builds the trie of its
words from all the counts it receives and answers the queries that came with them, and sums per
text are added up. No task and no broadcast holds the model.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.common import U, Words, fold_of, map_frames, mix, pieces, plain, text_pieces, words_of
from lakeweir.llm.elias_fano import Codes, EliasFano, Trie

FOLDS, HELD_OUT = 7, 2
PRIOR = 2000.0
SHARD_TOKENS = 2_500_000  # tokens of a shard, about; a word with more is dealt out by its contexts
BLOCK_CHARS = 4_000_000  # characters of the texts that are sent to the shards together
BLOCK_TEXTS = 30_000
BLOCK_ROWS = 2_500
END = mix(np.array([0x656E64], dtype=U))[0]  # the end of a text as a word
TRAIN = np.uint16(1 << 15)  # mark of a training text on its number in the block

RESULT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


class Totals(NamedTuple):
    """Training tokens, distinct ones, and counts of the words with more than SHARD_TOKENS (sorted)."""

    tokens: int
    types: int
    heavy: np.ndarray
    heavy_counts: np.ndarray

    @property
    def shards(self) -> int:
        return max(1, -(-self.tokens * FOLDS // (SHARD_TOKENS * (FOLDS - 1))))


def with_ends(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of the texts, what stands before each, and the text each belongs to."""
    ends = words.starts[1:]
    tokens = np.insert(words.hashes, ends, END)
    text = np.repeat(np.arange(len(ends)), np.diff(words.starts) + 1)
    before = np.concatenate([np.array([END], U), tokens[:-1]])[: len(tokens)]
    return tokens, before, text


def learns(doc_id) -> bool:
    return fold_of(None if pd.isna(doc_id) else doc_id, FOLDS) != HELD_OUT


def count_words(docs: DataFrame, heavy_from: int = SHARD_TOKENS) -> Totals:
    """Counts of all words of all training texts. Each task sends a word once.

    The words that come back to the driver have more than ``heavy_from`` tokens, so there are no more of
    them than that many tokens go into the corpus.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, counts = [], []
        for batch in batches:
            texts = [t for t, i in zip(plain(batch["text"]), batch["doc_id"]) if learns(i)]
            for begin, end in text_pieces(texts):
                tokens = with_ends(words_of(texts[begin:end]))[0]
                found = np.unique(tokens, return_counts=True)
                words.append(found[0])
                counts.append(found[1])
                if len(words) >= 64:
                    words, counts = ([x] for x in merged(words, counts))
        if words:
            word, n = merged(words, counts)
            yield pd.DataFrame({"word": word.view(np.int64), "n": n})

    rows = map_frames(docs.select("doc_id", "text"), counted, "word long, n long")
    big = F.when(F.col("n") > heavy_from, F.struct("word", "n"))
    total = rows.groupBy("word").agg(F.sum("n").alias("n")).agg(
        F.sum("n").alias("tokens"), F.count("*").alias("types"), F.collect_list(big).alias("heavy")
    ).first()
    heavy = sorted((np.int64(r["word"]).view(U), r["n"]) for r in total["heavy"])
    return Totals(
        total["tokens"] or 0, total["types"],
        np.array([w for w, _ in heavy], dtype=U), np.array([n for _, n in heavy], dtype=np.int64),
    )


def merged(words: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    unique, back = np.unique(np.concatenate(words), return_inverse=True)
    return unique, np.bincount(back, np.concatenate(counts), len(unique)).astype(np.int64)


class Load(NamedTuple):
    """What one block sends to one shard: its words, contexts seen before each, and the texts where.

    words with ``fans`` contexts each; contexts in two parts of 32 and 8 bits; ``times`` texts for each.
    """

    words: np.ndarray
    fans: np.ndarray
    low: np.ndarray
    high: np.ndarray
    times: np.ndarray
    texts: np.ndarray

    KINDS = ("<u8", "<u4", "<u4", "u1", "<u4", "<u2")

    def pack(self) -> bytes:
        sizes = np.array([len(x) for x in self], dtype="<u4")
        return sizes.tobytes() + b"".join(x.astype(k).tobytes() for x, k in zip(self, Load.KINDS))

    @classmethod
    def unpack(cls, data: bytes) -> Load:
        sizes, at, parts = np.frombuffer(data, "<u4", 6), 24, []
        for kind, n in zip(cls.KINDS, sizes.tolist()):
            parts.append(np.frombuffer(data, kind, n, at))
            at += parts[-1].nbytes
        return cls(*parts)

    def contexts(self) -> np.ndarray:
        return (self.high.astype(U) << U(32)) | self.low


def loads(words: Words, learn: np.ndarray, totals: Totals) -> Iterator[tuple[int, Load]]:
    """The pairs of a block by shard. A word's pairs go to one shard; a heavy word's are dealt by context."""
    tokens, before, text = with_ends(words)
    unique, rank = np.unique(tokens, return_inverse=True)
    bits = U(Trie.CHILD_BITS)
    key = (rank.astype(U) << bits) | (before >> U(64 - Trie.CHILD_BITS))
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(key)))
    pair = key[first]
    of, context = (pair >> bits).astype(np.int64), pair & U((1 << Trie.CHILD_BITS) - 1)
    heavy = np.isin(unique, totals.heavy)
    shard = (np.where(heavy[of], mix(context), unique[of] >> U(11)) % U(totals.shards)).astype(np.int64)
    numbers = np.where(learn[text], text.astype(np.uint16) | TRAIN, text.astype(np.uint16))[order]
    by_shard = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[by_shard], np.arange(totals.shards + 1))
    for k in range(totals.shards):
        own = by_shard[cuts[k] : cuts[k + 1]]
        if len(own):
            n = times[own]
            place = np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            word, fans = np.unique(of[own], return_counts=True)
            yield k, Load(unique[word], fans, (context[own] & U(0xFFFFFFFF)).astype(np.uint32),
                          (context[own] >> U(32)).astype(np.uint8), n, numbers[place])


def blocks(docs: DataFrame, totals: Totals) -> DataFrame:
    """block, shard, load, texts: what goes to the shards; ``texts`` lists a block's texts, sent once."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, all_texts = batch["doc_id"].tolist(), plain(batch["text"])
            for low, high in pieces([len(t or "") for t in all_texts], BLOCK_CHARS):
                for begin in range(low, high, BLOCK_TEXTS):
                    end = min(high, begin + BLOCK_TEXTS)
                    found = [words_of(all_texts[a + begin : b + begin]) for a, b in text_pieces(all_texts[begin:end])]
                    shift = np.cumsum([0, *(len(w.hashes) for w in found)])
                    starts = np.concatenate([[0], *(w.starts[1:] + s for w, s in zip(found, shift))])
                    words = Words(np.concatenate([w.hashes for w in found]), starts)
                    learn = np.array([learns(i) for i in ids[begin:end]])
                    own = [None if pd.isna(i) else int(i) for i in ids[begin:end]]
                    listed = [np.array([i or 0 for i in own], "<i8"), np.array([i is None for i in own], "<i8"),
                              (np.diff(words.starts) + 1).astype("<i8")]
                    rows = [(number, k, load.pack(), None) for k, load in loads(words, learn, totals)]
                    rows[0] = (*rows[0][:3], np.stack(listed).tobytes())
                    yield pd.DataFrame(rows, columns=["block", "shard", "load", "texts"])
                    number += 1

    # A block is cut from the rows that come at once.
    return map_frames(docs.select("doc_id", "text"), cut, "block long, shard long, load binary, texts binary", BLOCK_ROWS)


def build_trie(parts: list[Load], totals: Totals) -> tuple[Trie, np.ndarray]:
    """The trie of a shard's training pairs, and the counts of its words in the order of the trie."""
    words = np.unique(np.concatenate([p.words for p in parts]))
    keys, counts = [], []
    for p in parts:
        rank = np.repeat(np.searchsorted(words, p.words), p.fans).astype(U)
        learned = (p.texts & TRAIN > 0).astype(np.int64)
        n = np.add.reduceat(learned, np.cumsum(p.times, dtype=np.int64) - p.times)
        seen = n > 0
        keys.append(((rank << U(Trie.CHILD_BITS)) | p.contexts())[seen])
        counts.append(n[seen])
    key, count = merged(keys, counts)
    of = (key >> U(Trie.CHILD_BITS)).astype(np.int64)
    total = np.bincount(of, count, len(words)).astype(np.int64)
    at = np.searchsorted(totals.heavy, words)
    for k in np.flatnonzero(np.isin(words, totals.heavy)):
        total[k] = totals.heavy_counts[at[k]]
    # Only words of training texts have places in the trie.
    known = np.flatnonzero(total > 0)
    place = np.cumsum(total > 0) - 1
    key = (place[of].astype(U) << U(Trie.CHILD_BITS)) | (key & U((1 << Trie.CHILD_BITS) - 1))
    share = (total[known] + 1) / (totals.tokens + totals.types + 1)
    trie = Trie(
        EliasFano.build(words[known]),
        EliasFano.build(np.searchsorted(place[of], np.arange(len(known) + 1)).astype(U)),
        EliasFano.build(key),
        Codes.build(np.log10(PRIOR * share)),
        Codes.build(np.log10(total[known] + PRIOR), up=True),
        Codes.build(np.log10(count + PRIOR * share[place[of]])),
    )
    return trie, total[known]


def score_load(load: Load, trie: Trie, counts: np.ndarray, totals: Totals) -> np.ndarray:
    """Rows of text number, known tokens, base score and model score of one block's pairs."""
    size = totals.tokens + totals.types + 1
    place = trie.find_words(load.words)
    known = place >= 0
    at = np.maximum(place, 0)
    if len(counts):
        count = np.where(known, counts[at], 0)
        single = np.where(known, trie.single[at], np.log10(PRIOR / size))
        context = np.where(known, trie.context[at], np.log10(PRIOR))
    else:
        count = np.zeros(len(place), np.int64)
        single, context = np.full(len(place), np.log10(PRIOR / size)), np.full(len(place), np.log10(PRIOR))
    of = np.repeat(np.arange(len(load.words)), load.fans)
    child = trie.find_children(place[of], load.contexts())
    seen = np.flatnonzero(child >= 0)
    value = single[of]
    value[seen] = trie.pair[child[seen]]
    value -= context[of]
    base = np.log10((count + 1) / size)[of]
    text, back = np.unique(load.texts & ~TRAIN, return_inverse=True)
    sums = [np.bincount(back, np.repeat(x, load.times), len(text)) for x in (known[of].astype(float), base, value)]
    return np.stack([text.astype(float), *sums])


def score_texts(docs: DataFrame, totals: Totals | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the texts outside the held-out fold and scores all. Texts are read twice; what is
    shuffled grows with the corpus: every word once per task, then every pair of words once per
    block, with the texts it stands in. Group sizes follow SHARD_TOKENS and BLOCK_CHARS, not the
    corpus, also if a third of all tokens are one word.

    Null and empty texts are the end token alone; a null doc_id stays null and counts as fold 0, a
    training fold; repeated rows are texts of their own; an empty table gives an empty result;
    without training texts every token is unknown.
    """
    totals = totals or count_words(docs)

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        parts = [Load.unpack(x) for x in group["load"]]
        built, counts = build_trie(parts, totals)
        handle, path = tempfile.mkstemp(suffix=".trie")
        os.close(handle)
        try:
            built.save(path)
            del built
            trie = Trie.open(path)
            found = [score_load(p, trie, counts, totals).tobytes() for p in parts]
        finally:
            os.unlink(path)
        return pd.DataFrame({"block": group["block"], "sums": found, "texts": group["texts"]})

    def total(group: pd.DataFrame) -> pd.DataFrame:
        listed = next(np.frombuffer(t, "<i8").reshape(3, -1) for t in group["texts"] if t is not None)
        sums = np.zeros((3, listed.shape[1]))
        for part in group["sums"]:
            table = np.frombuffer(part).reshape(4, -1)
            sums[:, table[0].astype(np.int64)] += table[1:]
        ids = [None if missing else i for i, missing in zip(listed[0].tolist(), listed[1].tolist())]
        return pd.DataFrame({
            "doc_id": pd.array(ids, dtype="Int64"),
            "held_out": [not learns(i) if i is not None else False for i in ids],
            "n_tokens": listed[2], "n_known": np.rint(sums[0]).astype(np.int64),
            "train_tokens": totals.tokens, "base_score": sums[1], "score": sums[2],
        })

    answered = blocks(docs, totals).groupBy("shard").applyInPandas(answer, "block long, sums binary, texts binary")
    return answered.groupBy("block").applyInPandas(total, RESULT)
