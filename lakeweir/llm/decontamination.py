"""Benchmark decontamination: n-gram seeds, a bound by shared words, then local alignment of words."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.common import U, Words, by_text, grams_of, map_frames, pieces, plain, text_pieces, words_of

GRAM = 2  # words of a seed
SHORT = 3  # items of up to so many words have single words as seeds
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5  # alignment score against that of a whole verbatim copy
BLOCK = 50_000  # items whose n-grams are broadcast at once; a larger benchmark takes several passes
ENTRIES = 1 << 15  # seed hits, times the items of each seed, that are bounded at once

MATCHES = (
    "doc_id long, item_id long, score double, identity double, n_seeds long, "
    "item_words long, doc_start long, doc_end long"
)


class Item(NamedTuple):
    item_id: int
    words: np.ndarray
    grams: np.ndarray


def gram_words(length: int) -> int:
    """Words of the seeds of an item of ``length`` words.

    An alignment without two words matching in a row has a break for each match but one, so its
    score is one more than the item's words at most: it is no match, except just at THRESHOLD.
    """
    return GRAM if length > SHORT else 1


def items_of(rows) -> list[Item]:
    """Items with at least one word. Null ids and null or blank texts can't be found and are left out."""
    rows = [(i, t) for i, t in rows if i is not None and t is not None]
    words = words_of([t for _, t in rows])
    parts = [(rows[k][0], words.of(k)) for k in range(len(rows))]
    return [Item(i, w, grams_of(w, gram_words(len(w)))) for i, w in parts if len(w)]


def lengths_of(items: list[Item]) -> list[int]:
    """Lengths of n-grams in use."""
    return sorted({gram_words(len(i.words)) for i in items})


class Seeds:
    """Sorted n-grams to look for. A bit per leading bits of the hash turns most places away first."""

    BITS = 22

    def __init__(self, grams: np.ndarray, lengths: list[int]):
        self.grams, self.lengths = grams, lengths
        self.maybe = np.zeros(1 << self.BITS, dtype=bool)
        self.maybe[grams >> U(64 - self.BITS)] = True

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, place in ``grams`` and word position of every hit, ordered by text."""
        found = []
        for n in self.lengths:
            grams = grams_of(words.hashes, n)
            position = np.flatnonzero(self.maybe[grams >> U(64 - self.BITS)])
            at = np.minimum(np.searchsorted(self.grams, grams[position]), len(self.grams) - 1)
            text = np.searchsorted(words.starts, position, side="right") - 1
            own = (self.grams[at] == grams[position]) & (position + n <= words.starts[text + 1])
            found.append((text[own], at[own], position[own] - words.starts[text[own]]))
        text, at, position = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(text, kind="stable")
        return text[order], at[order], position[order]


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int, int]:
    """Smith-Waterman over words: best score, words that match on its path, and its span in ``text``."""
    n = len(text)
    steps = np.arange(n + 1) * -GAP
    table = np.zeros((len(item) + 1, n + 1), dtype=np.int32)
    for i, word in enumerate(item, 1):
        row = np.zeros(n + 1, dtype=np.int32)
        row[1:] = np.maximum(table[i - 1, :-1] + np.where(text == word, MATCH, MISMATCH), table[i - 1, 1:] + GAP)
        np.maximum(row, 0, out=row)
        # A gap from any earlier cell of the row: running maximum after adding what the gap costs.
        table[i] = np.maximum.accumulate(row + steps) - steps
    i, j = np.unravel_index(int(table.argmax()), table.shape)
    best, end, same = int(table[i, j]), int(j), 0
    while i > 0 and j > 0 and table[i, j] > 0:
        equal = item[i - 1] == text[j - 1]
        if table[i, j] == table[i - 1, j - 1] + (MATCH if equal else MISMATCH):
            same += bool(equal)
            i, j = i - 1, j - 1
        elif table[i, j] == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return best, same, int(j), end


def regions(begins: np.ndarray, length: int, spare: int, n_words: int) -> list[tuple[int, int]]:
    """Windows of a text around the places where an item may begin; touching ones are one."""
    out: list[tuple[int, int]] = []
    for begin in np.unique(begins):
        low, high = max(0, int(begin) - spare), min(n_words, int(begin) + length + spare)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def gap_steps(most: int, growth: float) -> Iterator[tuple[int, int]]:
    """(less, gaps): ranges of numbers of gaps above ``less`` and up to ``gaps``, which together hold 0 to ``most``."""
    less = -1
    while less < most:
        gaps = less + max(1, int(less * growth))
        yield less, gaps
        less = gaps


class Matcher:
    """Items with all their n-grams, ready to look for them in texts. Its size follows the block of items."""

    def __init__(self, items: list[Item], threshold: float):
        self.items, self.threshold = items, threshold
        self.lengths = np.array([len(i.words) for i in items])
        # A match loses at most so much to gaps, so it lies within so many words of where a seed puts the item.
        self.spare = np.ceil(MATCH * self.lengths * (1 - threshold)).astype(np.int64)
        gram = np.concatenate([i.grams for i in items])
        owner = np.repeat(np.arange(len(items)), [len(i.grams) for i in items])
        offset = np.concatenate([np.arange(len(i.grams)) for i in items])
        order = np.argsort(gram, kind="stable")
        grams, first = np.unique(gram[order], return_index=True)
        self.seeds = Seeds(grams, lengths_of(items))
        self.first = np.append(first, len(gram))
        self.owner, self.offset = owner[order], offset[order]
        self.vocabulary, number = np.unique(np.concatenate([i.words for i in items]), return_inverse=True)
        self._choose_rare(number)

    def _choose_rare(self, number: np.ndarray) -> None:
        """Per item its rarest words, and how many of them a match has at least.

        A match has at least ``threshold`` of an item's words in place. So of the words that are
        left when a set of others is taken away, it has all but what that set may cover: of the
        rarest m - threshold * m + k words it has k. Rare is what few items hold.
        """
        owner = np.repeat(np.arange(len(self.items)), self.lengths)
        offset = np.arange(len(number)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        held = np.unique(owner * len(self.vocabulary) + number) % len(self.vocabulary)
        often = np.bincount(held, minlength=len(self.vocabulary))
        least = np.ceil(self.threshold * self.lengths - 1e-9).astype(np.int64)
        self.need = np.minimum(1 + self.lengths // 8, np.maximum(least, 1))
        order = np.lexsort((number, often[number], owner))
        rank = np.arange(len(number)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        rare = order[rank < (self.lengths - least + self.need)[owner[order]]]
        rare = rare[np.argsort(number[rare], kind="stable")]
        self.rare_first = np.searchsorted(number[rare], np.arange(len(self.vocabulary) + 2))
        self.rare_owner, self.rare_offset = owner[rare], offset[rare]

    def rare_places(self, number: np.ndarray, span: int) -> np.ndarray:
        """Where rare words of the items stand in the texts: sorted keys of item and the word it would begin at."""
        times = self.rare_first[number + 1] - self.rare_first[number]
        entry = np.repeat(self.rare_first[number], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        begin = np.repeat(np.arange(len(number)), times) - self.rare_offset[entry]
        return np.sort(self.rare_owner[entry] * span + begin + span // 4)

    def rare_enough(self, rare: np.ndarray, key: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Whether enough rare words lie near each place, by some number of gaps.

        A match with g gaps has ``threshold`` of the item's words and g / 2 more, as each gap costs half
        of what a word brings, and none of them lies further than g from where another puts the item.
        """

        def near(rows: np.ndarray, reach: np.ndarray) -> np.ndarray:
            return np.searchsorted(rare, key[rows] + reach, side="right") - np.searchsorted(rare, key[rows] - reach)

        spare, need = self.spare[owner], self.need[owner]
        passed = np.zeros(len(key), dtype=bool)
        rows = np.flatnonzero(near(np.arange(len(key)), spare) >= need)
        for less, gaps in gap_steps(int(self.spare.max()), 1.0):
            rows = rows[~passed[rows] & (spare[rows] > less)]
            passed[rows] = near(rows, np.minimum(gaps, spare[rows])) >= need[rows] + (less + 1) // 2
        return passed

    def search(self, texts) -> Iterator[tuple[int, list[tuple]]]:
        """Of the texts with matches: place in ``texts``, and what was found there."""
        # Hits grow with the items, so more items take shorter runs of texts at once.
        for begin, end in text_pieces(texts, max(1 << 14, (1 << 29) // (1024 + len(self.items)))):
            words = words_of(texts[begin:end])
            places = self.places(words)
            for k in np.unique(places[0]):
                own = slice(*np.searchsorted(places[0], [k, k + 1]))
                if found := self.find(words.of(k), places[1][own], places[2][own]):
                    yield begin + int(k), found

    def places(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, item and word where the item would begin, of all seed hits whose surroundings share
        enough words with the item for a match; ordered by text.

        First counted are the item's rare words that would put its beginning near the same word, all
        hits at once; only around what is left all words are looked at.
        """
        text, at, position = self.seeds.hits(words)
        times = self.first[at + 1] - self.first[at]
        number = np.minimum(np.searchsorted(self.vocabulary, words.hashes), len(self.vocabulary) - 1)
        number[self.vocabulary[number] != words.hashes] = len(self.vocabulary)
        local = np.zeros(len(self.vocabulary) + 1, dtype=np.int64)
        # A key holds an item and a word of all texts where it may begin, before the first one too.
        span = 4 * (len(words.hashes) + int(self.lengths.max()) + int(self.spare.max()) + 1)
        rare = self.rare_places(number, span)
        out = [np.zeros((3, 0), dtype=np.int64)]
        for low, high in pieces(times.tolist(), ENTRIES):
            n, first = times[low:high], self.first[at[low:high]]
            entry = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            owner = self.owner[entry]
            begin = np.repeat(position[low:high] + words.starts[text[low:high]], n) - self.offset[entry]
            # Each place once, ordered by item, word and text: neighbours are looked up next to each other.
            texts = len(words.starts) - 1
            whole = np.unique((owner * span + begin + span // 4) * texts + np.repeat(text[low:high], n))
            key, of = whole // texts, whole % texts
            left = np.flatnonzero(self.rare_enough(rare, key, key // span))
            key, of = key[left], of[left]
            rows = np.stack([key // span, of, key % span - span // 4 - words.starts[of]])
            rows = rows[:, np.lexsort(rows[::-1])]
            for group in np.split(rows, np.flatnonzero(np.diff(rows[0])) + 1, axis=1):
                if group.shape[1]:
                    out.append(group[:, self.may_match(int(group[0, 0]), words.starts[group[1]] + group[2], number, local)])
        owner, text, begin = np.concatenate(out, axis=1)
        order = np.lexsort((owner, text))
        return text[order], owner[order], begin[order]

    def may_match(self, owner: int, begins: np.ndarray, number: np.ndarray, local: np.ndarray) -> np.ndarray:
        """Whether the words around ``begins`` that the item has too, each as often as in the item at
        most, would reach the threshold if all of them matched, by some number of gaps. Words of
        neighbouring texts may count."""
        length, spare = int(self.lengths[owner]), int(self.spare[owner])
        own, often = np.unique(self.items[owner].words, return_counts=True)
        at = np.searchsorted(self.vocabulary, own)
        local[at] = np.arange(1, len(own) + 1)
        window = np.arange(-spare, length + spare)
        inside = local[number[np.clip(begins[:, None] + window, 0, len(number) - 1)]]
        local[at] = 0
        enough = np.count_nonzero(inside, axis=1) >= self.threshold * length
        left = np.flatnonzero(enough)
        size = len(own) + 1
        seen = np.bincount((np.arange(len(left))[:, None] * size + inside[left]).ravel(), minlength=len(left) * size)
        shared = np.minimum(seen.reshape(len(left), size)[:, 1:], often).sum(axis=1)
        left = left[shared >= self.threshold * length]
        enough[:] = False
        for less, gaps in gap_steps(spare, 0.3):
            part = inside[left, spare - min(gaps, spare) : spare + length + gaps]
            seen = np.bincount((np.arange(len(left))[:, None] * size + part).ravel(), minlength=len(left) * size)
            shared = np.minimum(seen.reshape(len(left), size)[:, 1:], often).sum(axis=1)
            passed = shared >= self.threshold * length + (less + 1) / 2
            enough[left[passed]] = True
            left = left[~passed]
        return enough

    def find(self, words: np.ndarray, owner: np.ndarray, begin: np.ndarray) -> list[tuple]:
        """Per item found: id, score, identity, seeds, its words, span of the best alignment in words."""
        out = []
        for group in np.split(np.arange(len(owner)), np.flatnonzero(np.diff(owner)) + 1):
            k = owner[group[0]]
            item = self.items[k]
            best = (0, 0, 0, 0)
            for low, high in regions(begin[group], len(item.words), int(self.spare[k]), len(words)):
                score, same, start, end = align(item.words, words[low:high])
                best = max(best, (score, same, low + start, low + end))
            share = best[0] / (MATCH * len(item.words))
            if share >= self.threshold:
                seeds = int(np.isin(item.grams, grams_of(words, gram_words(len(item.words)))).sum())
                out.append((item.item_id, share, best[1] / len(item.words), seeds, len(item.words), best[2], best[3]))
        return out


def matches_of(docs: DataFrame, matcher: Matcher) -> DataFrame:
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in MATCHES.split(", ")]
        for batch in batches:
            ids = batch["doc_id"].tolist()
            rows = [(ids[k], *match) for k, found in matcher.search(plain(batch["text"])) for match in found]
            yield pd.DataFrame(rows, columns=names)

    return map_frames(docs.select("doc_id", "text"), find, MATCHES)


def blocks(benchmark: DataFrame) -> Iterator[list[Item]]:
    """The benchmark in blocks of about BLOCK items, cut by a hash of the item. Equal rows count once."""
    rows = benchmark.select("item_id", "text").where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).distinct()
    n = max(1, -(-rows.count() // BLOCK))
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k) if n > 1 else rows
        items = items_of(sorted((r["item_id"], r["text"]) for r in part.collect()))
        if items:
            yield items


def find_contamination(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of a document and a benchmark item that it contains: doc_id, item_id, score, identity,
    n_seeds, item_words, doc_start, doc_end (words, end excluded).

    One scan of the whole texts and no shuffle of them looks for all n-grams of the items and aligns
    around those hits whose surroundings share enough words. At THRESHOLD that finds what aligning
    every text with every item would, but for a copy in which no two words match in a row; such a
    copy scores one word over half of the item's at most. What is broadcast is one block of items;
    larger benchmarks go block by block. ``score`` is the Smith-Waterman score over that of a
    verbatim copy; ``n_seeds`` counts the item's n-grams that the text holds. A null or empty text matches nothing; a null doc_id stays null;
    repeated rows give repeated results; equal items with other ids match each; with an empty
    benchmark or table the result is empty.
    """
    found = [matches_of(docs, Matcher(items, threshold)) for items in blocks(benchmark)]
    if not found:
        return docs.sparkSession.createDataFrame([], MATCHES)
    return reduce(DataFrame.unionAll, found)


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose whole text contains no benchmark item."""
    for items in blocks(benchmark):
        matcher = Matcher(items, threshold)

        def clean(texts: list, matcher=matcher) -> np.ndarray:
            out = np.ones(len(texts), dtype=bool)
            out[[k for k, _ in matcher.search(texts)]] = False
            return out

        docs = docs.where(by_text(F.col("text"), lambda clean=clean: clean, "boolean"))
    return docs
