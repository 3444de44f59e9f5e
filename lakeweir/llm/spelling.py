"""Spelling variants: the vocabulary's acceptor composed with a one-edit transducer and with itself again."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.sources.sinks import staged

SHORTEST = 6
LEAST = 5
RATIO = 5
TYPO = 199
# Code points that the first partitions read before the acceptor begins, at either end of a word.
ENDS = 3
# Words of one acceptor; partitions with more are cut at narrower edit windows. The narrowest hold under 8,200.
LARGEST = 2_000
LETTERS = "A-Za-zÀ-ÿ"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PLACE = ["least", "first", "last", "head", "tail"]


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else."""
    return F.when(
        text.rlike("[À-Þ]"), F.translate(text, CAPITALS, CAPITALS.lower())
    ).otherwise(F.lower(text))


def vocabulary(docs: DataFrame) -> DataFrame:
    """Distinct words of whole texts with their number of occurrences: word, n.

    Counts combine before the shuffle, so a word with most of the occurrences is one row per task.
    """
    found = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"),
        F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{SHORTEST},}}"), F.lit(0))).alias("__found"),
    ).select("__id", lower_ascii(F.col("__found")).alias("__run"))
    hashed = found.withColumn("__h", F.crc32(F.concat("__id", F.lit(":"), "__run").cast("binary")))
    place = (F.col("__h") % F.length("__run")).cast("int")
    cut = F.concat(F.substr("__run", F.lit(1), place), F.substr("__run", place + 2, F.length("__run")))
    word = F.when(F.col("__h") % TYPO == 0, cut).otherwise(F.col("__run"))
    return (
        hashed.select(word.alias("word"))
        .where(F.length("word") >= SHORTEST)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= LEAST)
    )


def _placed(words: DataFrame, places: Sequence[tuple[Column, Column, Column, Column, Column]]) -> DataFrame:
    rows = F.array(*[F.struct(*[c.alias(n) for c, n in zip(place, PLACE)]) for place in places])
    return words.select("word", "n", F.inline(rows))


def end_partitions(words: DataFrame) -> DataFrame:
    """Every word in two partitions: by its first code points, and by its last ones.

    Words one edit apart agree in their first three code points, and the edit comes after them, or
    they first differ within those and agree in their last three, as no word has under six.
    """
    zero, none = F.lit(0), F.lit("")
    return _placed(words, [
        (zero, F.lit(ENDS), zero, F.substr("word", F.lit(1), F.lit(ENDS)), none),
        (zero, zero, F.lit(ENDS), none, F.substr("word", F.length("word") - ENDS + 1, F.lit(ENDS))),
    ])


def _window(shorter: Column, first: Column, last: Column) -> tuple[Column, Column, Column, Column, Column]:
    """Place of a word among pairs whose shorter word has ``shorter`` code points and that first differ in [first, last)."""
    longer = F.length("word") - shorter
    tail = F.substr("word", last + longer + 1, F.length("word"))
    return shorter, first, last, F.substr("word", F.lit(1), first), tail


def narrower(rows: DataFrame) -> DataFrame:
    """The same words by halves of their edit windows: what lies outside a half has to agree.

    Partitions by word ends first become windows for one length of the shorter word. A window of
    one place leaves one code point of the shorter word and two of the longer one, so partitions
    are bounded by the alphabet in the end, whatever the vocabulary.
    """
    length, least = F.length("word"), F.col("least")
    begin, end = F.col("first"), F.col("last")
    roles = F.when(least > 0, F.array(least)).otherwise(
        F.filter(F.array(length, length - 1), lambda x: x >= SHORTEST)
    )
    open_end = rows.select("word", "n", "first", "last", F.explode(roles).alias("least")).withColumn(
        "last", F.when(end == 0, least + 1).otherwise(end).cast("int")
    )
    middle = F.floor((begin + end) / 2).cast("int")
    whole = F.col("__from").alias("first"), F.col("__to").alias("last")
    halves = F.array(F.struct(begin.alias("__from"), middle.alias("__to")), F.struct(middle.alias("__from"), end.alias("__to")))
    cut = open_end.select("word", "n", "least", F.inline(halves)).where("__from < __to").select("word", "n", "least", *whole)
    return _placed(cut, [_window(least, begin, end)])


class Acceptor:
    """Minimal acyclic automaton of sorted distinct words: edges, final states and lengths of what each accepts.

    A state is registered once its last word is in, and a state equal to a registered one is that one.
    """

    def __init__(self, words: Sequence[str]):
        self.edges: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.lengths: list[int] = []
        self._known: dict[tuple, int] = {}
        open_states: list[list] = [[False, {}]]
        before = ""
        for word in words:
            same = 0
            for one, other in zip(before, word):
                if one != other:
                    break
                same += 1
            self._close(open_states, before, same)
            open_states += [[False, {}] for _ in range(len(word) - same)]
            open_states[-1][0] = True
            before = word
        self._close(open_states, before, 0)
        self.start = self._register(*open_states[0])

    def _close(self, states: list[list], word: str, depth: int) -> None:
        while len(states) > depth + 1:
            final, edges = states.pop()
            states[-1][1][word[len(states) - 1]] = self._register(final, edges)

    def _register(self, final: bool, edges: dict[str, int]) -> int:
        key = (final, *edges.items())
        if key not in self._known:
            self._known[key] = len(self.edges)
            self.edges.append(edges)
            self.final.append(final)
            # Bit k: some accepted rest has k code points.
            lengths = int(final)
            for state in edges.values():
                lengths |= self.lengths[state] << 1
            self.lengths.append(lengths)
        return self._known[key]

    def common(self, one: int, other: int, without: str = "") -> Iterator[str]:
        """Texts that both states accept and that do not begin with ``without``."""
        if without:
            if self.final[one] and self.final[other]:
                yield ""
            ways = [(s, self.edges[other][c], c) for c, s in self.edges[one].items() if c != without and c in self.edges[other]]
        else:
            ways = [(one, other, "")]
        while ways:
            one, other, text = ways.pop()
            if not self.lengths[one] & self.lengths[other]:
                continue
            if self.final[one] and self.final[other]:
                yield text
            there = self.edges[other]
            ways += [(s, there[c], text + c) for c, s in self.edges[one].items() if c in there]


def one_edit_pairs(acceptor: Acceptor, reach: int | None = None) -> Iterator[tuple[str, str]]:
    """All pairs of accepted words exactly one edit apart whose first difference is before ``reach``.

    The composition's states are pairs of acceptor states with the transducer's: before the edit
    both are one state, reached by the same text; the edit replaces one code point or inserts one;
    after it both accept the same rest. The edit stands where the words first differ, so that each
    pair has one accepting path: what follows an insertion does not begin with what it inserts.
    """
    ways = [(acceptor.start, "")]
    while ways:
        state, text = ways.pop()
        if reach is not None and len(text) >= reach:
            continue
        edges = list(acceptor.edges[state].items())
        for k, (letter, after) in enumerate(edges):
            ways.append((after, text + letter))
            for other, beyond in edges[:k]:
                if acceptor.lengths[after] & acceptor.lengths[beyond]:
                    for rest in acceptor.common(after, beyond):
                        yield text + letter + rest, text + other + rest
            if acceptor.lengths[after] & acceptor.lengths[state]:
                for rest in acceptor.common(state, after, letter):
                    yield text + rest, text + letter + rest


def neighbours(rows: list[tuple[str, int]], least: int, first: int, last: int, head: str, tail: str) -> dict[str, list]:
    """Of one partition's (word, n): per word its near words' number, and the most frequent one as (-n, word)."""
    counts = {word[len(head) : len(word) - len(tail)]: (word, n) for word, n in rows}
    found: dict[str, list] = {}
    for one, other in one_edit_pairs(Acceptor(sorted(counts)), last - first if last else None):
        pair = counts[one], counts[other]
        if least and min(len(pair[0][0]), len(pair[1][0])) != least:
            continue
        for (word, _), (near, n) in (pair, pair[::-1]):
            mine = found.setdefault(word, [0, (0, "")])
            mine[0] += 1
            mine[1] = min(mine[1], (-n, near))
    return found


def _compose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows():
        for batch in batches:
            yield from zip(*(batch[c].tolist() for c in [*PLACE, "word", "n"]))

    out: list[tuple] = []
    for place, group in groupby(rows(), key=itemgetter(slice(0, 5))):
        members = [row[5:] for row in group]
        if len(members) > 1:
            out += [(word, number, -n, near) for word, (number, (n, near)) in neighbours(members, *place).items()]
        if len(out) >= 10_000:
            yield pd.DataFrame(out, columns=["word", "n_near", "near_n", "near"])
            out = []
    yield pd.DataFrame(out, columns=["word", "n_near", "near_n", "near"])


def near_words(words: DataFrame, largest: int = LARGEST) -> DataFrame:
    """Per word and partition: number of near words there, the most frequent one and its count.

    A pair is found in one partition only. Partitions with more than ``largest`` words are cut at
    narrower windows until none is left, so no task holds a large one and no pair is lost.
    """
    rows, parts = end_partitions(words), []
    while True:
        sizes = rows.groupBy(*PLACE).agg(F.count("*").alias("__words")).where(F.col("__words") > largest)
        # A window of one place is not cut.
        hot = staged(sizes.where((F.col("least") == 0) | (F.col("last") - F.col("first") > 1)).select(*PLACE), "spelling-hot")
        if hot.isEmpty():
            parts.append(rows)
            break
        parts.append(rows.join(hot, PLACE, "left_anti"))
        rows = narrower(rows.join(hot, PLACE, "left_semi"))
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    grouped = together.select(*PLACE, "word", "n").repartition(*PLACE).sortWithinPartitions(*PLACE)
    return grouped.mapInPandas(_compose, "word string, n_near long, near_n long, near string")


def roots(forms: DataFrame) -> DataFrame:
    """Where following ``form`` from each ``word`` ends: word, root.

    Steps double each round, and a form is five times as frequent as its word, so rounds are few.
    """
    links = staged(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-links")
    while not links.where("moved").isEmpty():
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        links = staged(
            links.join(ahead, "root", "left").select(
                "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
            ),
            "spelling-links",
        )
    return links.select("word", "root")


def spelling_variants(docs: DataFrame, largest: int = LARGEST) -> DataFrame:
    """One row per frequent word of ``docs``: word, form, root, n, n_near, form_n.

    Words come from whole texts; null and empty texts have none. A null doc_id counts as an empty
    one, repeated rows count as often as they stand, other columns are not read. Near words of
    equal count are taken in code-point order. An empty table gives an empty result.
    """
    words = staged(vocabulary(docs), "spelling-words")
    near = near_words(words, largest)
    alone = words.select("word", F.lit(0).cast("long").alias("n_near"), F.col("n").alias("near_n"), F.lit(None).cast("string").alias("near"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))))
    stats = alone.unionByName(near).groupBy("word").agg(
        F.max(F.when(F.col("near").isNull(), F.col("near_n"))).alias("n"), F.sum("n_near").alias("n_near"), best.alias("best")
    )
    clear = -F.col("best.n") >= RATIO * F.col("n")
    stats = staged(
        stats.select(
            "word", "n", "n_near", F.when(clear, F.col("best.word")).alias("form"), F.when(clear, -F.col("best.n")).alias("form_n")
        ),
        "spelling-stats",
    )
    ends = roots(stats.where(F.col("form").isNotNull()))
    return stats.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
