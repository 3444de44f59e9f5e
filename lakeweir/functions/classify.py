"""Banding and keyword classification."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status keywords, most severe first, with their label and score.
SEVERITY_LEVELS = [
    (("important", "élevé", "eleve"), "eleve", 3),
    (("modéré", "modere", "moyen"), "modere", 2),
    (("faible", "existant"), "faible", 1),
]
UNKNOWN_SEVERITY = ("inconnu", 0)

# Rating words.
RATING_WORDS = {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5}


def _first_match(cases: Sequence[tuple[Column, Column]], default: Column) -> Column:
    chain = F
    for condition, value in cases:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def band(c: Column, limits: Sequence[tuple[float, str]], default: str, *, at_least: bool = False) -> Column:
    """Label of the first limit the value is below (or at least); NULL falls to ``default``."""
    return _first_match(
        [((c >= limit) if at_least else (c < limit), F.lit(label)) for limit, label in limits],
        F.lit(default),
    )


def flag_positive(c: Column) -> Column:
    """True above zero, false otherwise and for NULL."""
    return F.coalesce(c > 0, F.lit(False))


def severity(status: Column) -> Column:
    """Struct(label, score) of a status text. ``inexistant`` holds ``existant`` and so scores 1.

    The text is lower-cased once, as the single element of an array the cases are mapped over;
    written out, every keyword would lower-case it again.
    """

    def level(label: str, score: int) -> Column:
        return F.struct(F.lit(label).alias("label"), F.lit(score).alias("score"))

    def cases(text: Column) -> Column:
        return _first_match(
            [
                (reduce(lambda a, b: a | b, [text.contains(w) for w in words]), level(label, score))
                for words, label, score in SEVERITY_LEVELS
            ],
            level(*UNKNOWN_SEVERITY),
        )

    return F.get(F.transform(F.array(F.lower(status)), cases), F.lit(0))


def word_rating(word: Column) -> Column:
    """1 to 5 for ``one`` to ``five`` in any case, else NULL."""
    pairs = [F.lit(x) for pair in RATING_WORDS.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.lower(word))
