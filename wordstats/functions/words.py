"""Word-structure expressions for words of a fixed length ``n``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_LENGTH = 5

# The letters counted as vowels (Y is not one).
VOWELS = ("A", "E", "I", "O", "U")


def letter_names(n: int = DEFAULT_LENGTH, prefix: str = "letter_") -> list[str]:
    return [f"{prefix}{i}" for i in range(1, n + 1)]


def normalise_answer(col: Column) -> Column:
    """Trim spaces, then upper-case."""
    return F.upper(F.trim(col))


def split_letters(word: Column, n: int = DEFAULT_LENGTH) -> list[Column]:
    """The 1-based single characters of ``word``; '' past its end."""
    return [F.substring(word, i, 1) for i in range(1, n + 1)]


def letter_cols(word: Column, n: int = DEFAULT_LENGTH,
                prefix: str = "letter_") -> list[Column]:
    return [c.alias(name) for c, name in zip(split_letters(word, n), letter_names(n, prefix))]


def _sum_ints(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [f.cast("int") for f in flags])


def vowel_count(letters: list[Column]) -> Column:
    return _sum_ints([c.isin(*VOWELS) for c in letters])


def single_letter_count(letters: list[Column]) -> Column:
    """How many positions hold a letter that occurs nowhere else in the word.

    For five letters the possible values are 0, 1, 2, 3 and 5.
    """
    flags = []
    for i, c in enumerate(letters):
        others = [o for j, o in enumerate(letters) if j != i]
        flags.append(~c.isin(*others))
    return _sum_ints(flags)
