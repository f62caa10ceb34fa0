"""The enriched answer history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordstats.functions.numeric import round_at
from wordstats.operators.scoring import lookup_letters
from wordstats.functions.words import DEFAULT_LENGTH, letter_names


def history_columns(n: int = DEFAULT_LENGTH) -> list[str]:
    return ["puzzle_number", "answer", "answer_date", "day_name", "answer_year",
            "answer_month", *letter_names(n), "difficulty", "difficulty_bucket",
            "vowel_count", "unique_letter_count",
            *[f"{c}_freq_pct" for c in letter_names(n)], "word_commonality_score"]


def answer_history(staged: DataFrame, letter_freq: DataFrame, n: int = DEFAULT_LENGTH,
                   broadcast: bool = True) -> DataFrame:
    """Staged answers plus each letter's overall frequency (0 when unseen)
    and their rounded sum (a repeated letter counts each time)."""
    names = letter_names(n)
    out, found = lookup_letters(staged, letter_freq, names, ["frequency_pct"] * n, broadcast)
    pcts = [F.coalesce(f, F.lit(0.0)) for f in found]
    total = round_at(reduce(lambda a, b: a + b, pcts), 4)
    base = [F.col(c) for c in history_columns(n)[:-(n + 1)]]
    return out.select(*base, *[p.alias(f"{c}_freq_pct") for p, c in zip(pcts, names)],
                      total.alias("word_commonality_score"))
