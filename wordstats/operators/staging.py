"""Clean raw answers into one typed row per puzzle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordstats.functions.buckets import difficulty_bucket
from wordstats.functions.words import (
    DEFAULT_LENGTH,
    letter_names,
    normalise_answer,
    single_letter_count,
    split_letters,
    vowel_count,
)


def staged_columns(n: int = DEFAULT_LENGTH) -> list[str]:
    return (["puzzle_number", "answer", *letter_names(n), "answer_date", "day_name",
             "answer_year", "answer_month", "difficulty", "difficulty_bucket",
             "vowel_count", "unique_letter_count"])


def stage_answers(raw: DataFrame, n: int = DEFAULT_LENGTH) -> DataFrame:
    """Drop null answers and answers whose trimmed length is not ``n``;
    normalise the answer, split it into letters and derive word features.

    Input columns: puzzle_number, answer, date, day_name, difficulty.
    The null test reaches the Parquet scan as a pushed filter; the length
    test runs right after it in the same codegen stage.
    """
    answer = F.col("answer")
    kept = raw.filter(answer.isNotNull() & (F.length(F.trim(answer)) == F.lit(n)))
    word = normalise_answer(answer)
    letters = split_letters(word, n)
    d = F.col("date").cast("date")
    first = kept.select(
        F.col("puzzle_number").cast("long").alias("puzzle_number"),
        word.alias("answer"),
        *[c.alias(name) for c, name in zip(letters, letter_names(n))],
        d.alias("answer_date"),
        F.col("day_name").cast("string").alias("day_name"),
        F.year(d).cast("long").alias("answer_year"),
        F.month(d).cast("long").alias("answer_month"),
        F.col("difficulty").cast("float").alias("difficulty"),
    )
    # Features read the letter columns computed once above.
    lcols = [F.col(c) for c in letter_names(n)]
    return first.select(
        *first.columns[:-1],
        "difficulty",
        difficulty_bucket(F.col("difficulty")).alias("difficulty_bucket"),
        vowel_count(lcols).alias("vowel_count"),
        single_letter_count(lcols).alias("unique_letter_count"),
    ).select(*staged_columns(n))
