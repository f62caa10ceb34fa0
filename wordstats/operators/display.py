"""Display-side helpers: names, formatted text, bounded hand-off to pandas.

Formatted text is for showing only: one-decimal text of a value that lies
exactly half-way is rounded up here (Java formatting) where other tools may
round to even, so comparisons should use the numeric columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordstats.functions.words import DEFAULT_LENGTH
from wordstats.plans.refresh import published_run, stored_mart

# Display names of the recent-answers table.
RECENT_DISPLAY_NAMES = {
    "puzzle_number": "Puzzle #",
    "answer": "Answer",
    "answer_date": "Date",
    "day_name": "Day",
    "difficulty": "Difficulty",
    "difficulty_bucket": "Level",
    "vowel_count": "Vowels",
    "unique_letter_count": "Unique Letters",
}


class TooLarge(ValueError):
    pass


def to_pandas_bounded(df: DataFrame, max_rows: int = 10_000):
    """``toPandas`` for small final results only: fetches at most
    ``max_rows + 1`` rows and refuses when the result is larger."""
    pdf = df.limit(max_rows + 1).toPandas()
    if len(pdf) > max_rows:
        raise TooLarge(f"result has more than {max_rows} rows; write it instead")
    return pdf


def register_marts(spark: SparkSession, marts_path: str, names) -> list[str]:
    """Expose the marts of the published run as temporary views (one per name)."""
    folder = published_run(spark, marts_path)
    for name in names:
        stored_mart(spark, folder, name).createOrReplaceTempView(name)
    return list(names)


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def recent_answers_display(recent: DataFrame) -> DataFrame:
    return recent.select(*[F.col(c).alias(RECENT_DISPLAY_NAMES[c]) for c in recent.columns
                           if c in RECENT_DISPLAY_NAMES])


def heatmap_display(heatmap: DataFrame, n: int = DEFAULT_LENGTH) -> DataFrame:
    """Heatmap columns position_k renamed "Position k"."""
    return heatmap.select("letter", *[F.col(f"position_{p}").alias(f"Position {p}")
                                      for p in range(1, n + 1)])


def kpi_display(kpi: DataFrame) -> DataFrame:
    """The KPI row as text: thousands separators, "#" before the latest
    puzzle, two decimals of mean difficulty, one of mean vowels."""
    return kpi.select(
        F.format_number("total_puzzles", 0).alias("total_puzzles"),
        F.concat(F.lit("#"), F.col("latest_puzzle").cast("string")).alias("latest_puzzle"),
        F.format_number("avg_difficulty", 2).alias("avg_difficulty"),
        F.format_number("avg_vowels", 1).alias("avg_vowels"),
    )


def letter_bar_text(top_letters: DataFrame) -> DataFrame:
    """letter, "<bar> <pct with one decimal>%"."""
    return top_letters.select(
        "letter",
        F.format_string("%s %.1f%%", F.col("bar"), F.col("frequency_pct")).alias("bar_text"),
    )
