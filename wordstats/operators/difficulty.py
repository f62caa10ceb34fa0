"""Difficulty statistics per word pattern."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordstats.functions.numeric import round_at

PATTERN_KEYS = ("vowel_count", "unique_letter_count", "difficulty_bucket")


def difficulty_by_pattern(staged: DataFrame) -> DataFrame:
    """Scored answers grouped by (vowel_count, unique_letter_count,
    difficulty_bucket): word_count, and mean / min / max difficulty rounded
    to two decimals.  Unscored answers are left out here (though they are
    'easy' in staging)."""
    d = F.col("difficulty")
    return (
        staged.filter(d.isNotNull())
        .groupBy(*PATTERN_KEYS)
        .agg(
            F.count(F.lit(1)).alias("word_count"),
            round_at(F.avg(d), 2).alias("avg_difficulty"),
            round_at(F.min(d), 2).cast("float").alias("min_difficulty"),
            round_at(F.max(d), 2).cast("float").alias("max_difficulty"),
        )
    )
