"""Difficulty bucketing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket thresholds (inclusive lower bounds) and labels.
HARD_FROM = 4.0
MEDIUM_FROM = 3.0
BUCKETS = ("hard", "medium", "easy")


def difficulty_bucket(difficulty: Column) -> Column:
    """hard from 4.0, medium from 3.0, otherwise easy -- a missing score is easy."""
    return (
        F.when(difficulty >= F.lit(HARD_FROM), F.lit("hard"))
        .when(difficulty >= F.lit(MEDIUM_FROM), F.lit("medium"))
        .otherwise(F.lit("easy"))
    )
