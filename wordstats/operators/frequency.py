"""Letter and letter-by-position frequencies.

Everything comes from one aggregation keyed by letter: the words are
unpivoted with ``posexplode`` (one scan, not a union of N scans) and each
letter gets its total count plus one conditional count per position.
Map-side partial aggregation leaves at most one row per distinct letter per
task, so the shuffle carries a few hundred rows per task whatever the input
size, and a hot letter cannot skew it.

Every word yields exactly one row per position, so the number of words is
``sum(total_count) / n`` -- no second pass over the words.  The shares then
need one window over the grouped rows (one per letter), which is the only
single-task step and is bounded by the alphabet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordstats.functions.numeric import pct_of, round_at
from wordstats.functions.words import DEFAULT_LENGTH, letter_names


def count_names(n: int = DEFAULT_LENGTH) -> list[str]:
    return [f"count_{p}" for p in range(1, n + 1)]


def letter_counts(words: DataFrame, n: int = DEFAULT_LENGTH) -> DataFrame:
    """letter, total_count, count_1..count_N (occurrences at each position)."""
    unpivoted = words.select(
        F.posexplode(F.array(*[F.col(c) for c in letter_names(n)])).alias("_p", "letter"))
    return unpivoted.groupBy("letter").agg(
        F.count(F.lit(1)).alias("total_count"),
        *[F.count(F.when(F.col("_p") == F.lit(p - 1), F.lit(1))).alias(name)
          for p, name in zip(range(1, n + 1), count_names(n))],
    )


def with_totals(counts: DataFrame) -> DataFrame:
    """Adds ``_all`` (all letters) and ``frequency_rank`` to the per-letter
    counts; both windows have no partition key and see one row per letter."""
    return counts.select(
        "*",
        F.sum("total_count").over(Window.partitionBy()).alias("_all"),
        F.rank().over(Window.orderBy(F.desc("total_count"))).cast("long")
        .alias("frequency_rank"),
    )


def letter_frequency_from_counts(counts: DataFrame) -> DataFrame:
    """letter, total_count, frequency_pct (share of all letters, %), frequency_rank."""
    t = with_totals(counts)
    return t.select(
        "letter",
        F.col("total_count").cast("long").alias("total_count"),
        pct_of(F.col("total_count"), F.col("_all")).alias("frequency_pct"),
        "frequency_rank",
    )


def position_frequency_from_counts(counts: DataFrame, n: int = DEFAULT_LENGTH) -> DataFrame:
    """position, letter, position_count, position_pct (share of words, %):
    one row per letter seen at a position."""
    words = F.sum("total_count").over(Window.partitionBy()) / F.lit(n)
    t = counts.select("letter", *count_names(n), words.alias("_words"))
    cells = F.array(*[F.struct(F.lit(p).alias("position"), F.col(c).alias("position_count"))
                      for p, c in zip(range(1, n + 1), count_names(n))])
    long = (t.select("letter", "_words", F.inline(cells))
            .filter(F.col("position_count") > F.lit(0)))
    return long.select(
        F.col("position").cast("int").alias("position"),
        "letter",
        F.col("position_count").cast("long").alias("position_count"),
        pct_of(F.col("position_count"), F.col("_words")).alias("position_pct"),
    )


def letter_frequency(words: DataFrame, n: int = DEFAULT_LENGTH) -> DataFrame:
    return letter_frequency_from_counts(letter_counts(words, n))


def position_frequency(words: DataFrame, n: int = DEFAULT_LENGTH) -> DataFrame:
    return position_frequency_from_counts(letter_counts(words, n), n)


def letter_frequency_by(words: DataFrame, group: str, n: int = DEFAULT_LENGTH) -> DataFrame:
    """letter_frequency within each value of ``group`` (e.g. a language):
    group, letter, total_count, frequency_pct, frequency_rank.  The windows
    are partitioned by the group and see one row per (group, letter)."""
    unpivoted = words.select(
        group, F.explode(F.array(*[F.col(c) for c in letter_names(n)])).alias("letter"))
    counts = unpivoted.groupBy(group, "letter").agg(F.count(F.lit(1)).alias("total_count"))
    per_group = Window.partitionBy(group)
    t = counts.select(
        "*",
        F.sum("total_count").over(per_group).alias("_all"),
        F.rank().over(per_group.orderBy(F.desc("total_count"))).cast("long")
        .alias("frequency_rank"),
    )
    return t.select(group, "letter", "total_count",
                    pct_of(F.col("total_count"), F.col("_all")).alias("frequency_pct"),
                    "frequency_rank")


def letter_table_from_counts(counts: DataFrame, n: int = DEFAULT_LENGTH) -> DataFrame:
    """letter, total_count, count_1..count_N, frequency_pct,
    pos1_score..posN_score and ``scores`` (the same N scores as one array)
    in one projection: score at p = round(letter share + share of words
    with the letter at p, 4)."""
    t = with_totals(counts)
    words = F.col("_all") / F.lit(n)
    share = pct_of(F.col("total_count"), F.col("_all"))
    at = [pct_of(F.col(c), words) for c in count_names(n)]
    base = t.select("letter", "total_count", *count_names(n), share.alias("frequency_pct"),
                    *[a.alias(f"_pp{p}") for p, a in zip(range(1, n + 1), at)])
    # A letter never seen at p has count 0 there, so its share is exactly 0.0.
    scores = [round_at(F.col("frequency_pct") + F.col(f"_pp{p}"), 4) for p in range(1, n + 1)]
    # The counts stay in the table, so the letter and position tables can be
    # derived from it without another pass over the answers.
    return base.select(
        "letter", "total_count", *count_names(n), "frequency_pct",
        *[sc.alias(f"pos{p}_score") for p, sc in zip(range(1, n + 1), scores)],
        F.array(*scores).alias("scores"),
    )


__all__ = [
    "count_names",
    "letter_counts",
    "letter_frequency",
    "letter_frequency_by",
    "letter_frequency_from_counts",
    "letter_table_from_counts",
    "position_frequency",
    "position_frequency_from_counts",
]
