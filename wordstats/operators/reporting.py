"""Report datasets derived from the marts (what a dashboard displays).

Each is a small result computed on the cluster; only the final rows ever
need to reach a client (``toPandas`` on these is safe: they are bounded by
10, 20, the alphabet, the bucket count or the number of positions -- except
the trend, which is one row per scored puzzle and stays distributed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordstats.functions.numeric import pct_of
from wordstats.functions.words import DEFAULT_LENGTH, letter_names
from wordstats.operators.scoring import score_names

# Display constants.
BAR_CHAR = "█"          # one block per half percent
BAR_UNITS_PER_PCT = 2
BAR_WIDTH_STEP = 5           # width in % per block, capped at 100
TOP_LETTERS = 10
RECENT_ANSWERS = 20
LATEST_RAW_ROWS = 5
TREND_ROWS = 30


def kpi_row(staged: DataFrame) -> DataFrame:
    """total_puzzles, latest_puzzle, avg_difficulty (scored only), avg_vowels."""
    return staged.agg(
        F.count(F.lit(1)).alias("total_puzzles"),
        F.max("puzzle_number").alias("latest_puzzle"),
        F.avg("difficulty").alias("avg_difficulty"),
        F.avg("vowel_count").alias("avg_vowels"),
    )


def prediction_bars(predictions: DataFrame) -> DataFrame:
    """rank, word, total_score, score_pct: score as percent of the best one
    (0 when the best is not positive)."""
    best = F.max("total_score").over(Window.partitionBy())
    with_best = predictions.select("rank", "word", "total_score", best.alias("_best"))
    return with_best.select(
        "rank", "word", "total_score",
        F.when(F.col("_best") > F.lit(0.0),
               F.col("total_score") / F.col("_best") * F.lit(100.0))
        .otherwise(F.lit(0.0)).alias("score_pct"),
    )


def winner_breakdown(predictions: DataFrame, n: int = DEFAULT_LENGTH) -> DataFrame:
    """The rank-1 word's letters and position scores, one row per position:
    position, letter, score, label ("Pos i (L)")."""
    pairs = F.array(*[F.struct(F.col(l).alias("letter"), F.col(s).alias("score"))
                      for l, s in zip(letter_names(n), score_names(n))])
    rows = (predictions.filter(F.col("rank") == F.lit(1))
            .select(F.posexplode(pairs).alias("_p", "_v")))
    position = (F.col("_p") + 1).cast("int")
    return rows.select(
        position.alias("position"),
        F.col("_v.letter").alias("letter"),
        F.col("_v.score").alias("score"),
        F.format_string("Pos %d (%s)", position, F.col("_v.letter")).alias("label"),
    )


def winner_word(predictions: DataFrame, n: int = DEFAULT_LENGTH) -> DataFrame:
    """rank, word, rebuilt: every predicted word put together from its letter columns."""
    return predictions.select("rank", "word", F.concat(*letter_names(n)).alias("rebuilt"))


def top_letters(letter_freq: DataFrame, k: int = TOP_LETTERS) -> DataFrame:
    """The k most frequent letters with a text bar: bar_len blocks (two per
    percent, truncated), the bar itself, and bar_width (5% per block, <= 100)."""
    top = letter_freq.orderBy(F.desc("total_count"), F.asc("letter")).limit(k)
    blocks = (F.col("frequency_pct") * F.lit(float(BAR_UNITS_PER_PCT))).cast("int")
    return top.select(
        "letter", "total_count", "frequency_pct", "frequency_rank",
        blocks.alias("bar_len"),
        F.repeat(F.lit(BAR_CHAR), blocks).alias("bar"),
        F.least(blocks * F.lit(BAR_WIDTH_STEP), F.lit(100)).alias("bar_width"),
    )


def position_heatmap(position_freq: DataFrame, n: int = DEFAULT_LENGTH) -> DataFrame:
    """Letters x positions of position_pct (mean per cell, 0 where absent),
    columns position_1..position_N.  The pivot values are given, so no job
    runs to discover them."""
    pivot = (position_freq.groupBy("letter")
             .pivot("position", list(range(1, n + 1)))
             .agg(F.avg("position_pct")))
    return pivot.select(
        "letter",
        *[F.coalesce(F.col(str(p)), F.lit(0.0)).alias(f"position_{p}") for p in range(1, n + 1)],
    )


def strongest_letter(position_freq: DataFrame) -> DataFrame:
    """Per position, the letter with the highest share (ties: letter A-Z)."""
    w = Window.partitionBy("position").orderBy(F.desc("position_pct"), F.asc("letter"))
    return (position_freq.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == F.lit(1))
            .select("position", "letter", "position_pct"))


def difficulty_distribution(staged: DataFrame) -> DataFrame:
    """Puzzles per difficulty bucket (unscored ones count as easy) and share %."""
    counts = staged.groupBy("difficulty_bucket").agg(F.count(F.lit(1)).alias("puzzles"))
    with_total = counts.select("difficulty_bucket", "puzzles",
                               F.sum("puzzles").over(Window.partitionBy()).alias("_all"))
    return with_total.select("difficulty_bucket", "puzzles",
                             pct_of(F.col("puzzles"), F.col("_all")).alias("share_pct"))


def vowel_distribution(staged: DataFrame) -> DataFrame:
    """Puzzles per vowel count, with a label such as "1 vowel" / "2 vowels"."""
    counts = staged.groupBy("vowel_count").agg(F.count(F.lit(1)).alias("puzzles"))
    v = F.col("vowel_count")
    return counts.select(
        "vowel_count", "puzzles",
        F.concat(v.cast("string"), F.lit(" vowel"),
                 F.when(v != F.lit(1), F.lit("s")).otherwise(F.lit(""))).alias("label"),
    )


def recent_answers(staged: DataFrame, k: int = RECENT_ANSWERS) -> DataFrame:
    """The k latest puzzles (a distributed top-k: k rows per task move)."""
    return (staged.orderBy(F.desc("puzzle_number")).limit(k)
            .select("puzzle_number", "answer", "answer_date", "day_name", "difficulty",
                    "difficulty_bucket", "vowel_count", "unique_letter_count"))


def latest_raw_rows(raw: DataFrame, k: int = LATEST_RAW_ROWS) -> DataFrame:
    return (raw.orderBy(F.desc_nulls_last("puzzle_number")).limit(k)
            .select("puzzle_number", "answer", "date", "day_name", "difficulty"))


def answer_duplicates(df: DataFrame) -> DataFrame:
    """(puzzle_number, answer) pairs stored more than once, with times_used."""
    return (df.groupBy("puzzle_number", "answer")
            .agg(F.count(F.lit(1)).alias("times_used"))
            .filter(F.col("times_used") > F.lit(1)))


def word_repeats(staged: DataFrame, max_repeats: int = 1) -> DataFrame:
    """Answers used more than ``max_repeats`` times (answer, times_used)."""
    return (staged.groupBy("answer").agg(F.count(F.lit(1)).alias("times_used"))
            .filter(F.col("times_used") > F.lit(max_repeats)))


def difficulty_trend(staged: DataFrame, rows: int = TREND_ROWS, **kw) -> DataFrame:
    """Scored puzzles in puzzle order with the mean of the last ``rows``
    scored difficulties (counted in rows, not days)."""
    from wordstats.operators.trailing import trailing_mean

    scored = (staged.filter(F.col("difficulty").isNotNull())
              .select("puzzle_number", "difficulty"))
    return trailing_mean(scored, "puzzle_number", "difficulty", rows, "rolling_avg", **kw)
