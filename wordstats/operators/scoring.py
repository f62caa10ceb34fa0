"""Candidate scoring and the top-k prediction list.

A candidate's score at position p is ``round(letter% + position%, 4)`` of
its letter there (0 for letters never seen), and its total is the rounded
sum of those.  Instead of 2 x N joins of the candidates (one per letter
table and position), the two frequency tables are folded into one small
per-letter table holding every position's score (also as one array), so
the candidates are joined N times against the same projection of one tiny
table: one broadcast, reused by all N map-side joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordstats.functions.numeric import round_at
from wordstats.functions.words import DEFAULT_LENGTH, letter_cols, letter_names


def score_names(n: int = DEFAULT_LENGTH) -> list[str]:
    return [f"pos{p}_score" for p in range(1, n + 1)]


def score_table(letter_freq: DataFrame, position_freq: DataFrame,
                n: int = DEFAULT_LENGTH) -> DataFrame:
    """letter, frequency_pct, pos1_score..posN_score, scores (the same as an
    array): one row per letter with its overall share and its score at each
    position."""
    pf_wide = position_freq.groupBy("letter").agg(*[
        F.max(F.when(F.col("position") == F.lit(p), F.col("position_pct"))).alias(f"_pf{p}")
        for p in range(1, n + 1)
    ])
    lf = letter_freq.select("letter", "frequency_pct")
    both = lf.join(pf_wide, "letter", "full")
    zero = F.lit(0.0)
    scores = [round_at(F.coalesce(F.col("frequency_pct"), zero)
                       + F.coalesce(F.col(f"_pf{p}"), zero), 4) for p in range(1, n + 1)]
    return both.select(
        "letter",
        F.coalesce(F.col("frequency_pct"), zero).alias("frequency_pct"),
        *[sc.alias(name) for sc, name in zip(scores, score_names(n))],
        F.array(*scores).alias("scores"),
    )


def lookup_letters(df: DataFrame, table: DataFrame, keys: list[str], values: list[str],
                   broadcast: bool) -> tuple[DataFrame, list]:
    """Left-join ``table`` (keyed by ``letter``) once per key column of
    ``df``; returns the joined frame and, per key, the column holding
    ``values[i]`` of the matching row (null on a miss).

    Every join reads the same table through the same projection, so with a
    broadcast the table is shipped once and the other joins reuse it.  The
    caller projects once at the end (each intermediate projection would be
    one more plan analysis on the driver).
    """
    t = table.select("letter", *sorted(set(values)))
    if broadcast:
        t = F.broadcast(t)
    found = []
    for i, (key, value) in enumerate(zip(keys, values)):
        a = f"_t{i}"
        df = df.join(t.alias(a), F.col(key) == F.col(f"{a}.letter"), "left")
        found.append(F.col(f"{a}.{value}"))
    return df, found


def word_scores(candidates: DataFrame, used_answers: DataFrame, table: DataFrame,
                n: int = DEFAULT_LENGTH, broadcast: bool = True) -> DataFrame:
    """Score every candidate (column ``word``; upper-cased, neither trimmed
    nor deduplicated) and flag the ones already used as answers.

    Output: word, letter_1..N, total_score, pos1_score..posN_score, already_used.
    """
    word = F.upper(F.col("word"))
    cands = candidates.select(word.alias("word")).select("word", *letter_cols(F.col("word"), n))
    names = score_names(n)
    # Every lookup reads the same (letter, scores) projection of the table,
    # so one broadcast serves all N joins.
    cands, found = lookup_letters(cands, table, letter_names(n), ["scores"] * n, broadcast)

    # Membership: left join to the distinct used answers.  No hint: the
    # used set grows with the answer table, so AQE picks broadcast or
    # shuffle from its measured size.
    used = (used_answers.select(F.col("answer").alias("_used")).distinct()
            .withColumn("_is_used", F.lit(True)))
    cands = cands.join(used, F.col("word") == F.col("_used"), "left")

    zero = F.lit(0.0)
    scores = [F.coalesce(F.element_at(f, p), zero) for p, f in zip(range(1, n + 1), found)]
    total = round_at(reduce(lambda a, b: a + b, scores), 4)
    return cands.select(
        "word",
        *letter_names(n),
        total.alias("total_score"),
        *[sc.alias(name) for sc, name in zip(scores, names)],
        F.coalesce(F.col("_is_used"), F.lit(False)).alias("already_used"),
    )


def top_predictions(scores: DataFrame, k: int = 10, n: int = DEFAULT_LENGTH) -> DataFrame:
    """The ``k`` best unused candidates, ranked 1..k by score (ties: word A-Z).

    ``row_number() <= k`` over a global order becomes a per-partition limit
    before the single-task window, so only k rows per partition move.
    """
    order = Window.orderBy(F.desc("total_score"), F.asc_nulls_last("word"))
    ranked = (scores.filter(~F.col("already_used"))
              .withColumn("rank", F.row_number().over(order).cast("long")))
    return ranked.filter(F.col("rank") <= F.lit(k)).select(
        "rank", "word", *letter_names(n), "total_score", *score_names(n))
