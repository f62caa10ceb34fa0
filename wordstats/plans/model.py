"""The word model: staged answers and the per-letter table the marts share.

The per-letter table (overall share plus the score at every position) is
what the lookups of the history and the scores read.  It is computed in one
pass over the staged answers and materialised once; its exact row count
then decides whether the lookups broadcast (``wordstats.operators.lookup``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from wordstats.functions.words import DEFAULT_LENGTH
from wordstats.operators.frequency import (
    letter_counts,
    letter_frequency_from_counts,
    letter_table_from_counts,
    position_frequency_from_counts,
)
from wordstats.operators.history import answer_history
from wordstats.operators.lookup import Materialised, materialise
from wordstats.operators.scoring import top_predictions, word_scores
from wordstats.operators.staging import stage_answers


@dataclass
class WordModel:
    """``letters`` is the materialised per-letter table: letter, total_count,
    count_1..count_N, frequency_pct, pos1_score..posN_score, scores."""

    staged: DataFrame
    letters: Materialised
    n: int = DEFAULT_LENGTH

    def letter_frequency(self) -> DataFrame:
        """The letter table, from the stored counts (no pass over the answers)."""
        return letter_frequency_from_counts(self.letters.df)

    def position_frequency(self) -> DataFrame:
        return position_frequency_from_counts(self.letters.df, self.n)

    def answer_history(self) -> DataFrame:
        return answer_history(self.staged, self.letters.df, self.n, False)

    def word_scores(self, candidates: DataFrame) -> DataFrame:
        return word_scores(candidates, self.staged, self.letters.df, self.n, False)

    def top_predictions(self, candidates: DataFrame, k: int = 10) -> DataFrame:
        return top_predictions(self.word_scores(candidates), k, self.n)


def letter_table(staged: DataFrame, n: int = DEFAULT_LENGTH) -> DataFrame:
    """One aggregation over the answers, one window over its letter rows."""
    return letter_table_from_counts(letter_counts(staged, n), n)


def model_from_staged(staged: DataFrame, n: int = DEFAULT_LENGTH) -> WordModel:
    """Materialise the letter table of ``staged`` (one eager job: the only
    pass over the answers that the lookups need)."""
    return WordModel(staged, materialise(letter_table(staged, n)), n)


def build_model(raw: DataFrame, n: int = DEFAULT_LENGTH) -> WordModel:
    return model_from_staged(stage_answers(raw, n), n)
