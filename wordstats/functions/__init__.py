"""Column expressions shared by the operators (all JVM built-ins)."""

from wordstats.functions.numeric import round_at, pct_of
from wordstats.functions.words import (
    DEFAULT_LENGTH,
    VOWELS,
    letter_cols,
    letter_names,
    normalise_answer,
    single_letter_count,
    split_letters,
    vowel_count,
)
from wordstats.functions.buckets import difficulty_bucket
from wordstats.functions.text import (
    TOKEN_SPLIT,
    first_word_token,
    tokens,
    word_token_in_text,
    word_token_pattern,
    word_tokens,
)

__all__ = [
    "DEFAULT_LENGTH",
    "TOKEN_SPLIT",
    "VOWELS",
    "difficulty_bucket",
    "first_word_token",
    "letter_cols",
    "letter_names",
    "normalise_answer",
    "pct_of",
    "round_at",
    "single_letter_count",
    "split_letters",
    "tokens",
    "vowel_count",
    "word_token_in_text",
    "word_token_pattern",
    "word_tokens",
]
