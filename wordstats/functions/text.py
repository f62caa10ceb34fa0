"""Tokens of free text: maximal runs between spaces, newlines and tabs.

A *word token* is a token made of exactly ``n`` ASCII letters.  ASCII only,
because upper-casing other letters is engine dependent (sharp s, ligatures).
The anchors are ``^`` and ``\\z``: ``$`` would also match before a final
line break.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordstats.functions.words import DEFAULT_LENGTH

# The token separators.
TOKEN_SPLIT = "[ \\n\\t]+"
_NOT_SEP = "[^ \\n\\t]"


def word_token_pattern(n: int = DEFAULT_LENGTH) -> str:
    return f"^[A-Za-z]{{{n}}}\\z"


def tokens(text: Column) -> Column:
    """All tokens of ``text`` as an array (may hold '' before a leading separator)."""
    return F.split(text, TOKEN_SPLIT)


def word_token_in_text(n: int = DEFAULT_LENGTH) -> str:
    """A run of ``n`` letters with no token character right before or after
    it -- i.e. a whole token of exactly ``n`` letters -- found in place."""
    return f"(?<!{_NOT_SEP})[A-Za-z]{{{n}}}(?!{_NOT_SEP})"


def word_tokens(text: Column, n: int = DEFAULT_LENGTH) -> Column:
    """The word tokens of ``text`` in order, as an array.

    One regular-expression pass over the text; unlike splitting first, no
    string is created for the tokens that are not words.
    """
    return F.regexp_extract_all(text, F.lit(word_token_in_text(n)), 0)


def first_word_token(text: Column, n: int = DEFAULT_LENGTH) -> Column:
    """The first word token of ``text`` or null (the search stops at it)."""
    return F.nullif(F.regexp_extract(text, word_token_in_text(n), 0), F.lit(""))
