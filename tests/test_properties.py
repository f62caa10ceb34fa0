"""Property-style checks on random words and ratios."""

import datetime as dt
import string

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import RAW_SCHEMA
from wordstats.functions.numeric import pct_of
from wordstats.operators.frequency import letter_frequency, position_frequency
from wordstats.operators.staging import stage_answers

WORDS = st.lists(st.text(alphabet="ABCDEIOUY", min_size=5, max_size=5), min_size=1, max_size=40)


def expected_features(w):
    vowels = sum(ch in "AEIOU" for ch in w)
    once = sum(w.count(ch) == 1 for ch in w)
    return vowels, once


@settings(max_examples=15, deadline=None)
@given(WORDS)
def test_word_features_and_frequency_invariants(spark, words):
    d = dt.date(2024, 1, 1)
    rows = [(i, f" {w.lower()} ", d + dt.timedelta(days=i), "x", None) for i, w in enumerate(words)]
    staged = stage_answers(spark.createDataFrame(rows, RAW_SCHEMA))
    got = {r["puzzle_number"]: (r["vowel_count"], r["unique_letter_count"])
           for r in staged.collect()}
    assert got == {i: expected_features(w) for i, w in enumerate(words)}
    lf = {r["letter"]: r["total_count"] for r in letter_frequency(staged).collect()}
    assert lf == {ch: sum(w.count(ch) for w in words) for ch in set("".join(words))}
    pf = position_frequency(staged).collect()
    for p in range(1, 6):
        assert sum(r["position_count"] for r in pf if r["position"] == p) == len(words)
    assert 4 not in {v[1] for v in got.values()}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 500_000), st.integers(1, 500_000)),
                min_size=1, max_size=60))
def test_pct_matches_duckdb(spark, pairs):
    df = spark.createDataFrame(pairs, "c long, t long")
    got = [r[0] for r in df.select(pct_of(F.col("c"), F.col("t"))).collect()]
    want = [duckdb.execute("SELECT round(?::BIGINT * 100.0 / ?::BIGINT, 4)", [c, t]).fetchone()[0]
            for c, t in pairs]
    assert got == want
