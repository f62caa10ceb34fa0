import random

import duckdb
from pyspark.sql import functions as F

from wordstats.functions.numeric import round_at
from wordstats.functions.text import first_word_token, word_tokens


def test_round_at_matches_duckdb_round(spark):
    rng = random.Random(7)
    values = [1.005, 0.285, 2.675, 0.5, 1.5, 2.5, 0.049999999999999996, 123.45675]
    values += [c * 100.0 / t for t in (7, 80_000, 400_000) for c in rng.sample(range(1, t), min(300, t - 1))]
    values += [rng.uniform(0, 100) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round_at(F.col("x"), 4)).collect()]
    want = [duckdb.execute("SELECT round(?::DOUBLE, 4)", [v]).fetchone()[0] for v in values]
    assert got == want


def test_round_at_two_places_near_ties(spark):
    df = spark.createDataFrame([(1.005,), (0.285,), (None,)], "x double")
    assert [r[0] for r in df.select(round_at(F.col("x"), 2)).collect()] == [1.0, 0.28, None]


def test_word_tokens_whole_tokens_only(spark):
    text = "abcde fghijk\tKLMNO\nxy12z pqrst, uvwxy\n"
    df = spark.createDataFrame([(text,), (None,), ("",)], "text string")
    rows = df.select(word_tokens(F.col("text")).alias("t"),
                     first_word_token(F.col("text")).alias("f")).collect()
    assert rows[0]["t"] == ["abcde", "KLMNO", "uvwxy"]
    assert rows[0]["f"] == "abcde"
    assert rows[1]["f"] is None and rows[2]["f"] is None
