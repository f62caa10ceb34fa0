import datetime as dt

from pyspark.sql import functions as F

from conftest import RAW_SCHEMA
from wordstats.operators import reporting as R
from wordstats.operators.staging import stage_answers


def test_trend_skips_unscored_rows(spark):
    d = dt.date(2024, 1, 1)
    rows = []
    for i in range(40):
        diff = None if i % 4 == 3 else float(1 + (i % 3))
        rows.append((i, "CIGAR", d + dt.timedelta(days=i), "x", diff))
    staged = stage_answers(spark.createDataFrame(rows, RAW_SCHEMA))
    trend = R.difficulty_trend(staged).orderBy("puzzle_number").collect()
    scored = [r[4] for r in rows if r[4] is not None]
    assert len(trend) == len(scored) == 30
    assert trend[-1]["rolling_avg"] == sum(scored) / 30
    assert trend[0]["rolling_avg"] == scored[0]


def test_vowel_labels_and_bars(spark):
    d = dt.date(2024, 1, 1)
    staged = stage_answers(spark.createDataFrame(
        [(0, "CRYPT", d, "x", None), (1, "CIGAR", d, "x", None), (2, "BLUSH", d, "x", None)],
        RAW_SCHEMA))
    labels = {r["vowel_count"]: r["label"] for r in R.vowel_distribution(staged).collect()}
    assert labels == {0: "0 vowels", 1: "1 vowel", 2: "2 vowels"}
    lf = spark.createDataFrame([("E", 10, 12.6, 1), ("A", 9, 60.0, 2)],
                               "letter string, total_count long, frequency_pct double, frequency_rank long")
    bars = {r["letter"]: r for r in R.top_letters(lf).collect()}
    assert (bars["E"]["bar_len"], bars["E"]["bar_width"]) == (25, 100)
    assert bars["A"]["bar_width"] == 100 and len(bars["A"]["bar"]) == 120


PRED_SCHEMA = ("rank long, word string, letter_1 string, letter_2 string, letter_3 string, "
               "letter_4 string, letter_5 string, total_score double, pos1_score double, "
               "pos2_score double, pos3_score double, pos4_score double, pos5_score double")


def test_prediction_bars_and_breakdown(spark):
    preds = spark.createDataFrame([
        (1, "CRANE", "C", "R", "A", "N", "E", 50.0, 10.0, 9.0, 11.0, 8.0, 12.0),
        (2, "SLATE", "S", "L", "A", "T", "E", 25.0, 5.0, 5.0, 5.0, 5.0, 5.0),
    ], PRED_SCHEMA)
    bars = {r["word"]: r["score_pct"] for r in R.prediction_bars(preds).collect()}
    assert bars == {"CRANE": 100.0, "SLATE": 50.0}
    rows = R.winner_breakdown(preds).orderBy("position").collect()
    assert [r["label"] for r in rows] == ["Pos 1 (C)", "Pos 2 (R)", "Pos 3 (A)", "Pos 4 (N)",
                                          "Pos 5 (E)"]
    assert [r["score"] for r in rows] == [10.0, 9.0, 11.0, 8.0, 12.0]
    zero = spark.createDataFrame([(1, "XXXXX", "X", "X", "X", "X", "X", 0.0, 0.0, 0.0, 0.0,
                                   0.0, 0.0)], PRED_SCHEMA)
    assert R.prediction_bars(zero).first()["score_pct"] == 0.0


def test_heatmap_fills_missing_cells_and_strongest_ties(spark):
    pf = spark.createDataFrame([(1, "A", 2, 50.0), (1, "B", 2, 50.0), (3, "C", 4, 100.0)],
                               "position int, letter string, position_count long, position_pct double")
    hm = {r["letter"]: r for r in R.position_heatmap(pf).collect()}
    assert (hm["A"]["position_1"], hm["A"]["position_3"], hm["C"]["position_3"]) == (50.0, 0.0, 100.0)
    best = {r["position"]: r["letter"] for r in R.strongest_letter(pf).collect()}
    assert best == {1: "A", 3: "C"}          # tie at position 1 -> alphabetical


def test_word_repeats_threshold(spark):
    d = dt.date(2024, 1, 1)
    rows = [(i, w, d + dt.timedelta(days=i), "x", None)
            for i, w in enumerate(["CIGAR"] * 3 + ["REBUT"] * 2 + ["SISSY"])]
    staged = stage_answers(spark.createDataFrame(rows, RAW_SCHEMA))
    assert {r["answer"]: r["times_used"] for r in R.word_repeats(staged, 1).collect()} == \
        {"CIGAR": 3, "REBUT": 2}
    assert [r["answer"] for r in R.word_repeats(staged, 2).collect()] == ["CIGAR"]
    assert R.answer_duplicates(staged).count() == 0
