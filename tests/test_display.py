import datetime as dt

import pytest

from conftest import RAW_SCHEMA
from wordstats.operators import display as V
from wordstats.operators import reporting as R
from wordstats.operators.staging import stage_answers


@pytest.fixture
def staged(spark):
    d = dt.date(2024, 1, 1)
    rows = [(i, w, d + dt.timedelta(days=i), "Monday", f)
            for i, (w, f) in enumerate([("CIGAR", 2.25), ("REBUT", 3.5), ("SISSY", None)] * 500)]
    return stage_answers(spark.createDataFrame(rows, RAW_SCHEMA))


def test_kpi_text(staged):
    row = V.kpi_display(R.kpi_row(staged)).first()
    assert row["total_puzzles"] == "1,500"
    assert row["latest_puzzle"] == "#1499"
    assert row["avg_difficulty"] == "2.88"      # (2.25 + 3.5) / 2 = 2.875
    assert row["avg_vowels"] == "1.7"


def test_display_names_and_bounded_pandas(spark, staged):
    recent = V.recent_answers_display(R.recent_answers(staged))
    assert recent.columns == ["Puzzle #", "Answer", "Date", "Day", "Difficulty", "Level",
                              "Vowels", "Unique Letters"]
    assert len(V.to_pandas_bounded(recent, 20)) == 20
    with pytest.raises(V.TooLarge):
        V.to_pandas_bounded(staged, 100)


def test_marts_as_tables(spark, staged, tmp_path):
    from wordstats.operators.frequency import letter_frequency

    from wordstats.plans.refresh import publish

    for i, rows in enumerate((staged.limit(0), staged)):      # the second run is published last
        letter_frequency(rows).write.parquet(str(tmp_path / f"run{i}/letter_frequency"))
        publish(spark, str(tmp_path), str(tmp_path / f"run{i}"))
    V.register_marts(spark, str(tmp_path), ["letter_frequency"])
    assert "letter_frequency" in V.list_tables(spark)
    assert spark.sql("SELECT count(*) FROM letter_frequency").first()[0] == 11


def test_bar_text(spark):
    lf = spark.createDataFrame([("E", 10, 12.34, 1)],
                               "letter string, total_count long, frequency_pct double, frequency_rank long")
    row = V.letter_bar_text(R.top_letters(lf)).first()
    assert row["bar_text"] == "█" * 24 + " 12.3%"


def test_heatmap_display_names(spark, staged):
    from wordstats.operators.frequency import position_frequency

    hm = V.heatmap_display(R.position_heatmap(position_frequency(staged)))
    assert hm.columns == ["letter", *[f"Position {p}" for p in range(1, 6)]]
    row = {r["letter"]: r for r in hm.collect()}["C"]
    assert (row["Position 1"], row["Position 2"]) == (33.3333, 0.0)   # CIGAR: 500 of 1,500
