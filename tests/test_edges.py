import json

from pyspark.sql import functions as F

from conftest import RAW_SCHEMA
from wordstats.operators import reporting as R
from wordstats.operators.frequency import letter_frequency, position_frequency
from wordstats.operators.ingest import high_water_mark, label_batch
from wordstats.operators.quality import passes, quality_report
from wordstats.operators.staging import stage_answers
from wordstats.plans.model import model_from_staged
from wordstats.sources.pages import read_pages


def test_empty_table(spark):
    raw = spark.createDataFrame([], RAW_SCHEMA)
    staged = stage_answers(raw)
    assert high_water_mark(raw).first()["_hwm"] is None
    assert letter_frequency(staged).count() == 0
    assert position_frequency(staged).count() == 0
    m = model_from_staged(staged)
    assert m.letters.rows == 0
    cands = spark.createDataFrame([("crane",)], "word string")
    row = m.word_scores(cands).first()
    assert (row["total_score"], row["already_used"]) == (0.0, False)
    kpi = R.kpi_row(staged).first()
    assert kpi["total_puzzles"] == 0 and kpi["avg_difficulty"] is None
    assert R.difficulty_trend(staged).count() == 0
    rep = quality_report({"raw_answers": raw, "staged_answers": staged})
    assert rep.count() == 16 and passes(rep)


def test_page_rows_missing_fields(spark, tmp_path):
    page = {"page": 1, "has_more": False, "total": 3, "results": [
        {"answer": "cigar", "date": "2024-01-02"},                     # no id field
        {"game": 7, "answer": "rebut", "date": "not a date"},          # bad date
        {"game": 8, "answer": "sissy", "date": "2024-01-03", "difficulty": 4.5},
    ]}
    (tmp_path / "p1.json").write_text(json.dumps(page) + "\n")
    rows = read_pages(spark, str(tmp_path))
    assert [r["pos"] for r in rows.orderBy("pos").collect()] == [0, 1, 2]
    table = spark.createDataFrame([], "puzzle_number long, answer string, date date, "
                                      "day_name string, difficulty float")
    out = {r["pos"]: r["label"] for r in label_batch(rows, table).collect()}
    assert out == {0: "failed", 1: "failed", 2: "inserted"}
    ins = label_batch(rows, table).filter(F.col("label") == "inserted").first()
    assert (ins["_answer"], ins["difficulty"]) == ("SISSY", 4.5)


def test_large_page_lands_in_bounded_parts(spark, tmp_path):
    from wordstats.sources.pages import PART_ROWS, land_pages

    n = 2 * PART_ROWS + 500
    rows = spark.createDataFrame(
        [(3, i, 10_000 - i, "cigar", "2024-01-02", "x", None) for i in range(n)],
        "page long, pos long, game long, answer string, date string, day_name string, "
        "difficulty float")
    land_pages(rows, str(tmp_path / "landing"))
    docs = spark.read.json(str(tmp_path / "landing"))
    assert docs.count() == 3
    assert max(len(r["results"]) for r in docs.collect()) <= PART_ROWS
    back = read_pages(spark, str(tmp_path / "landing")).orderBy("pos").collect()
    assert [r["game"] for r in back] == [10_000 - i for i in range(n)]
