import datetime as dt

from conftest import RAW_SCHEMA
from wordstats.operators.frequency import letter_frequency
from wordstats.operators.staging import stage_answers
from wordstats.plans.model import model_from_staged
from wordstats.plans.refresh import write_mart
from wordstats.plans.tables import HISTORY_VIEW, drop_old_tables, mart_tables, publish_tables
from wordstats.session import scratch_dir


def staged(spark, words):
    d = dt.date(2024, 1, 1)
    return stage_answers(spark.createDataFrame(
        [(i, w, d + dt.timedelta(days=i), "Monday", 2.5) for i, w in enumerate(words)], RAW_SCHEMA))


def test_views_follow_the_published_run(spark):
    base, names = scratch_dir(spark, "tables"), ["letter_frequency", "answer_history"]
    for run, words in (("one", ["CIGAR"]), ("two", ["CIGAR", "REBUT", "SISSY"])):
        answers = staged(spark, words)
        write_mart(letter_frequency(answers), f"{base}/{run}", "letter_frequency")
        write_mart(model_from_staged(answers).answer_history(), f"{base}/{run}", "answer_history")
        publish_tables(spark, f"{base}/{run}", "test_marts", names)
        assert {tuple(r) for r in mart_tables(spark, "test_marts").collect()} == {
            ("letter_frequency", len(set("".join(words)))), ("answer_history", len(words))}
    history = spark.sql("SELECT * FROM test_marts.answer_history ORDER BY puzzle_number DESC")
    assert history.columns == HISTORY_VIEW
    assert [r["answer"] for r in history.collect()] == ["SISSY", "REBUT", "CIGAR"]
    assert drop_old_tables(spark, f"{base}/two", names, "test_marts") == [
        "answer_history_run_one", "letter_frequency_run_one"]
    assert spark.sql("SELECT count(*) FROM test_marts.letter_frequency").first()[0] == len(set("CIGARREBUTSISSY"))
    spark.sql("DROP DATABASE test_marts CASCADE")


def test_filters_use_the_statistics(spark):
    base = scratch_dir(spark, "tables")
    write_mart(letter_frequency(staged(spark, ["CIGAR", "REBUT"])), f"{base}/run", "letter_frequency")
    publish_tables(spark, f"{base}/run", "test_stats", ["letter_frequency"])
    described = spark.sql("DESCRIBE EXTENDED test_stats.letter_frequency_run_run letter").collect()
    assert {r["info_name"]: r["info_value"] for r in described}["num_nulls"] == "0"
    spark.sql("DROP DATABASE test_stats CASCADE")
