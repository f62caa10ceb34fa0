import datetime as dt
import re

from pyspark.sql import functions as F

from wordstats.operators.difficulty import difficulty_by_pattern
from wordstats.operators.frequency import letter_counts
from wordstats.operators.reporting import difficulty_trend
from wordstats.operators.staging import stage_answers
from wordstats.plans.incremental import (
    merged_difficulty_by_pattern,
    merged_letter_counts,
    new_loads,
    read_trend,
    update_counts,
    update_trend,
)
from wordstats.plans.load import read_table, write_rows
from wordstats.plans.refresh import RunConfig, read_mart, run
from wordstats.session import scratch_dir

TABLE = "puzzle_number long, answer string, date date, day_name string, difficulty float"
WORDS = ["CIGAR", "REBUT", "SISSY", "HUMPH", "AWAKE", "BLUSH", "FOCAL", "EVADE"]


def rows(spark, ids):
    return spark.createDataFrame(
        [(i, WORDS[i % 8], dt.date(2024, 1, 1) + dt.timedelta(days=i), "x",
          None if i % 4 == 0 else 1.0 + i % 37 / 10) for i in ids], TABLE)


def as_set(df):
    return {tuple(r) for r in df.select(*sorted(df.columns)).collect()}


def check(spark, path, state):
    raw = read_table(spark, path).drop("loaded_at", "load_id")
    staged = stage_answers(raw)
    assert as_set(merged_letter_counts(spark, state)) == as_set(letter_counts(staged))
    assert as_set(merged_difficulty_by_pattern(spark, state)) == as_set(difficulty_by_pattern(staged))


def check_trend(spark, path, state):
    raw = read_table(spark, path).drop("loaded_at", "load_id")
    assert as_set(read_trend(spark, state)) == as_set(difficulty_trend(stage_answers(raw)))


def test_counts_equal_a_rebuild_and_read_new_loads_only(spark):
    base = scratch_dir(spark, "inc")
    path, state = f"{base}/table", f"{base}/state"
    for load, ids in enumerate((range(0, 50), range(50, 60), range(100, 103))):
        write_rows(rows(spark, ids), path, load)
        missing, fresh = new_loads(spark, path, state)
        assert missing == [load] and fresh.count() == len(ids)
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*load_id#\d+L? = %d\)" % load, plan)
        assert update_counts(spark, path, state) == [load]
        check(spark, path, state)
    assert update_counts(spark, path, state) == []
    # an update that died before its marker doesn't count
    (merged_letter_counts(spark, state).write.parquet(f"{state}/letters/run=dead"))
    check(spark, path, state)


def test_trend_equals_a_rebuild(spark):
    base = scratch_dir(spark, "inc")
    path, state = f"{base}/table", f"{base}/state"
    loads = [range(100, 180), range(180, 260), [4, 8], range(260, 262), range(20, 60), range(262, 300)]
    lows = []
    for load, ids in enumerate(loads):      # a load without scores, and one with earlier keys
        write_rows(rows(spark, ids), path, load)
        lows.append(update_trend(spark, path, state, 30))
        check_trend(spark, path, state)
    assert lows == [101, 181, None, 261, 21, 262]
    assert update_trend(spark, path, state, 30) is None


def test_run_with_kept_counts_equals_a_full_run(spark):
    base = scratch_dir(spark, "inc")
    path = f"{base}/table"
    cands = spark.createDataFrame([(w,) for w in ("STARE", "CRANE", "CIGAR")], "word string")
    kept = RunConfig(table_path=path, marts_path=f"{base}/kept", state_path=f"{base}/state")
    full = RunConfig(table_path=path, marts_path=f"{base}/full")
    for load, ids in enumerate((range(0, 40), range(40, 45))):
        write_rows(rows(spark, ids), path, load)
        assert run(spark, kept, cands)["published"] and run(spark, full, cands)["published"]
        for mart in ("letter_frequency", "position_heatmap", "difficulty_by_pattern", "word_scores",
                     "answer_history", "top_predictions"):
            assert as_set(read_mart(spark, kept.marts_path, mart)) == as_set(read_mart(spark, full.marts_path, mart))
    first = read_mart(spark, full.marts_path, "answer_history", first=3)
    assert [r["puzzle_number"] for r in first.collect()] == [44, 43, 42]
    ordered = read_mart(spark, full.marts_path, "answer_history").select(F.col("puzzle_number")).collect()
    assert [r[0] for r in ordered] == list(range(44, -1, -1))
