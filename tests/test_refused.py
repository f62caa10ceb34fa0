import datetime as dt

import pytest
from pyspark.sql import functions as F

from wordstats.plans.load import (
    KeyTaken,
    begin_load,
    finish_load,
    insert_if_absent,
    read_refused,
    read_table,
    write_rows,
)
from wordstats.session import scratch_dir

BATCH = "page long, pos long, game long, answer string, date string, day_name string, difficulty float"
TABLE = "puzzle_number long, answer string, date date, day_name string, difficulty float"
D0 = dt.date(2024, 1, 10)

ROWS = [
    (1, "cigar", "2024-01-11"),
    (2, None, "2024-01-12"),
    (None, "humph", "2024-01-13"),
    (3, "awake", "2024-01"),
    (4, "blush", None),
    (None, None, "soon"),
    (1, None, "2024-01-11"),      # the id is taken: skipped, not refused
]
REASONS = {1: "no answer", 2: "no id", 3: "no whole date", 4: "no date", 5: "no id, no answer, no whole date"}


def batch(spark, rows):
    return spark.createDataFrame([(1, i, g, a, d, "x", None) for i, (g, a, d) in enumerate(rows)], BATCH)


def table(spark, rows):
    return spark.createDataFrame(rows, TABLE)


def reasons(df):
    return {r["pos"]: r["reason"] for r in df.collect()}


def test_refused_rows_keep_their_reasons(spark):
    base = scratch_dir(spark, "refused")
    assert read_refused(spark, f"{base}/q").count() == 0
    for _ in range(2):      # a replayed load replaces its own rows
        insert_if_absent(spark, f"{base}/t", batch(spark, ROWS), 0, quarantine_path=f"{base}/q")
        assert reasons(read_refused(spark, f"{base}/q")) == REASONS
    kept = {r["pos"]: r for r in read_refused(spark, f"{base}/q").collect()}
    assert (kept[3]["game"], kept[3]["answer"], kept[3]["date"], kept[3]["load_id"]) == (3, "awake", "2024-01", 0)


def test_refused_rows_of_a_load_that_is_not_committed(spark):
    base = scratch_dir(spark, "refused")
    load = begin_load(spark, f"{base}/t", batch(spark, ROWS))
    other = begin_load(spark, f"{base}/t", batch(spark, [(9, None, "2024-01-11")]))
    assert finish_load(spark, load, f"{base}/q")["failed"] == len(REASONS)
    assert reasons(read_refused(spark, f"{base}/q", f"{base}/t")) == REASONS
    finish_load(spark, other, f"{base}/q")
    assert read_refused(spark, f"{base}/q", f"{base}/t").count() == len(REASONS) + 1


@pytest.mark.parametrize("row, name", [((None, "CIGAR", D0, "x", None), "puzzle_number"),
                                       ((1, None, D0, "x", None), "answer"), ((1, "CIGAR", None, "x", None), "date")])
def test_nulls_are_not_written(spark, row, name):
    path = scratch_dir(spark, "nulls")
    with pytest.raises(Exception, match=f"{name} must not be null"):
        write_rows(table(spark, [(7, "REBUT", D0, "x", None), row]), path)
    assert read_table(spark, path).count() == 0


def test_ids_are_unique(spark):
    path = scratch_dir(spark, "keys")
    one, two = (1, "CIGAR", D0, "x", None), (2, "REBUT", D0, "x", None)
    with pytest.raises(KeyTaken, match=r"\[1\]"):
        write_rows(table(spark, [one, two, one]), path)
    write_rows(table(spark, [one, two]), path)
    write_rows(table(spark, [one]), path)       # replaces its own load
    with pytest.raises(KeyTaken):
        write_rows(table(spark, [one]), path, load_id=1)
    write_rows(table(spark, [two]), path, load_id=1)
    assert sorted(r[0] for r in read_table(spark, path).select(F.col("puzzle_number")).collect()) == [1, 2]
