"""The load where ids pass the old end of the calendar (2,870,000 days) and the year 9999."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tools.compare import duck
from wordstats.sources.corpus import LAST_DAY, date_text, day_name, puzzle_date

IDS = [*range(2_043_900, 2_044_100), *range(2_869_950, 2_870_050), *range(2_914_000, 2_914_060),
       *range(2_919_950, 2_920_001)]
NAMES = ["ingest_labels", "ingest_counts", "ingest_counts_accept_late", "ingest_incremental",
         "ingest_bad_documents", "stream_ingest", "stream_counts", "stage_answers"]


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("large"))
    words = ["cigar", "rebut", "sissy", "humph", "no"]
    docs = [(i, f"x {words[i % 5]} y", "en", "s", 9) for i in IDS]
    (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
     .coalesce(1).write.parquet(f"{base}/parts/documents"))
    (spark.createDataFrame([(i, 1, 0) for i in IDS[::3]], "doc_id long, quality int, toxic int")
     .coalesce(1).write.parquet(f"{base}/parts/labels"))
    import glob
    import os
    for t in ("documents", "labels"):
        os.symlink(glob.glob(f"{base}/parts/{t}/*.parquet")[0], f"{base}/{t}.parquet")
    return base


@pytest.mark.parametrize("name", NAMES)
def test_increment_on_both_sides_of_the_limit(spark, large, name):
    # dates as text: those after the year 9999 are none in Python
    def as_text(c, t):
        return date_text(F.col(c)).alias(c) if t == "date" else F.col(c)

    got = entry.queries()[name](spark, large)
    got = got.select(*[as_text(c, t) for c, t in sorted(got.dtypes)]).collect()
    con = duck(large)
    sql = entry.oracle_sql()[name]
    types = sorted((d[0], str(d[1])) for d in con.execute(sql).description)
    cols = ", ".join(f"CAST({c} AS VARCHAR)" if t == "DATE" else c for c, t in types)
    want = con.execute(f"SELECT {cols} FROM ({sql})").fetchall()
    assert len(want) > 0 and sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_dates_keep_the_order_of_ids_to_the_end_of_dates(spark):
    ids = [0, 1, 2_869_999, 2_870_000, 2_870_001, 3_000_000, 200_000_000, LAST_DAY - 1, LAST_DAY]
    df = spark.createDataFrame([(i,) for i in ids], "id long").withColumn("d", puzzle_date(F.col("id")))
    rows = df.select("id", F.unix_date("d").alias("n"), date_text(F.col("d")).alias("t"),
                     (date_text(F.col("d")).cast("date") == F.col("d")).alias("back"),
                     day_name(F.col("d")).alias("name")).orderBy("id").collect()
    assert [r["n"] - 18_797 for r in rows] == ids and all(r["back"] for r in rows)
    assert (rows[0]["t"], rows[-1]["t"]) == ("2021-06-19", "5881580-07-10")
    week = ["Saturday", "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]
    assert [r["name"] for r in rows] == [week[i % 7] for i in ids]


def test_no_increment_where_dates_have_ended(spark, tmp_path):
    (spark.createDataFrame([(i, "cigar", "en", "s", 5) for i in (1, 3_000_000_000)],
                           "doc_id long, text string, lang string, source string, n_chars long")
     .write.parquet(f"{tmp_path}/documents.parquet"))
    (spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
     .write.parquet(f"{tmp_path}/labels.parquet"))
    with pytest.raises(Exception, match="no fetch window: dates end before id 3000000000"):
        entry.queries()["ingest_counts"](spark, str(tmp_path)).collect()
