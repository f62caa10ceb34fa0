import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from wordstats.plans.load import read_table, write_rows
from wordstats.session import scratch_dir
from wordstats.sources.corpus import load_fixture
from wordstats.sources.pages import land_pages
from wordstats.streaming.ingest import start_stream_load


def test_stream_restart_consumes_each_drop_once(spark):
    table, batch = load_fixture(spark, SF_SMALL)
    base = scratch_dir(spark, "stream-test")
    path = f"{base}/table"
    write_rows(table, path, load_id=0)
    stored = read_table(spark, path).count()
    pages = batch.drop("_today")
    land_pages(pages, f"{base}/landing/drop=0")

    def once():
        q = start_stream_load(spark, f"{base}/landing/*", path, f"{base}/ckpt",
                              counts_path=f"{base}/counts", today="2030-01-01")
        q.awaitTermination()

    once()
    after_first = read_table(spark, path)
    n1 = after_first.count()
    assert n1 > stored
    assert after_first.groupBy("puzzle_number").count().filter("count > 1").count() == 0
    once()   # restart with nothing new: the checkpoint says the drop was consumed
    assert read_table(spark, path).count() == n1
    counts = spark.read.parquet(f"{base}/counts")
    assert counts.agg(F.sum("inserted")).first()[0] == n1 - stored


def test_stream_numbers_loads_after_existing_ones(spark):
    from wordstats.plans.load import insert_if_absent

    table, batch = load_fixture(spark, SF_SMALL)
    base = scratch_dir(spark, "stream-ids")
    path = f"{base}/table"
    write_rows(table, path, load_id=0)
    pages = batch.drop("_today")
    # an earlier batch load (id 1) took the lower ids of the batch
    first_half = pages.filter(F.col("game") < F.lit(170))
    insert_if_absent(spark, path, first_half, load_id=1, today="2030-01-01")
    before = read_table(spark, path).filter("load_id = 1").count()
    land_pages(pages, f"{base}/landing/drop=0")
    q = start_stream_load(spark, f"{base}/landing/*", path, f"{base}/ckpt", today="2030-01-01")
    q.awaitTermination()
    ids = sorted(r[0] for r in read_table(spark, path).select("load_id").distinct().collect())
    assert ids[0] == 0 and 1 in ids and max(ids) >= 2
    assert read_table(spark, path).filter("load_id = 1").count() == before
    assert read_table(spark, path).groupBy("puzzle_number").count().filter("count > 1").count() == 0


def test_result_does_not_depend_on_the_micro_batches(spark, tmp_path):
    import json

    pages = {"a": [(3, "2024-01-03"), (4, "2024-01-04")], "b": [(1, "2024-01-01"), (2, "2024-01-02"), (5, "2024-01-04")]}
    landing = tmp_path / "landing"
    landing.mkdir()
    for i, (name, rows) in enumerate(pages.items()):
        f = landing / f"{name}.json"
        f.write_text(json.dumps({"page": i, "results": [
            {"game": g, "answer": f"w{g}", "date": d} for g, d in rows]}))
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    for per_batch in ("1", "10"):
        table = str(tmp_path / f"table{per_batch}")
        start_stream_load(spark, str(landing), table, str(tmp_path / f"check{per_batch}"),
                          today="2020-01-01", maxFilesPerTrigger=per_batch).awaitTermination()
        assert sorted(r[0] for r in read_table(spark, table).select("puzzle_number").collect()) == [1, 2, 3, 4, 5]


def test_landed_files_follow_the_rows_not_the_shuffle(spark, tmp_path, monkeypatch):
    from wordstats.sources import pages

    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    rows = spark.range(4000).select(
        F.floor(F.col("id") / 50).alias("page"), (F.col("id") % 50).alias("pos"), F.col("id").alias("game"),
        F.concat(F.lit("a"), F.col("id")).alias("answer"), F.lit("2024-01-02").alias("date"),
        F.lit(None).cast("string").alias("day_name"), F.lit(None).cast("float").alias("difficulty"))
    try:
        spark.conf.set(key, "false")        # as many parts as the shuffle has
        for size, files in ((500_000, 1), (1500, 3)):
            monkeypatch.setattr(pages, "FILE_ROWS", size)
            base = tmp_path / str(size)
            land_pages(rows, str(base / "landing"))
            assert len(list((base / "landing").glob("part-*"))) == files
            q = start_stream_load(spark, str(base / "landing"), str(base / "table"), str(base / "check"),
                                  maxFilesPerTrigger=1)
            q.awaitTermination()
            assert sum(p.numInputRows > 0 for p in q.recentProgress) == files
            assert [tuple(r) for r in read_table(spark, str(base / "table")).agg(
                F.count("*"), F.countDistinct("puzzle_number"), F.sum("puzzle_number")).collect()] \
                == [(4000, 4000, 3999 * 2000)]
    finally:
        spark.conf.set(key, before)
