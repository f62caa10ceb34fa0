from pyspark.sql import functions as F

from test_ingest import BATCH
from wordstats.operators.ingest import label_batch, label_counts, ALL_LABELS
from wordstats.plans import commits
from wordstats.plans.load import _write, begin_load, finish_load, read_table
from wordstats.session import scratch_dir
from wordstats.sources.pages import read_pages


def batch(spark, ids, answer):
    return spark.createDataFrame([(1, n, i, answer, "2024-01-11", "x", None) for n, i in enumerate(ids)], BATCH)


def stored(spark, path):
    return {r.puzzle_number: (r.answer, r.load_id) for r in read_table(spark, path).collect()}


def test_two_loads_interleave_and_no_row_is_lost(spark):
    path = scratch_dir(spark, "commits")
    first = begin_load(spark, path, batch(spark, range(0, 6), "first"))
    second = begin_load(spark, path, batch(spark, range(4, 10), "secon"))
    assert first.load_id != second.load_id
    assert finish_load(spark, second)["inserted"] == 6
    assert set(stored(spark, path)) == set(range(4, 10))        # the first isn't committed yet
    counts = finish_load(spark, first)
    assert (counts["inserted"], counts["skipped"]) == (4, 2)
    rows = stored(spark, path)
    assert set(rows) == set(range(10)) and read_table(spark, path).count() == 10
    assert rows[3] == ("FIRST", first.load_id) and rows[4] == ("SECON", second.load_id)


def test_contested_load_that_keeps_nothing(spark):
    path = scratch_dir(spark, "commits")
    loads = [begin_load(spark, path, batch(spark, range(3), w)) for w in ("aaaaa", "bbbbb", "ccccc")]
    counts = [finish_load(spark, x) for x in loads]
    assert [c["inserted"] for c in counts] == [3, 0, 0] and [c["skipped"] for c in counts] == [0, 3, 3]
    assert {a for a, _ in stored(spark, path).values()} == {"AAAAA"}
    assert commits.committed(spark, path) == [x.load_id for x in loads]


def test_dead_load_is_not_read_and_not_in_the_way(spark):
    path = scratch_dir(spark, "commits")
    finish_load(spark, begin_load(spark, path, batch(spark, [1], "alpha")))
    dead = begin_load(spark, path, batch(spark, [2], "wrong"), accept_late=True)
    _write(dead.rows, path, dead.load_id)
    assert commits.pending(spark, path) == [dead.load_id]
    counts = finish_load(spark, begin_load(spark, path, batch(spark, [2, 3], "right"), accept_late=True))
    assert counts["inserted"] == 2
    assert {k: a for k, (a, _) in stored(spark, path).items()} == {1: "ALPHA", 2: "RIGHT", 3: "RIGHT"}


def test_a_file_is_created_once(spark):
    path = f"{scratch_dir(spark, 'commits')}/one"
    assert commits.create_once(spark, path, "x") and not commits.create_once(spark, path, "y")


def test_earlier_file_wins_whatever_the_sizes(spark):
    base = scratch_dir(spark, "order")
    docs = [(0, [(1, "first")]), (1, [(1, "secon")] + [(i, "other") for i in range(2, 400)])]
    for n, rows in docs:
        results = ", ".join(f'{{"game": {i}, "answer": "{a}", "date": "2024-01-11"}}' for i, a in rows)
        spark.range(1).select(F.lit(f'{{"results": [{results}]}}').alias("value")).coalesce(1) \
            .write.text(f"{base}/pages/page-{n}")
    empty = read_table(spark, f"{base}/none").drop("loaded_at", "load_id")
    by_path = label_batch(read_pages(spark, f"{base}/pages/*"), empty)
    won = {r["_id"]: r["_answer"] for r in by_path.filter("label = 'inserted'").collect()}
    assert won[1] == "FIRST" and len(won) == 399
    # by time: the folder written again now is the later one
    again = ", ".join(['{"game": 1, "answer": "third", "date": "2024-01-11"}'])
    spark.range(1).select(F.lit(f'{{"results": [{again}]}}').alias("value")).coalesce(1) \
        .write.text(f"{base}/pages/page-00")
    rows = {a: label_batch(read_pages(spark, f"{base}/pages/*", arrival=a), empty)
            .filter("label = 'inserted' AND _id = 1").first()["_answer"] for a in ("path", "time")}
    assert rows == {"path": "FIRST", "time": "FIRST"}
    many = label_batch(read_pages(spark, f"{base}/pages/*").repartition(1), empty)
    assert many.count() == 401


def test_counters_add_up(spark):
    path = scratch_dir(spark, "counts")
    finish_load(spark, begin_load(spark, path, batch(spark, [1], "alpha")))
    rows = spark.createDataFrame([
        (1, 0, 2, "later", "2024-01-12", "x", None), (1, 1, 3, "early", "2024-01-01", "x", None),
        (1, 2, 4, "after", "2024-02-01", "x", None), (1, 3, 2, "again", "2024-01-12", "x", None),
        (1, 4, 5, None, "2024-01-12", "x", None), (1, 5, None, "noid!", "2024-01-12", "x", None),
        (1, 6, 6, "baddt", "someday", "x", None), (1, 7, None, "noid!", "2024-01-01", "x", None)], BATCH)
    counts = finish_load(spark, begin_load(spark, path, rows, today="2024-01-20"))
    assert counts == {"inserted": 1, "skipped": 1, "failed": 3, "outside": 3}
    table = read_table(spark, path).drop("loaded_at", "load_id").filter("puzzle_number = 1")
    plain = label_counts(label_batch(rows, table, today="2024-01-20", outside=True), ALL_LABELS)
    assert plain.first().asDict() == counts
