import datetime as dt

from pyspark.sql import functions as F

from wordstats.operators.ingest import label_batch, label_counts
from wordstats.plans.load import insert_if_absent, read_table, write_rows
from wordstats.session import scratch_dir

BATCH = "page long, pos long, game long, answer string, date string, day_name string, difficulty float"
TABLE = "puzzle_number long, answer string, date date, day_name string, difficulty float"
D0 = dt.date(2024, 1, 10)


def table(spark, rows=()):
    return spark.createDataFrame(list(rows), TABLE)


def batch(spark, rows):
    return spark.createDataFrame(
        [(1, i, g, a, d, "x", None) for i, (g, a, d) in enumerate(rows)], BATCH)


def labels(df):
    return [r["label"] for r in df.orderBy("page", "pos").collect()]


def test_first_valid_row_wins_and_rules(spark):
    rows = [
        (1, "cigar", "2024-01-11"),   # inserted
        (1, "rebut", "2024-01-11"),   # skipped: duplicate in batch
        (2, None, "2024-01-12"),      # failed: null answer
        (2, "sissy", "2024-01-12"),   # inserted: first valid for id 2
        (None, "humph", "2024-01-13"),  # failed: no id
        (3, "awake", "bad-date"),     # failed: date does not parse
        (4, "blush", "2024-01-14"),   # inserted
        (4, None, "2024-01-14"),      # skipped: id already taken (id test first)
    ]
    out = label_batch(batch(spark, rows), table(spark))
    assert labels(out) == ["inserted", "skipped", "failed", "inserted", "failed", "failed",
                           "inserted", "skipped"]
    c = label_counts(out).first()
    assert (c["inserted"], c["skipped"], c["failed"]) == (3, 2, 3)
    ins = {r["_id"]: r["_answer"] for r in out.filter("label = 'inserted'").collect()}
    assert ins == {1: "CIGAR", 2: "SISSY", 4: "BLUSH"}


def test_late_rows_and_accept_late(spark):
    t = table(spark, [(10, "CIGAR", D0, "x", None)])
    rows = [(9, "rebut", "2024-01-09"), (10, "cigar", "2024-01-10"), (11, "sissy", "2024-01-11"),
            (12, "humph", "2024-01-30")]
    default = label_batch(batch(spark, rows), t, today="2024-01-20")
    assert [r["_id"] for r in default.orderBy("pos").collect()] == [11]
    late = label_batch(batch(spark, rows), t, today="2024-01-20", accept_late=True)
    assert labels(late) == ["inserted", "skipped", "inserted"]


def test_empty_table_is_full_load(spark):
    rows = [(1, "cigar", "2020-01-01"), (2, "rebut", "2030-01-01")]
    out = label_batch(batch(spark, rows), table(spark))
    assert labels(out) == ["inserted", "inserted"]


def test_repeated_load_inserts_nothing_and_replay_is_idempotent(spark):
    path = scratch_dir(spark, "test-table")
    write_rows(table(spark, [(1, "CIGAR", D0, "x", None)]), path, load_id=0)
    b = batch(spark, [(2, "rebut", "2024-01-11"), (3, "sissy", "2024-01-12")])
    first = insert_if_absent(spark, path, b, load_id=1).first()
    assert first["inserted"] == 2
    # replaying load 1 (e.g. a retried micro-batch) gives the same result
    again = insert_if_absent(spark, path, b, load_id=1).first()
    assert again["inserted"] == 2
    assert read_table(spark, path).count() == 3
    # the same batch as a new load adds nothing
    second = insert_if_absent(spark, path, b, load_id=2).first()
    assert (second["inserted"], second["skipped"]) == (0, 0)  # dates <= latest: not fetched
    late = insert_if_absent(spark, path, b, load_id=3, accept_late=True).first()
    assert (late["inserted"], late["skipped"]) == (0, 2)
    assert read_table(spark, path).count() == 3
    assert read_table(spark, path).agg(F.countDistinct("puzzle_number")).first()[0] == 3


def test_hot_id_holding_a_third_of_the_batch(spark):
    rows = []
    for i in range(3000):
        if i % 3 == 0:
            rows.append((1, 7, None if i < 600 else "cigar", "2024-01-11"))   # the hot id
        else:
            rows.append((1, 1000 + i, "rebut", "2024-01-12"))
    b = spark.createDataFrame([(p, i, g, a, d, "x", None) for i, (p, g, a, d) in enumerate(rows)],
                              BATCH)
    out = label_batch(b, table(spark))
    hot = out.filter("game = 7")
    assert hot.count() == 1000
    ins = hot.filter("label = 'inserted'").collect()
    assert len(ins) == 1 and ins[0]["pos"] == 600            # first valid arrival
    assert hot.filter("label = 'failed'").count() == 200       # invalid before it
    assert hot.filter("label = 'skipped'").count() == 799
    assert out.filter("game <> 7 AND label = 'inserted'").count() == 2000


def test_load_strips_all_whitespace(spark):
    out = label_batch(batch(spark, [(1, "\tcigar\n", "2024-01-11"), (2, " \r rebut  ", "2024-01-12")]),
                      table(spark)).orderBy("pos").collect()
    assert [r["_answer"] for r in out] == ["CIGAR", "REBUT"]


def test_rows_without_a_page_and_of_repeated_pages_are_stored_once(spark):
    rows = [(None, 0, 1), (None, 1, 1), (None, 2, 2), (1, 0, 7), (1, 0, 7), (1, 1 << 30, 8)]
    df = spark.createDataFrame([(p, i, g, f"w{g}", "2024-01-11", "x", None) for p, i, g in rows], BATCH)
    out = label_batch(df, table(spark))
    taken = sorted(r["_id"] for r in out.filter("label = 'inserted'").collect())
    assert taken == [1, 2, 7, 8]
    assert label_counts(out).first()["skipped"] == 2


def test_only_whole_dates_count(spark):
    rows = [(1, "cigar", "2024"), (2, "rebut", "2024-05"), (3, "sissy", "2024-05-01"), (4, "humph", "2024-5-1")]
    assert labels(label_batch(batch(spark, rows), table(spark))) == ["failed", "failed", "inserted", "failed"]


def test_full_load_has_no_today_limit(spark):
    rows = [(1, "cigar", "2020-01-01"), (2, "rebut", "2030-01-01")]
    out = label_batch(batch(spark, rows), table(spark), today="2024-06-01")
    assert labels(out) == ["inserted", "inserted"]


def test_broken_documents_are_counted(spark, tmp_path):
    from wordstats.sources.pages import read_pages

    good = '{"page": 1, "results": [{"game": 1, "answer": "cigar", "date": "2024-01-11"}]}'
    (tmp_path / "a.json").write_text(good + '\n{"page": 2, "results": [{"game": 2, "ans\n')
    counts = label_counts(label_batch(read_pages(spark, str(tmp_path)), table(spark))).first()
    assert (counts["inserted"], counts["failed"]) == (1, 1)
    (tmp_path / "pretty").mkdir()
    import json
    (tmp_path / "pretty/b.json").write_text(json.dumps(json.loads(good), indent=2))
    rows = read_pages(spark, str(tmp_path / "pretty"), multi_line=True).collect()
    assert [(r["game"], r["answer"]) for r in rows] == [(1, "cigar")]
    lost = label_counts(label_batch(read_pages(spark, str(tmp_path / "pretty")), table(spark))).first()
    assert lost["inserted"] == 0 and lost["failed"] > 0


def test_dates_of_large_ids(spark):
    from wordstats.sources.corpus import puzzle_date

    row = spark.range(1).select(puzzle_date(F.lit(3_000_000_000)).alias("d")).first()
    assert row["d"].year < 9999
