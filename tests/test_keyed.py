import datetime as dt
import json

from wordstats.plans.load import read_table, write_rows
from wordstats.streaming.keyed import keyed_counts, start_keyed_load

FACTS = "puzzle_number long, answer string, date date, day_name string, difficulty float"


def land(folder, name, page, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps({"page": page, "results": [
        {"game": g, "answer": a, "date": d} for g, a, d in rows]}))


def run(spark, tmp_path, **options):
    query = start_keyed_load(spark, str(tmp_path / "landing"), str(tmp_path / "table"), str(tmp_path / "check"),
                             counts_path=str(tmp_path / "counts"), today="2024-12-31", **options)
    query.awaitTermination()
    return query


def stored(spark, tmp_path):
    return {r["puzzle_number"]: (r["answer"], r["load_id"]) for r in read_table(spark, str(tmp_path / "table")).collect()}


def counters(spark, tmp_path):
    return tuple(keyed_counts(spark, str(tmp_path / "counts")).first())


def test_ids_are_known_from_batch_to_batch(spark, tmp_path):
    write_rows(spark.createDataFrame([(1, "OLD", dt.date(2024, 1, 1), None, None)], FACTS), str(tmp_path / "table"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    landing = tmp_path / "landing"
    land(landing, "a", 1, [(1, "new", "2024-01-02"), (2, "two", "2024-01-02"), (2, "again", "2024-01-03"),
                           (None, "x", "2024-01-03"), (3, "late", "2024-01-01")])
    query = run(spark, tmp_path)
    assert "RocksDB" in str(query.recentProgress[0].stateOperators[0].customMetrics).replace("rocksdb", "RocksDB")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    assert stored(spark, tmp_path) == {1: ("OLD", 0), 2: ("TWO", 1)}
    assert counters(spark, tmp_path) == (1, 2, 1, 1)
    # a restart; what came before isn't read again
    land(landing, "b", 0, [(2, "third", "2024-01-04"), (4, "four", "2024-01-04"), (5, None, "2024-01-04")])
    run(spark, tmp_path)
    assert stored(spark, tmp_path) == {1: ("OLD", 0), 2: ("TWO", 1), 4: ("FOUR", 2)}
    assert counters(spark, tmp_path) == (2, 3, 2, 1)
    # an id whose first row was invalid, and nothing new beside it
    land(landing, "c", 0, [(5, "five", "2024-01-05"), (4, "four", "2024-01-05")])
    run(spark, tmp_path)
    assert stored(spark, tmp_path)[5] == ("FIVE", 3)
    assert counters(spark, tmp_path) == (3, 4, 2, 1)


def test_first_arrival_wins_in_one_batch_and_in_many(spark, tmp_path):
    for sub, options in (("one", {}), ("many", {"maxFilesPerTrigger": 1})):
        at = tmp_path / sub
        at.mkdir()
        hot = [(7, f"h{i}", "2024-03-01") for i in range(300)]      # most rows on one id
        land(at / "landing", "a", 1, [(8, "first", "2024-03-01"), *hot])
        land(at / "landing", "b", 2, [(8, "later", "2024-03-02"), (9, "nine", "2024-03-02"), *hot])
        run(spark, at, **options)
        found = {k: v for k, (v, _) in stored(spark, at).items()}
        if sub == "one":
            assert found == {7: "H0", 8: "FIRST", 9: "NINE"}
        else:       # files of one time come in no given order
            assert found.keys() == {7, 8, 9} and found[7] == "H0"
        assert counters(spark, at) == (3, 600, 0, 0)


def test_a_replayed_batch_stores_the_same(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a", 1, [(1, "one", "2024-01-01")])
    run(spark, tmp_path)
    land(landing, "b", 2, [(1, "more", "2024-01-02"), (2, "two", "2024-01-02")])
    run(spark, tmp_path)
    before = stored(spark, tmp_path)
    for name in ("1", ".1.crc"):        # as if the driver died before the commit was written
        (tmp_path / "check" / "commits" / name).unlink(missing_ok=True)
    run(spark, tmp_path)
    assert stored(spark, tmp_path) == before == {1: ("ONE", 0), 2: ("TWO", 1)}
    assert counters(spark, tmp_path) == (2, 1, 0, 0)


def test_empty_landing(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    run(spark, tmp_path)
    assert stored(spark, tmp_path) == {}


def test_state_partitions_follow_the_cores_not_the_shuffle(spark, tmp_path):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    partitions = lambda query: query.recentProgress[0].stateOperators[0].numShufflePartitions
    try:
        spark.conf.set(key, "40")
        for sub, options, expected in (("own", {}, 8), ("given", {"state_partitions": 3}, 3)):
            at = tmp_path / sub
            at.mkdir()
            land(at / "landing", "a", 1, [(i, f"a{i}", "2024-01-02") for i in range(50)])
            assert partitions(run(spark, at, **options)) == expected
            assert spark.conf.get(key) == "40"
            # a restart keeps what the checkpoint began with, and what it knows
            land(at / "landing", "b", 2, [(i, "again", "2024-01-03") for i in range(60)])
            spark.conf.set(key, "2")
            assert partitions(run(spark, at)) == expected
            spark.conf.set(key, "40")
            assert stored(spark, at) == ({i: (f"A{i}", 0) for i in range(50)} | {i: ("AGAIN", 1) for i in range(50, 60)})
    finally:
        spark.conf.set(key, before)
