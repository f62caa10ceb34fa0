import re

import pytest
from pyspark.sql import functions as F

from wordstats.plans.ordered import read_ordered, write_ordered
from wordstats.session import scratch_dir


def folders(df):
    return {re.search(r"_part=(\d+)", f)[1] for f in df.inputFiles()}


@pytest.mark.parametrize("keys", [["-k"], ["k", "w"], ["-w", "k"]])
def test_positions_and_first_rows(spark, keys):
    rows = [(i * 7 % 1000, f"w{i % 13}") for i in range(1000)] + [(None, "a"), (5, None)]
    path = f"{scratch_dir(spark, 'ordered')}/t"
    write_ordered(spark.createDataFrame(rows, "k long, w string").repartition(5), path, keys, parts=8)

    def rank(r):
        out = []
        for k in keys:
            v = r["kw".index(k.lstrip("-"))]
            if k.startswith("-") and v is not None:
                v = -v if isinstance(v, int) else tuple(-ord(c) for c in v)
            out.append((v is None, v if v is not None else 0))
        return out

    def sort_key(r):
        return [(n, v if not isinstance(v, tuple) else v + (1,)) for n, v in rank(r)]

    want = sorted(rows, key=sort_key)
    got = [tuple(r)[:2] for r in read_ordered(spark, path, position="at").orderBy("at").collect()]
    assert [sort_key(r) for r in got] == [sort_key(r) for r in want] and sorted(map(str, got)) == sorted(map(str, want))
    everything = read_ordered(spark, path, position="at")
    assert [r["at"] for r in everything.orderBy("at").collect()] == list(range(1, len(rows) + 1))
    first = read_ordered(spark, path, first=20, position="at")
    assert [tuple(r)[:2] for r in first.orderBy("at").collect()] == got[:20]


def test_first_rows_read_one_folder(spark):
    path = f"{scratch_dir(spark, 'ordered')}/t"
    write_ordered(spark.range(100_000).withColumn("x", F.rand(1)), path, ["-id"], parts=8)
    first = read_ordered(spark, path, first=20)
    assert {r.id for r in first.collect()} == set(range(99_980, 100_000))
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_part", plan)
    assert len(folders(spark.read.parquet(f"{path}/rows"))) > 4
    index = spark.read.parquet(f"{path}/index").filter("first < 20")
    assert index.count() == 1


def test_empty(spark):
    path = f"{scratch_dir(spark, 'ordered')}/t"
    write_ordered(spark.range(0), path, ["id"])
    assert spark.read.parquet(f"{path}/index").count() == 0
