import math

from pyspark.sql import functions as F

from wordstats.llm import topk

from llm_tables import SF_MID  # noqa: F401


def brute(rows, queries, k):
    out = set()
    for q, qv in queries:
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), x) for x, v in rows if x != q)[:k]
        out |= {(q, i + 1, x, -s) for i, (s, x) in enumerate(scored)}
    return out


def vectors(rows):
    return [(i, [math.floor(topk.SCALE * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]


def test_query_equals_brute_force(spark):
    rows = vectors([(r.vec_id, r.embedding) for r in
                    spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()])
    got = topk.query(spark, SF_MID).collect()
    assert len({(r.query_id, r["rank"]) for r in got}) == len(got)
    assert {tuple(r) for r in got} == brute(rows, [r for r in rows if r[0] % 100 == 0], 10)


def test_awkward_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "RING_ROWS", 4)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [math.sin(i), math.cos(i * i), i / 40]) for i in range(40)]
    rows += [(100 + i, [0.5, 0.5, 0.5]) for i in range(30)]           # a hot vector
    rows += [(40, None), (41, [1.0, None, 1.0]), (42, [nan, 0.0, 0.0]), (43, [inf, 0.0, 0.0]),
             (44, []), (45, [1.0]), (46, [0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (47, [-3.0, 0.1, 9.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    doubled = df.union(df.filter("vec_id = 5"))
    kept = vectors(rows)
    for k in (1, 10, 200):
        got = {tuple(r) for r in topk.search(doubled, F.col("id") % 10 == 0, k).collect()}
        wide = [(i, v + [0] * (3 - len(v))) for i, v in kept]
        assert got == brute(wide, [r for r in wide if r[0] % 10 == 0], k)
    assert topk.search(df.limit(0), F.col("id") % 10 == 0).count() == 0
    assert topk.search(df, F.col("id") < 0).count() == 0


def test_crowded_ring_is_cut(spark, monkeypatch):
    monkeypatch.setattr(topk, "RING_ROWS", 8)
    # 300 vectors close to each other, a few far away: nearly all fall into one band
    rows = [(i, [0.5 + (i % 17) / 1024, 0.5 + i // 17 / 1024, 0.25]) for i in range(300)]
    rows += [(300 + i, [float(i), -float(i), 3.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in topk.search(df, F.col("id") % 25 == 0, 10).collect()}
    kept = vectors(rows)
    assert got == brute(kept, [r for r in kept if r[0] % 25 == 0], 10)


def test_far_annuli_are_not_read(spark, monkeypatch, caplog):
    """Well-separated groups: a query reads a small part of the vectors, and still the right ones."""
    monkeypatch.setattr(topk, "PIVOTS", 8)
    monkeypatch.setattr(topk, "SEED_ROWS", 16)
    rows = [(i, [20.0 * math.cos(i % 8) + (i * 7 % 31) / 50, 20.0 * math.sin(i % 8) + (i * 11 % 37) / 50])
            for i in range(800)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with caplog.at_level("INFO", logger="wordstats.llm.topk"):
        got = {tuple(r) for r in topk.search(df, F.col("id") % 50 == 0, 5).collect()}
    kept = vectors(rows)
    assert got == brute(kept, [r for r in kept if r[0] % 50 == 0], 5)
    shares = [float(r.getMessage().split()[1]) for r in caplog.records if r.name == "wordstats.llm.topk"]
    assert len(shares) == 3 and sum(shares) < 0.5, shares


def test_one_id_with_two_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [2.0, 0.0]), (2, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.search(df, F.col("id") == 0, 1).collect())
    assert got == [(0, 1, 1, 2 * 1024 ** 2), (0, 1, 2, 2 * 1024 ** 2)]
