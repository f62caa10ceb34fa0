import hashlib
import math

import duckdb
import numpy as np

from wordstats.llm import clustering

from llm_tables import SF_MID  # noqa: F401


def brute(rows, clusters, rounds, dims, scale, seed):
    """(vec_id, cluster, distance) of the kept rows and the centroids, in plain Python."""
    kept = [(i, [math.floor(scale * float(np.float64(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    draw = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in draw[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for c, vs in groups.items():
            centroids[c] = [sum(col) // len(vs) for col in zip(*vs)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept], centroids


def key(r):
    return tuple((x is None, x or 0) for x in r)


def test_query_equals_sql_and_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_MID}/embeddings.parquet')")
    got = clustering.query(spark, SF_MID)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({clustering.ORACLE})").fetchall()
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == sorted(want)
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()]
    plain, _ = brute(table, 16, 3, 64, 64, 1)
    assert sorted(plain) == [r[:3] for r in rows]


def awkward_rows():
    nan, inf = float("nan"), float("inf")
    rows = [(i, [math.sin(i), math.cos(i * i), i / 40, -i / 7, 0.25]) for i in range(60)]
    rows += [(100 + i, [0.5, 0.5, 0.5, 0.5, 0.5]) for i in range(60)]            # a hot vector
    rows += [(7, [9.0, 9.0, 9.0, 9.0, 9.0]), (7, [9.0, 9.0, 9.0, 9.0, 9.0]), (8, [1.0, 2.0, 3.0, 4.0, 5.0])]
    rows += [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0]), (202, [nan, 0.0, 0.0, 0.0, 0.0]),
             (203, [inf, 0.0, 0.0, 0.0, 0.0]), (204, []), (205, [1.0]), (None, [1.0, 1.0, 1.0, 1.0, -1.0]),
             (None, [-1e4, 1e4, 1.0, 1.0, 1.0]), (1 << 60, [0.0, 0.0, 0.0, 0.0, 0.0])]
    return rows


def test_awkward_vectors(spark, monkeypatch):
    monkeypatch.setattr("wordstats.llm.matrices.CHUNK_ROWS", 16)
    rows = awkward_rows()
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                               "vec_id long, embedding array<double>, cluster int, chunk string").repartition(3)
    for clusters, columns in ((1, 5), (4, 2), (16, 1), (500, 3)):
        got, centroids = clustering.lloyd(df, clusters, 3, 5, 64, 1, columns=columns)
        want, want_centroids = brute(rows, clusters, 3, 5, 64, 1)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
        assert centroids.tolist() == want_centroids
    assert clustering.lloyd(df.limit(0), dims=5)[0].count() == 0
    assert clustering.lloyd(df, dims=6)[0].count() == 0         # no vector has six components


def test_one_result_for_any_partitioning(spark):
    df = spark.createDataFrame([(i, v) for i, v in awkward_rows()], "vec_id long, embedding array<double>")
    results = set()
    for parts in (1, 2, 5):
        got, centroids = clustering.lloyd(df.repartition(parts), 6, 2, 5)
        results.add((str(sorted(map(tuple, got.collect()), key=key)), str(centroids.tolist())))
    assert len(results) == 1
