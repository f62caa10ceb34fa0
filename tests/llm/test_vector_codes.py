import math

import duckdb
import numpy as np

from wordstats.llm import vector_codes
from wordstats.llm.matrices import pack_ints, unpack_ints

from llm_tables import SF_MID  # noqa: F401
from test_clustering import awkward_rows, key


def brute(rows, parts, entries, rounds, scale):
    kept = [(i, label, [math.floor(scale * x) for x in v]) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max(len(v) for _, _, v in kept) // parts)) * parts
    kept = [(i, label, v + [0] * (width - len(v))) for i, label, v in kept]
    w = width // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, _, v in kept]
    first = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, kept[n][0] or 0, kept[n][2]))[:entries]
    books = [[cut[n][p] for n in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(col) // len(groups[n]) for col in zip(*groups[n])] if n in groups else e
                        for n, e in enumerate(books[p])]
    out = []
    for (i, label, _), c in zip(kept, cut):
        found = [nearest(x, books[p]) for p, x in enumerate(c)]
        out.append((i, label, tuple(n for _, n in found), sum(d for d, _ in found)))
    return out, books


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_MID}/embeddings.parquet')")
    got = vector_codes.query(spark, SF_MID)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({vector_codes.ORACLE})").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_orchard_equals_brute_force():
    rng = np.random.default_rng(3)
    for n, m, w, spread in ((300, 256, 16, 1000), (200, 40, 3, 4), (50, 1, 2, 9), (100, 17, 1, 3), (64, 2, 5, 10**7)):
        entries = rng.integers(-spread, spread + 1, (m, w))
        entries[m // 2:] = entries[:m - m // 2]            # doubled entries: ties
        rows = np.concatenate([rng.integers(-spread, spread + 1, (n, w)), entries])
        at, dist, computed = vector_codes.orchard(rows, vector_codes.with_lists(entries))
        all_d = ((rows[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        assert (at == all_d.argmin(axis=1)).all() and (dist == all_d.min(axis=1)).all()
        assert computed <= len(rows) * m
    # close rows: most entries are never compared
    far = rng.integers(-10**6, 10**6, (256, 16))
    rows = far[rng.integers(0, 256, 500)] + rng.integers(-50, 50, (500, 16))
    _, _, computed = vector_codes.orchard(rows, vector_codes.with_lists(far))
    assert computed < 0.5 * 500 * 256


def test_awkward_vectors(spark, monkeypatch):
    monkeypatch.setattr("wordstats.llm.matrices.CHUNK_ROWS", 16)
    rows = [(i, v, None if n % 3 == 0 else n % 2) for n, (i, v) in enumerate(awkward_rows())]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "vec_id long, embedding array<double>, label int, code string, error int").repartition(3)
    for parts, entries in ((4, 256), (2, 8), (1, 1)):
        got, books = vector_codes.compress(df, parts, entries, 4)
        want, want_books = brute(rows, parts, entries, 4, 1024)
        found = [(r.vec_id, r.label, tuple(r.code), r.error) for r in got.collect()]
        assert sorted(map(str, found)) == sorted(map(str, want))
        assert [b.tolist() for b in books] == want_books
    assert vector_codes.compress(df.limit(0))[0].count() == 0
    only_empty = df.filter("vec_id = 204")
    assert [(r.vec_id, list(r.code), r.error) for r in vector_codes.compress(only_empty)[0].collect()] == [
        (204, [0, 0, 0, 0], 0)]


def test_integers_are_packed_in_the_smallest_type():
    for top, kind in ((3, "<i2"), (1 << 15, "<i4"), (1 << 31, "<i8")):
        m = np.array([[0, -top], [top, 1]])
        got, data = pack_ints(m)
        assert got == kind and (unpack_ints(got, data, 2) == m).all()
