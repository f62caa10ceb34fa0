import duckdb
from pyspark.sql import functions as F

from wordstats.llm import mixing

from llm_tables import AWKWARD, SF_MID, docs_of  # noqa: F401


def water_fill(sizes, weights, share, cap):
    """Targets by resharing the excess until nobody is above the cap."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, done = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in done]
        level = (total - sum(done.values())) / max(1, sum(w[s] for s in rest))
        over = [s for s in rest if level * w[s] > cap * sizes[s]]
        if not over:
            return done | {s: level * w[s] for s in rest}
        done |= {s: cap * sizes[s] for s in over}


def test_query_equals_sql_and_water_filling(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_MID}/documents.parquet')")
    cols = "doc_id, size, source_size, target, taken, source, copies"
    want = con.execute(f"SELECT {cols} FROM ({mixing.ORACLE}) ORDER BY 1").fetchall()
    got = mixing.query(spark, SF_MID).orderBy("doc_id").select(cols.split(", ")).collect()
    assert [tuple(r) for r in got] == want
    sizes = {r.source: r.source_size for r in got}
    targets = water_fill(sizes, mixing.WEIGHTS, mixing.SHARE, mixing.CAP)
    taken = {}
    for r in got:
        assert abs(r.target - targets[r.source]) < 1e-6 * (1 + r.target)
        assert r.taken <= 2 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    total = sum(targets.values())
    assert abs(sum(taken.values()) - total) < 0.05 * total


def test_mixture_rows(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").withColumn("copies", F.lit("clash"))
    copies = {r.doc_id: r.copies for r in mixing.query(spark, SF_MID).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {d: c for d, c in copies.items() if c}
    assert mixed.select(docs.columns).distinct().exceptAll(docs).count() == 0


def test_awkward_rows(spark, docs_of):
    rows = [(i, t, "en", None if i == 5 else f"s{(i or 0) % 3}") for i, t in AWKWARD]
    docs = docs_of(rows)
    sizes = {}
    for i, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    got = {r.source: (r.source_size, r.target) for r in
           mixing.source_rates(docs.select("source", mixing.n_words().alias("size"))).collect()}
    want = water_fill(sizes, mixing.WEIGHTS, mixing.SHARE, mixing.CAP)
    assert {s: n for s, (n, _) in got.items()} == sizes
    assert all(abs(got[s][1] - want[s]) < 1e-6 * (1 + want[s]) for s in want)
    first, again = (sorted(map(str, mixing.mix(docs).collect())) for _ in range(2))
    assert first == again
    assert mixing.mix(docs_of([])).count() == 0
    assert mixing.mix(docs_of([(1, None), (2, "")])).count() == 0


def test_third_of_a_source_without_ids(spark, docs_of):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"t{i} " * (1 + i % 40), "en", f"s{i % 2}")
            for i in range(6000)]
    docs = docs_of(rows)
    mixed = mixing.mix(docs.withColumn("_rate", F.lit(1)).withColumn("copies", F.lit(2))).drop("_rate", "copies")
    rates = {r.source: r.target for r in mixing.source_rates(
        docs.select("source", mixing.n_words().alias("size"))).collect()}
    taken = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(mixing.n_words()).alias("n")).collect()}
    for source, target in rates.items():
        assert abs(taken[source] - target) < 0.02 * target
