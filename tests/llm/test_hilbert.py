import zlib

from pyspark.sql import functions as F

from wordstats.llm import hilbert

from llm_tables import AWKWARD, SF_MID, docs_of, mid_docs  # noqa: F401


def test_curve_visits_every_cell_by_single_steps(spark):
    for bits in (1, 2, 3):
        n = 2 ** bits
        cells = [(x, y, z, x, y, z) for x in range(n) for y in range(n) for z in range(n)]
        df = spark.createDataFrame(cells, "a long, b long, c long, x long, y long, z long")
        rows = hilbert.hilbert_index(df, ["a", "b", "c"], "h", bits).orderBy("h").collect()
        assert [r.h for r in rows] == list(range(n ** 3))
        for p, q in zip(rows, rows[1:]):
            assert abs(p.x - q.x) + abs(p.y - q.y) + abs(p.z - q.z) == 1


def check(rows, texts, law):
    counts, sizes, slots = [0] * 16, [0] * 16, {}
    for r in rows:
        counts[r.shard] += 1
        sizes[r.shard] += r["size"]
        slots.setdefault(r.shard, set()).add(r.slot)
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in rows if r.doc_id is not None) == sorted(
        (d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in texts if d is not None)
    for s, got in slots.items():
        assert got == set(range(counts[s]))
    if law == "rows":
        assert max(counts) - min(counts) <= 1
    else:
        assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in ordered] == sorted(r.curve for r in ordered)


def test_query(spark, mid_docs):
    rows = hilbert.query(spark, SF_MID).collect()
    check(rows, list(mid_docs.items()), "rows")
    assert {r.law for r in rows} == {"rows"}


def test_bytes_law_and_pruning(spark, mid_docs):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    placed = hilbert.shard(docs, law="bytes")
    check(placed.collect(), list(mid_docs.items()), "bytes")
    # shards hold few of the languages and sources each
    seen = placed.join(docs, "doc_id").groupBy("shard").agg(
        F.count_distinct("lang").alias("langs"), F.count_distinct("source").alias("sources")).collect()
    assert sum(r.langs for r in seen) / len(seen) < 3
    assert sum(r.sources for r in seen) / len(seen) < 14


def test_awkward_rows(spark, docs_of):
    rows = hilbert.shard(docs_of(AWKWARD).withColumn("curve", F.lit(1))).collect()
    check(rows, [(d, t or "") for d, t in AWKWARD], "rows")
    assert len(rows) == len(AWKWARD)
    nulls = docs_of([(i, "t", None, None) for i in range(40)]).withColumn("lang", F.lit(None).cast("string"))
    check(hilbert.shard(nulls).collect(), [(i, "t") for i in range(40)], "rows")
    assert hilbert.shard(docs_of([])).count() == 0


def test_written_shards(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    hilbert.write_shards(docs, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.select(docs.columns).exceptAll(docs).count() == 0 and back.count() == docs.count()


def test_a_shard_is_written_by_several_tasks(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    hilbert.write_shards(docs, str(tmp_path / "shards"))
    files = {p: len(list(p.glob("*.parquet"))) for p in (tmp_path / "shards").glob("shard=*")}
    assert len(files) == hilbert.SHARDS and min(files.values()) > 1
    # every file is in order of the slots
    slot = {r.doc_id: r.slot for r in hilbert.shard(docs).collect()}
    for f in (tmp_path / "shards").glob("shard=*/*.parquet"):
        slots = [slot[r.doc_id] for r in spark.read.parquet(str(f)).coalesce(1).collect()]
        assert slots == sorted(slots)
