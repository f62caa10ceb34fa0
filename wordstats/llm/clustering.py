"""Centroid clustering: Lloyd's rounds with the dimensions cut into shards.

Vectors become integers, and the matrix of vectors is cut both ways: into
chunks of rows and into blocks of ``BLOCK_COLUMNS`` columns.  A centroid is
cut into slices alike.  One round:

1. a column-block task takes one block of one chunk and the centroids'
   slices of that block, and computes the exact partial squared distances of
   its rows to every centroid;
2. the blocks' partial distances are added by chunk (the shuffle key), and
   each row takes the centroid of the smallest sum, ties to the smaller
   number;
3. the assignments go back to the blocks, whose tasks sum their columns per
   centroid; every shard's sums make its new slices, componentwise
   floor(sum / count).  A centroid without vectors keeps its place.

No task sees more than one chunk's block, or one chunk's partial distances;
per round the driver gets centroids only (their number times the
components).  Chunks are of equal size whatever the vectors, so copies of one
vector don't gather.

Vectors that are null, hold null or non-finite components or have another
number of components than ``dims`` take no part.  Rows are told apart by
their place, not their id: repeated rows each count, and rows with a null id
take part, last in the order of the first centroids (ties there: the smaller
vector).  Fewer vectors than centroids: that many centroids.  No vectors: no
rows.  Other columns are not read.  A component beyond 2**27 after scaling
fails with a message, as distances would not fit their type.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordstats.llm.common import bound_batches, table
from wordstats.llm.matrices import chunks, finite, pack_ints, quantise, unpack_ints
from wordstats.operators.lookup import store

DIMS = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
SEED = 1
#: Columns of a shard.
BLOCK_COLUMNS = 32

RESULT = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
          "centroid_sha256 string")


def first_centroids(kept: DataFrame, clusters: int, seed: int, vec_id: str, vector: str) -> np.ndarray:
    """The vectors of the smallest sha256 of ``<seed>:<id>``, in that order:
    at most ``clusters`` rows reach the driver."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(vec_id).cast("string")), 256)
    rows = (kept.select(draw.alias("_h"), F.col(vector).cast("array<double>").alias("_v"))
            .orderBy(F.col("_h").asc_nulls_last(), "_v").limit(clusters).collect())
    return np.array([r["_v"] for r in rows], dtype=np.float64)


def squared_distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to integer centroids: in
    floating point where every sum stays below 2**53, else in 64-bit integers."""
    largest = max(int(np.abs(rows).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    exact = np.float64 if 4 * largest * largest * max(rows.shape[1], 1) < 1 << 53 else np.int64
    a, b = rows.astype(exact), centroids.astype(exact)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)


def assign(records: DataFrame, slices: Broadcast) -> DataFrame:
    """(chunk, clusters, distances): every row's nearest centroid."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples():
                d = squared_distances(unpack_ints(r.kind, r.data, r.rows), slices.value[r.block])
                out.append((r.chunk, r.rows, *pack_ints(d)))
            yield pd.DataFrame(out, columns=["chunk", "rows", "kind", "partial"])

    def nearest(blocks: pd.DataFrame) -> pd.DataFrame:
        total = sum(unpack_ints(r.kind, r.partial, r.rows) for r in blocks.itertuples())
        best = total.argmin(axis=1)     # the first of equal ones: ties to the smaller number
        return pd.DataFrame({"chunk": [blocks["chunk"].iloc[0]], "clusters": [best.astype(np.int32)],
                             "distances": [total[np.arange(len(best)), best]]})

    partials = (records.select("chunk", "block", "rows", "kind", "data")
                .mapInPandas(partial, "chunk long, rows int, kind string, partial binary"))
    return partials.groupBy("chunk").applyInPandas(
        nearest, "chunk long, clusters array<int>, distances array<long>")


def updated(records: DataFrame, assigned: DataFrame, slices: list[np.ndarray]) -> list[np.ndarray]:
    """The centroids' new slices.  A task sends one row per block and cluster
    it has seen, however many vectors it read."""
    width = max(s.shape[1] for s in slices)
    k = len(slices[0])

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for r in batch.itertuples():
                total, count = held.setdefault(r.block, (np.zeros((k, width), np.int64), np.zeros(k, np.int64)))
                rows = unpack_ints(r.kind, r.data, r.rows)
                cluster = np.asarray(r.clusters)
                for c in np.unique(cluster):
                    total[c, :rows.shape[1]] += rows[cluster == c].sum(axis=0)
                count += np.bincount(cluster, minlength=k)
        yield pd.DataFrame([(b, c, int(n[c]), t[c]) for b, (t, n) in held.items() for c in np.nonzero(n)[0]],
                           columns=["block", "cluster", "n", "total"])

    parts = (records.select("chunk", "block", "rows", "kind", "data")
             .join(assigned.select("chunk", "clusters"), "chunk")
             .mapInPandas(sums, "block int, cluster int, n long, total array<long>"))
    of_shard = (parts.groupBy("block", "cluster")
                .agg(F.sum("n").alias("n"), *[F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(width)])
                .select("block", "cluster", F.array(*[
                    # floor(sum / count) in integers
                    F.expr(f"(t{i} - pmod(t{i}, n)) div n") for i in range(width)]).alias("slice")))
    new = [s.copy() for s in slices]
    for r in of_shard.collect():        # centroids only: clusters x blocks rows
        new[r["block"]][r["cluster"]] = r["slice"][:new[r["block"]].shape[1]]
    return new


def lloyd(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS,
          scale: float = SCALE, seed: int = SEED, vec_id: str = "vec_id", vector: str = "embedding",
          columns: int = BLOCK_COLUMNS) -> tuple[DataFrame, np.ndarray]:
    """(assignments, centroids): vec_id, cluster and squared distance of every
    vector that takes part, and the final centroids as integers."""
    spark = vectors.sparkSession
    bound_batches(spark)
    kept = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("_vector"))
            .filter((F.size("_vector") == dims) & finite(F.col("_vector"))))
    start = first_centroids(kept, clusters, seed, "vec_id", "_vector")
    if not len(start):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, dims), np.int64)
    centroids = quantise(start, scale)
    records = store(chunks(kept, "_vector", scale, dims, ["vec_id"], columns), "blocks")
    slices = [centroids[:, b:b + columns] for b in range(0, dims, columns)]
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(slices)
        slices = updated(records, assign(records, sent), slices)
    sent = spark.sparkContext.broadcast(slices)
    ids = records.filter(F.col("block") == 0).select("chunk", F.col("vec_id").alias("ids"))
    rows = (ids.join(assign(records, sent), "chunk")
            .select(F.inline(F.arrays_zip(F.col("ids").alias("vec_id"), F.col("clusters").alias("cluster"),
                                          F.col("distances").alias("distance")))))
    return store(rows.toDF("vec_id", "cluster", "distance"), "assigned"), np.hstack(slices)


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: every kept vector's cluster, with the clusters' inertia and digests."""
    assigned, centroids = lloyd(table(spark, sf_dir, "embeddings"))
    per_cluster = assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()
    rows = [(r["cluster"], r["inertia"], sum(x["inertia"] for x in per_cluster),
             centroid_digest(centroids[r["cluster"]])) for r in per_cluster]
    # One row per cluster: bounded by CLUSTERS.
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (assigned.join(F.broadcast(about), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def _oracle(rounds: int = ROUNDS, clusters: int = CLUSTERS, dims: int = DIMS) -> str:
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE len(embedding) = {dims}
    AND len([x for x in embedding if x IS NOT NULL AND isfinite(CAST(x AS DOUBLE))]) = {dims}),
cells AS MATERIALIZED (
  SELECT r, unnest(range(1, {dims + 1})) AS i, unnest(v) AS x FROM kept),
first AS (
  SELECT r, row_number() OVER (ORDER BY sha256('{SEED}:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS c FROM kept),
c0 AS MATERIALIZED (
  SELECT first.c, cells.i, cells.x FROM first JOIN cells USING (r) WHERE first.c < {clusters})"""]
    for n in range(rounds + 1):
        steps.append(f"""
d{n} AS (
  SELECT cells.r, c{n}.c, CAST(sum((cells.x - c{n}.x) * (cells.x - c{n}.x)) AS BIGINT) AS d
  FROM cells JOIN c{n} USING (i) GROUP BY cells.r, c{n}.c),
a{n} AS MATERIALIZED (
  SELECT r, c, d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, c) AS n FROM d{n}) WHERE n = 1)""")
        if n < rounds:
            steps.append(f"""
s{n} AS (
  SELECT a{n}.c, cells.i, CAST(sum(cells.x) AS BIGINT) AS s, count(*) AS n
  FROM cells JOIN a{n} USING (r) GROUP BY a{n}.c, cells.i),
c{n + 1} AS MATERIALIZED (
  SELECT c{n}.c, c{n}.i, coalesce((s - ((s % n) + n) % n) // n, c{n}.x) AS x
  FROM c{n} LEFT JOIN s{n} ON s{n}.c = c{n}.c AND s{n}.i = c{n}.i)""")
    last = rounds
    return "WITH" + ",".join(steps) + f""",
digests AS (
  SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{last} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{last} JOIN kept USING (r) JOIN digests USING (c)
"""


ORACLE = _oracle()
