"""Exact top-k inner products through a pivot-distance index.

Vectors are quantised to integers.  With M the largest norm, each vector
gets one more component sqrt(M^2 - |x|^2); distances in that space fall as
the inner product with a query rises, so the highest scores are the nearest
points and the triangle inequality holds.

Index: ``PIVOTS`` pivots are picked far apart from a bounded sample; every
vector is keyed by its nearest pivot and its distance to it.  A pivot's
distances are cut into annuli of equal width, ``ANNULI`` for about every
``RING_ROWS`` of its vectors; ``ANNULI`` neighbouring annuli lie together as
a ring, the unit that is dealt to tasks (a ring that holds more, as distances
crowd, is cut further into parts of that size by a hash).

Search, in three steps, each with exact integer scores:

1. the annuli next to the query, in order of their distance from it, until
   ``SEED_ROWS`` vectors are seen, around its nearest pivots: the k-th best
   score so far bounds the distance of whatever can still count (the radius);
2. the annuli that come within half the radius, which tightens it;
3. those between half the first radius and the tightened one.  The rest is
   never read: an annulus [low, high] around a pivot at distance d holds no
   vector nearer than d - high or low - d.

Queries are dealt out in blocks of about ``QUERY_ROWS``, so no task holds all
of them.  What was read is logged as a share of all (query, vector) pairs.

Equal vectors are indexed once, with the k + 1 smallest ids of the group
(no more can be among a query's best k); that cut happens before the
shuffle, so a hot vector doesn't gather.

Rows whose vector is null or holds null or non-finite components take no
part, nor do rows with a null id; columns but the id and the vector are not
read.  Rows equal in id and vector count once; rows that share an id but not
a vector are queries of their own under that id; a query's own id is never
its candidate.  An empty table, or no query, gives no rows.  Shorter vectors count as padded
with zeros.  Fewer candidates than k: all of them.  Ties go to the smaller
id.  Components are expected below 2^20 in size, which keeps scores in a
long.
"""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from wordstats.llm.common import table
from wordstats.operators.lookup import store

SCALE = 1024
K = 10
PIVOTS = 64
PIVOT_SAMPLE = 2048
RING_ROWS = 4096
#: Annuli in a ring.
ANNULI = 8
#: Vectors that a query sees before it has a radius.
SEED_ROWS = 256
QUERY_ROWS = 4096
#: Added to radii, so that rounding of distances never leaves out a ring.
SLACK = 1e-6

_LOG = logging.getLogger(__name__)


def quantised(vector: Column) -> Column:
    """floor(SCALE * component) of each component, or null if the vector takes no part."""
    v = vector.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(v.isNotNull() & ~bad, F.transform(v, lambda x: F.floor(x * F.lit(float(SCALE))).cast("long")))


def _matrix(vectors, width: int | None = None) -> np.ndarray:
    width = width or max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows: in floating point where every
    sum is below 2^53, else in 64-bit integers."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * width
    if largest < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def pick_pivots(sample: list[list[int]], count: int) -> np.ndarray:
    """Farthest-first pivots of a sample."""
    points = _matrix(sample).astype(np.float64)
    chosen = [0]
    gap = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(points)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def _distances(vectors: np.ndarray, lift: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of lifted vectors to the pivots (pivots carry their lift last)."""
    width = max(vectors.shape[1], pivots.shape[1] - 1)
    v = np.zeros((len(vectors), width + 1))
    v[:, :vectors.shape[1]] = vectors
    v[:, -1] = lift
    p = np.zeros((len(pivots), width + 1))
    p[:, :pivots.shape[1] - 1] = pivots[:, :-1]
    p[:, -1] = pivots[:, -1]
    square = (v ** 2).sum(axis=1)[:, None] + (p ** 2).sum(axis=1)[None, :] - 2 * v @ p.T
    return np.sqrt(np.maximum(square, 0))


def search(vectors: DataFrame, queries: Column, k: int = K, vec_id: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every row that
    ``queries`` (over the id) picks, against all rows."""
    spark = vectors.sparkSession
    rows = store(vectors.select(F.col(vec_id).cast("long").alias("id"), quantised(F.col(vector)).alias("v"))
                 .filter(F.col("id").isNotNull() & F.col("v").isNotNull()).dropDuplicates(["id", "v"]), "vectors")

    # Equal vectors once, with their k + 1 smallest ids; Spark applies the
    # rank limit before the shuffle too.
    group = Window.partitionBy("v").orderBy("id")
    distinct = (rows.withColumn("_n", F.row_number().over(group)).filter(F.col("_n") <= k + 1)
                .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    square = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x)
    distinct = store(distinct.withColumn("norm2", square), "groups")

    sample = [r["v"] for r in distinct.orderBy(F.xxhash64("v"), "v").limit(PIVOT_SAMPLE).select("v").collect()]
    result = "query_id long, rank int, vec_id long, score long"
    if not sample:
        return spark.createDataFrame([], result)
    top2 = float(distinct.agg(F.max("norm2")).first()[0])
    base = pick_pivots(sample, PIVOTS)
    lifted = np.column_stack([base, np.sqrt(np.maximum(top2 - (base ** 2).sum(axis=1), 0))])
    model = spark.sparkContext.broadcast(lifted)

    @F.pandas_udf("struct<pivot:int,d:double>")
    def nearest(v: pd.Series, norm2: pd.Series) -> pd.DataFrame:
        m = _matrix(v.tolist())
        d = _distances(m, np.sqrt(np.maximum(top2 - norm2.to_numpy(dtype=float), 0)), model.value)
        near = d.argmin(axis=1)
        return pd.DataFrame({"pivot": near.astype(np.int32), "d": d[np.arange(len(d)), near]})

    @F.pandas_udf("array<double>")
    def to_pivots(v: pd.Series) -> pd.Series:
        # A query's lift is 0: only its own components count against a pivot.
        d = _distances(_matrix(v.tolist()), np.zeros(len(v)), model.value)
        return pd.Series(list(d), dtype=object)

    keyed = store(distinct.withColumn("_key", nearest("v", "norm2"))
                  .select("v", "ids", "_key.pivot", "_key.d"), "keyed")
    # Annuli: equal cuts of a pivot's distances, ANNULI for every RING_ROWS vectors.
    sizes = store(keyed.groupBy("pivot").agg(F.count("*").alias("n"), F.min("d").alias("d0"), F.max("d").alias("d1")),
                  "sizes")
    cuts = F.ceil(F.col("n") / RING_ROWS) * ANNULI
    # One row per pivot: bounded by PIVOTS.
    bands = store(keyed.join(F.broadcast(sizes), "pivot")
                  .withColumn("cut", F.when(F.col("d1") > F.col("d0"), F.least(
                      F.floor((F.col("d") - F.col("d0")) / (F.col("d1") - F.col("d0")) * cuts),
                      cuts - 1)).otherwise(F.lit(0)).cast("long"))
                  .select("pivot", F.floor(F.col("cut") / ANNULI).alias("band"),
                          (F.col("cut") % ANNULI).cast("int").alias("annulus"), "d", "v", "ids"), "bands")
    # Near copies crowd at nearly one distance: no ring stays larger than the others.
    crowded = (bands.groupBy("pivot", "band").agg(F.count("*").alias("n")).filter(F.col("n") > 2 * RING_ROWS)
               .select("pivot", "band", F.ceil(F.col("n") / RING_ROWS).alias("parts")))
    part = F.coalesce(F.pmod(F.xxhash64("v"), F.col("parts")), F.lit(0))
    index = store(bands.join(crowded, ["pivot", "band"], "left")
                  .select("pivot", F.shiftleft("band", 31).bitwiseOR(part).alias("ring"), "annulus", "d", "v", "ids"),
                  "index")
    annuli = store(index.groupBy("pivot", "ring", "annulus")
                   .agg(F.min("d").alias("low"), F.max("d").alias("high"), F.count("*").alias("n")), "annuli")

    # Queries, numbered, with their distances to all pivots, in blocks.
    n_asked = rows.filter(queries).count()
    blocks = max(1, -(-n_asked // QUERY_ROWS))
    asked = store(rows.filter(queries).withColumns({
        "q": F.monotonically_increasing_id(), "to": to_pivots("v"), "norm2": square.cast("double"),
        "block": F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")}), "queries")
    by_pivot = asked.select("q", "block", "norm2", F.posexplode("to").alias("pivot", "qd"))
    gap = F.greatest(F.col("qd") - F.col("high"), F.col("low") - F.col("qd"), F.lit(0.0))
    all_vectors = distinct.count()

    def scan(chosen: DataFrame, name: str) -> DataFrame:
        """Each query's k best in every ring, over the chosen annuli (q,
        block, pivot, ring, annulus, n): (q, query_id, score, vec_id)."""
        seen = Observation(name)
        visits = (chosen.groupBy("q", "block", "pivot", "ring")
                  .agg(F.bit_or(F.expr("shiftleft(1, annulus)")).alias("mask"), F.sum("n").alias("n"))
                  .join(asked.select("q", "id", "v"), "q"))
        visits = store(visits.observe(seen, F.sum("n").alias("n")), name)
        _LOG.info("%s: %.3f of all (query, vector) pairs read", name,
                  (seen.get["n"] or 0) / max(1, n_asked * all_vectors))
        blocks_of = visits.select("pivot", "ring", "block").distinct()
        dealt = (index.join(blocks_of, ["pivot", "ring"])
                 .select(F.col("pivot").alias("of"), F.col("ring").alias("at"),
                         F.col("block").alias("part"), "annulus", "v", "ids"))

        def best(asked_part: pd.DataFrame, ring_part: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(asked_part) and len(ring_part):
                vectors_of = _matrix(ring_part["v"].tolist())
                bits = 1 << ring_part["annulus"].to_numpy()
                ids = np.empty(len(ring_part), dtype=object)
                ids[:] = ring_part["ids"].tolist()
                # Annuli that a query's ball touches lie side by side: few masks differ.
                for mask, same in asked_part.groupby("mask"):
                    inside = (bits & mask) != 0
                    m, its_ids = vectors_of[inside], ids[inside].tolist()
                    for at in range(0, len(same), 256):
                        part = same.iloc[at:at + 256]
                        scores = _scores(_matrix(part["v"].tolist()), m)
                        for q, own, row in zip(part["q"].tolist(), part["id"].tolist(), scores):
                            out += [(q, own, s, x) for s, x in _best_of(row, its_ids, own, k)]
            return pd.DataFrame(out, columns=["q", "query_id", "score", "vec_id"]).astype("int64")

        return (visits.groupBy("pivot", "ring", "block")
                .cogroup(dealt.groupBy("of", "at", "part"))
                .applyInPandas(best, "q long, query_id long, score long, vec_id long"))

    def radius_of(found: DataFrame) -> DataFrame:
        """(q, radius): beyond it nothing is better than the k-th best found;
        only queries with k found."""
        nth = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
        kth = (found.withColumn("_n", F.row_number().over(nth)).filter(F.col("_n") == k)
               .join(asked.select("q", "norm2"), "q"))
        square_of = F.col("norm2") + F.lit(top2) - 2 * F.col("score")
        return kth.select("q", (F.sqrt(F.greatest(square_of, F.lit(0.0))) * (1 + SLACK)
                                + SLACK * (1 + top2 ** 0.5)).alias("radius"))

    # 1. From the nearest pivots, as many as hold enough, the annuli next to the query.
    ahead = Window.partitionBy("q").rowsBetween(Window.unboundedPreceding, -1)
    enough = max(SEED_ROWS, 2 * k)
    home = (by_pivot.join(sizes.select("pivot", "n"), "pivot")
            .withColumn("_before", F.coalesce(F.sum("n").over(ahead.orderBy("qd", "pivot")), F.lit(0)))
            .filter(F.col("_before") < enough).drop("n", "_before"))
    close = ahead.orderBy("gap", F.abs(F.col("qd") - (F.col("low") + F.col("high")) / 2), "pivot", "ring", "annulus")
    first = (home.join(annuli, "pivot").withColumn("gap", gap)
             .withColumn("_before", F.coalesce(F.sum("n").over(close), F.lit(0)))
             .filter(F.col("_before") < enough))
    seed = store(radius_of(scan(first, "seed")), "radius")

    # 2. What comes within half of that radius (a query without one: everything).
    near = by_pivot.join(seed, "q", "left").join(annuli, "pivot").withColumn("gap", gap)
    inner = F.col("radius").isNull() | (F.col("gap") <= F.col("radius") / 2)
    inside = store(scan(near.filter(inner), "inner"), "found")

    # 3. The rest of the ball, as far as it still reaches.
    tight = radius_of(inside).withColumnRenamed("radius", "tight")
    beyond = (by_pivot.join(seed, "q").join(tight, "q", "left").join(annuli, "pivot").withColumn("gap", gap)
              .filter((F.col("gap") > F.col("radius") / 2)
                      & (F.col("gap") <= F.least("radius", "tight"))))
    ranked = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    return (inside.unionByName(scan(beyond, "outer"))
            .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _best_of(scores: np.ndarray, ids: list, own: int, k: int) -> list[tuple[int, int]]:
    """The k best (score, id) of a ring for one query, ties to the smaller id."""
    if len(scores) > k + 1:
        # the query's own vector may be among them: look at k + 1, and all that tie with the last
        limit = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
        chosen = np.nonzero(scores >= limit)[0]
    else:
        chosen = np.arange(len(scores))
    pairs = [(-int(scores[c]), int(x)) for c in chosen for x in ids[c] if x != own]
    pairs.sort()
    return [(-s, x) for s, x in pairs[:k]]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: the ten best of every hundredth vector."""
    return search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


ORACLE = f"""
WITH kept AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM kept a JOIN kept b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored
QUALIFY rank <= {K}
"""
