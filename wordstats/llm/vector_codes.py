"""Vector code compression: product codes whose entries are found by Orchard
search.

Vectors become integers and are cut into ``PARTS`` equal consecutive parts.
Every part position has a codebook of up to ``ENTRIES`` integer entries,
which starts as that part of the smallest ids' vectors and is improved by
``ROUNDS`` rounds of assignment and componentwise floor(sum / count); an
entry that nobody uses stays.  A vector's code is its parts' nearest entries
(squared distance, ties to the lower index).

Orchard search finds the nearest entry without comparing all.  Every entry
has the list of the other entries by their distance to it.  A search starts
at the best of a few anchors and walks down the list of the entry it is at;
an entry that is better makes the search jump to that entry's list, from its
head; visited entries are marked and not compared again; and the walk ends
where the list goes beyond twice the current distance, as by the triangle
inequality whatever comes later is farther away than the entry it is at.
Entries at exactly twice the distance may tie, so they are still compared.
All is in exact integers (squares: four times the squared distance).  A
batch of vectors is searched together, ``STEP`` list places at a time.

Only codebooks reach the driver (``PARTS`` x ``ENTRIES`` entries, sent to the
tasks as one broadcast) and, per task and entry, one row of sums is shuffled;
vectors are stored once as integer matrices and stay where they are.  Copies
of one vector don't gather anywhere.

Rows whose vector is null or holds null or non-finite components take no
part.  Shorter vectors count as followed by zeros up to the longest one's
length, itself rounded up to a multiple of ``PARTS``.  Rows are told apart by
their place: repeated rows each count; null ids come last among the entries'
vectors, ties go to the smaller vector.  Fewer vectors than entries: that
many entries.  No vectors: no rows.  Null labels form one group.  Other
columns are not read.  A component beyond 2**27 after scaling fails with a
message, as errors would not fit their type.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordstats.llm.common import bound_batches, table
from wordstats.llm.matrices import chunks, finite, quantise, unpack_ints
from wordstats.operators.lookup import store

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: List places that a search looks at together, and entries it may start from.
STEP = 16
ANCHORS = 8

_NONE = np.iinfo(np.int64).max


@dataclass
class Codebook:
    """The entries of one part position and every entry's list of the others:
    ``order`` holds their indexes by distance, ``gaps`` the squared distances;
    lists are filled up with a place that no search reaches."""

    entries: np.ndarray
    order: np.ndarray
    gaps: np.ndarray


def with_lists(entries: np.ndarray) -> Codebook:
    n = len(entries)
    square = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    order = np.argsort(square, axis=1, kind="stable")
    order = order[order != np.arange(n)[:, None]].reshape(n, n - 1)
    gaps = np.take_along_axis(square, order, axis=1)
    fill = ((0, 0), (0, STEP))
    return Codebook(entries, np.pad(order, fill, constant_values=0), np.pad(gaps, fill, constant_values=_NONE))


def orchard(rows: np.ndarray, book: Codebook) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest entry, squared distance) of every row, ties to the lower
    index, and how many distances were computed."""
    entries = book.entries
    n, m = len(rows), len(entries)
    largest = max(int(np.abs(rows).max(initial=0)), int(np.abs(entries).max(initial=0)))
    exact = np.float64 if 4 * largest * largest * max(rows.shape[1], 1) < 1 << 53 else np.int64
    x, e = rows.astype(exact), entries.astype(exact)
    anchors = np.arange(0, m, max(1, m // ANCHORS))
    start = np.stack([((x - e[a]) ** 2).sum(axis=1) for a in anchors], axis=1)
    at = anchors[start.argmin(axis=1)]
    dist = start.min(axis=1).astype(np.int64)
    seen = np.zeros((n, m), dtype=bool)
    seen[:, anchors] = True
    computed = n * len(anchors)

    place = np.zeros(n, dtype=np.int64)
    active = np.arange(n)
    while len(active):
        cur = at[active]
        spots = place[active][:, None] + np.arange(STEP)
        near = book.order[cur[:, None], spots]
        # a gap g is within twice the distance d if g*g <= 4*d*d
        within = book.gaps[cur[:, None], spots] <= 4 * dist[active][:, None]
        r, c = np.nonzero(within & ~seen[active[:, None], near])
        jumped = np.zeros(len(active), dtype=bool)
        if len(r):
            which, entry = active[r], near[r, c]
            diff = x[which] - e[entry]
            d = np.einsum("ij,ij->i", diff, diff).astype(np.int64)
            computed += len(d)
            seen[which, entry] = True
            head = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])       # each row's first pair
            row = r[head]
            best = np.minimum.reduceat(d, head)
            tied = np.where(d == np.repeat(best, np.diff(np.r_[head, len(r)])), entry, m)
            lowest = np.minimum.reduceat(tied, head)
            own = active[row]
            better = (best < dist[own]) | ((best == dist[own]) & (lowest < at[own]))
            won = own[better]
            dist[won], at[won], place[won] = best[better], lowest[better], 0
            jumped[row[better]] = True
        stay = ~jumped
        place[active[stay]] += STEP
        active = active[jumped | within[:, -1]]
    return at, dist, computed


def first_codebooks(kept: DataFrame, entries: int, width: int, parts: int) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids: at most ``entries``
    vectors reach the driver."""
    rows = (kept.select("vec_id", F.col("_vector").cast("array<double>").alias("v"))
            .orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect())
    m = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        m[i, :len(r["v"])] = r["v"]
    return np.split(quantise(m, SCALE), parts, axis=1)


def improved(records: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round."""
    sent = records.sparkSession.sparkContext.broadcast([with_lists(b) for b in books])
    width = books[0].shape[1]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = [np.zeros(b.entries.shape, np.int64) for b in sent.value]
        count = [np.zeros(len(b.entries), np.int64) for b in sent.value]
        for batch in batches:
            for r in batch.itertuples():
                m = unpack_ints(r.kind, r.data, r.rows)
                for p, rows in enumerate(np.split(m, len(sent.value), axis=1)):
                    code, _, _ = orchard(rows, sent.value[p])
                    np.add.at(total[p], code, rows)
                    count[p] += np.bincount(code, minlength=len(count[p]))
        yield pd.DataFrame([(p, i, int(n[i]), total[p][i]) for p, n in enumerate(count) for i in np.nonzero(n)[0]],
                           columns=["part", "entry", "n", "total"])

    used = (records.select("rows", "kind", "data")
            .mapInPandas(sums, "part int, entry int, n long, total array<long>")
            .groupBy("part", "entry")
            .agg(F.sum("n").alias("n"), *[F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(width)])
            .select("part", "entry", F.array(*[
                F.expr(f"(t{i} - pmod(t{i}, n)) div n") for i in range(width)]).alias("mean")))
    new = [b.copy() for b in books]
    for r in used.collect():            # codebooks only: parts x entries rows
        new[r["part"]][r["entry"]] = r["mean"]
    return new


def encode(records: DataFrame, books: list[np.ndarray], carry: list[str]) -> DataFrame:
    """(*carry, code, error) of every row: its parts' entries and the sum of
    their squared distances."""
    sent = records.sparkSession.sparkContext.broadcast([with_lists(b) for b in books])
    source = records.select("rows", "kind", "data", *carry)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, errors = [], []
            for rows, kind, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                m = unpack_ints(kind, data, rows)
                searched = [orchard(x, b)[:2] for x, b in zip(np.split(m, len(sent.value), axis=1), sent.value)]
                found += np.stack([c for c, _ in searched], axis=1).tolist()
                errors.append(sum(d for _, d in searched))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(3 + i).flatten() for i in range(len(carry))],
                 pa.array(found, pa.list_(pa.int32())), pa.array(np.concatenate(errors), pa.int64())],
                names=[*carry, "code", "error"])

    fields = [f"`{c}` {source.schema[c].dataType.elementType.simpleString()}" for c in carry]
    return source.mapInArrow(codes, ", ".join([*fields, "code array<int>", "error long"]))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: float = SCALE, vec_id: str = "vec_id", vector: str = "embedding",
             label: str = "label") -> tuple[DataFrame, list[np.ndarray]]:
    """(codes, codebooks): vec_id, label, code (array of entry indexes) and
    error of every vector that takes part, and each part's final entries."""
    spark = vectors.sparkSession
    bound_batches(spark)
    kept = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"),
                           F.col(vector).alias("_vector"))
            .filter(finite(F.col("_vector"))))
    longest = kept.agg(F.max(F.size("_vector"))).first()[0]
    if longest is None:
        empty = kept.select("vec_id", "label").schema.add("code", T.ArrayType(T.IntegerType())).add("error", "long")
        return spark.createDataFrame([], empty), []
    width = max(1, -(-longest // parts)) * parts
    records = store(chunks(kept, "_vector", scale, width, ["vec_id", "label"]), "vectors")
    books = first_codebooks(kept, entries, width, parts)
    for _ in range(rounds):
        books = improved(records, books)
    return store(encode(records, books, ["vec_id", "label"]), "codes"), books


def codebooks_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def code_text(code, parts: int = PARTS):
    """Two hex digits per part."""
    return F.concat(*[F.lower(F.lpad(F.hex(F.get(code, F.lit(i)).cast("long")), 2, "0")) for i in range(parts)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: every kept vector's code and errors."""
    codes, books = compress(table(spark, sf_dir, "embeddings"))
    by_label = (codes.groupBy("label").agg(F.sum("error").alias("label_error"))
                .withColumnRenamed("label", "_label"))
    return (codes.join(by_label, codes["label"].eqNullSafe(by_label["_label"]))
            .select("vec_id", code_text(F.col("code")).alias("code"), "error", "label_error",
                    F.lit(codebooks_digest(books)).alias("codebooks_sha256")))


def _oracle(rounds: int = ROUNDS) -> str:
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label,
         [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x for x in embedding if x IS NOT NULL AND isfinite(CAST(x AS DOUBLE))]) = len(embedding)),
dims AS (SELECT CAST(greatest(1, ceil(max(len(v)) / {PARTS})) AS BIGINT) AS w FROM kept),
cells AS MATERIALIZED (
  SELECT r, (i - 1) // w AS p, (i - 1) % w AS k, coalesce(v[i], 0) AS x
  FROM (SELECT r, v, w, unnest(range(1, {PARTS} * w + 1)) AS i FROM kept, dims)),
first AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM kept),
b0 AS MATERIALIZED (
  SELECT p, first.e, k, x FROM first JOIN cells USING (r) WHERE first.e < {ENTRIES})"""]
    for n in range(rounds + 1):
        steps.append(f"""
d{n} AS (
  SELECT cells.r, cells.p, b{n}.e, CAST(sum((cells.x - b{n}.x) * (cells.x - b{n}.x)) AS BIGINT) AS d
  FROM cells JOIN b{n} ON cells.p = b{n}.p AND cells.k = b{n}.k GROUP BY cells.r, cells.p, b{n}.e),
a{n} AS MATERIALIZED (
  SELECT r, p, min(struct_pack(d := d, e := e)) AS best FROM d{n} GROUP BY r, p)""")
        if n < rounds:
            steps.append(f"""
s{n} AS (
  SELECT cells.p, a{n}.best.e AS e, k, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM cells JOIN a{n} ON a{n}.r = cells.r AND a{n}.p = cells.p GROUP BY cells.p, a{n}.best.e, k),
b{n + 1} AS MATERIALIZED (
  SELECT b{n}.p, b{n}.e, b{n}.k, coalesce((s - ((s % n) + n) % n) // n, b{n}.x) AS x
  FROM b{n} LEFT JOIN s{n} ON s{n}.p = b{n}.p AND s{n}.e = b{n}.e AND s{n}.k = b{n}.k)""")
    last = rounds
    return "WITH" + ",".join(steps) + f""",
coded AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{last} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, k)) FROM b{last}) AS codebooks_sha256
FROM coded JOIN kept USING (r)
"""


ORACLE = _oracle()
