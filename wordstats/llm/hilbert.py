"""Sharding along a Hilbert curve.

Metadata dimensions are quantised to ``2**BITS`` levels each, the levels
are mapped to an index along a Hilbert curve, the rows are sorted by that
index, and the order is cut into runs, so that each shard covers a compact
region of every dimension and readers can prune shards by any of them.
Runs are cut by ``rows`` (counts at most one apart) or by ``bytes`` (each
row goes where its first byte falls).

Text dimensions are quantised by rank: a value's level is the share of rows
with smaller values (null last), so that a level never splits a value's
order.  The size's level is its binary magnitude.  Rows with the same index
are ordered by text checksum, size and id (null ids first): equal texts
with equal metadata are neighbours, and a hot cell is spread over many sort
partitions.

Only built-in functions are used.  Texts are read once; what is sorted is
one narrow row per document.  Null texts have size 1 and checksum 0 and are
placed like empty ones; repeated rows each get a slot; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordstats.llm.common import running_totals, table, whole_text
from wordstats.operators.lookup import store

SHARDS = 16
BITS = 4


def magnitude(size: Column, bits: int = BITS) -> Column:
    """Binary magnitude of a positive number, in the lowest 2**bits levels
    from 64 up (a text shorter than 128 bytes is level 0)."""
    return F.least(F.greatest(F.floor(F.log2(size.cast("double"))).cast("long") - 6, F.lit(0)),
                   F.lit(2 ** bits - 1))


def rank_levels(rows: DataFrame, column: str, out: str, bits: int = BITS) -> DataFrame:
    """(``column``, ``out``): each distinct value's level by rank among all rows."""
    counts = rows.groupBy(column).agg(F.count("*").alias("_n"))
    before, total = running_totals(counts, [F.col(column).asc_nulls_last()], F.col("_n"))
    # Stored: one row per value, whose size Spark then knows when it plans the join.
    return store(before.select(column, F.floor(F.col("_before") * 2 ** bits / max(total, 1))
                               .cast("long").alias(out)), "levels")


def hilbert_index(df: DataFrame, dims: Sequence[str], out: str, bits: int = BITS) -> DataFrame:
    """``df`` with ``out``: the position of the point (``dims``, each 0 to
    2**bits - 1) along the Hilbert curve, by Skilling's transform.  ``dims``
    are used up."""
    first, last = dims[0], dims[-1]

    def flag(c: Column, q: int) -> Column:
        return c.bitwiseAND(F.lit(q)) != 0

    for power in range(bits - 1, 0, -1):
        q = 1 << power
        for d in dims:
            x, x0 = F.col(d), F.col(first)
            swap = x0.bitwiseXOR(x).bitwiseAND(F.lit(q - 1))
            if d == first:
                df = df.withColumn(first, F.when(flag(x, q), x.bitwiseXOR(F.lit(q - 1))).otherwise(x))
            else:
                df = df.withColumns({
                    first: F.when(flag(x, q), x0.bitwiseXOR(F.lit(q - 1))).otherwise(x0.bitwiseXOR(swap)),
                    d: F.when(flag(x, q), x).otherwise(x.bitwiseXOR(swap))})
    for a, b in zip(dims, dims[1:]):
        df = df.withColumn(b, F.col(b).bitwiseXOR(F.col(a)))
    turn = F.lit(0).cast("long")
    for power in range(bits - 1, 0, -1):
        q = 1 << power
        turn = turn.bitwiseXOR(F.when(flag(F.col(last), q), F.lit(q - 1)).otherwise(F.lit(0)).cast("long"))
    df = df.withColumn("_turn", turn)
    df = df.withColumns({d: F.col(d).bitwiseXOR(F.col("_turn")) for d in dims})
    index = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for d in dims:
            index = F.shiftleft(index, 1).bitwiseOR(F.shiftright(F.col(d), bit).bitwiseAND(F.lit(1)))
    return df.withColumn(out, index).drop("_turn", *dims)


def curve_order(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """One narrow row per document: doc_id, size, text_crc32, curve."""
    text = whole_text()
    rows = store(docs.select("doc_id", "lang", "source",
                             (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                             F.crc32(text.cast("binary")).cast("long").alias("text_crc32")), "rows")
    out = rows
    for column in ("lang", "source"):
        levels = rank_levels(rows, column, f"_{column}", bits)
        key = levels.withColumnRenamed(column, f"_key_{column}")
        out = out.join(key, out[column].eqNullSafe(key[f"_key_{column}"]), "left").drop(f"_key_{column}")
    out = out.withColumn("_size", magnitude(F.col("size"), bits))
    return hilbert_index(out, ["_source", "_lang", "_size"], "curve", bits).drop("lang", "source")


def shard(docs: DataFrame, shards: int = SHARDS, law: str = "rows", bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, curve, shard and slot of every document."""
    if law not in ("rows", "bytes"):
        raise ValueError("law must be rows or bytes")
    rows = curve_order(docs, bits)
    order = [F.col("curve"), F.col("text_crc32"), F.col("size"), F.col("doc_id")]
    unit = F.lit(1) if law == "rows" else F.col("size")
    placed, total = running_totals(rows, order, unit)
    at = F.floor(F.col("_before") * shards / max(total, 1)).cast("int")
    placed = placed.withColumn("shard", F.least(at, F.lit(shards - 1)))
    if law == "rows":
        # The shard's first place is the smallest that falls into it.
        start = F.ceil(F.col("shard") * F.lit(total) / F.lit(shards)).cast("long")
        return placed.withColumn("slot", F.col("_before") - start).drop("_before")
    ranked, _ = running_totals(placed.drop("_before"), order, F.lit(1))
    # One row per shard: bounded.
    first = ranked.groupBy("shard").agg(F.min("_before").alias("_first"))
    return (ranked.join(F.broadcast(first), "shard")
            .withColumn("slot", F.col("_before") - F.col("_first")).drop("_before", "_first"))


def write_shards(docs: DataFrame, path: str, **how) -> None:
    """Write ``docs`` with one folder per shard, for readers that prune by
    metadata.  A shard is cut along the curve into files of its own, each
    sorted, so that no task writes more than its share."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = shard(docs, **how).select("doc_id", "text_crc32", "size", "shard", "slot").distinct()
    text = whole_text()
    keyed = docs.withColumns({"_crc": F.crc32(text.cast("binary")).cast("long"),
                              "_size": (F.octet_length(text) + F.lit(1)).cast("long")})
    one = placed.groupBy("doc_id", "text_crc32", "size").agg(F.min(F.struct("shard", "slot")).alias("_at"))
    joined = keyed.join(one, keyed["doc_id"].eqNullSafe(one["doc_id"])
                        & (keyed["_crc"] == one["text_crc32"]) & (keyed["_size"] == one["size"]))
    (joined.select(*[keyed[c] for c in docs.columns], F.col("_at.shard").alias("shard"),
                   F.col("_at.slot").alias("_slot"))
     .repartitionByRange(max(parts, 4 * SHARDS), "shard", "_slot")
     .sortWithinPartitions("shard", "_slot").drop("_slot")
     .write.partitionBy("shard").parquet(path))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: every document's shard and slot, cut by rows."""
    placed = shard(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")
