"""Mean over the trailing rows of a total order, without a single-task sort.

One plan at every size: the rows are range-partitioned by the key and stored
with their partition's number; one row per partition gives the offsets of an
exact global row index; the index is cut into blocks of ``BLOCK_ROWS`` rows,
each of which also gets the last rows of the block before it; the window runs
per block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordstats.operators.lookup import store

# Rows of a block: what one task orders at a time.
BLOCK_ROWS = 100_000


def trailing_mean(df: DataFrame, key: str, value: str, rows: int = 30,
                  out: str = "rolling_avg", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` plus ``out`` = avg(value) over the ``rows`` rows ending at each
    row in ``key`` order (fewer at the start; nulls in ``value`` skipped)."""
    k = max(block_rows, rows)
    indexed = _global_index(df, key)
    g = F.col("_g")
    block = F.floor(g / F.lit(k)).cast("long")
    carry = (g % F.lit(k)) >= F.lit(k - (rows - 1))
    homes = F.array(
        F.struct(block.alias("_blk"), F.lit(False).alias("_carried")),
        F.when(carry, F.struct((block + F.lit(1)).alias("_blk"),
                               F.lit(True).alias("_carried"))),
    )
    spread = (indexed.select("*", F.explode(homes).alias("_home"))
              .filter(F.col("_home").isNotNull())
              .select("*", "_home._blk", "_home._carried").drop("_home"))
    w = Window.partitionBy("_blk").orderBy("_g").rowsBetween(-(rows - 1), 0)
    return (spread.withColumn(out, F.avg(value).over(w))
            .filter(~F.col("_carried"))
            .drop("_blk", "_carried", "_g"))


def _global_index(df: DataFrame, key: str) -> DataFrame:
    """``df`` plus ``_g``: 0-based position in ``key`` order (null keys first)."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stored = store(df.repartitionByRange(parts, key)
                   .withColumn("_b", F.spark_partition_id()), "ordered")
    sizes = stored.groupBy("_b").agg(F.count(F.lit(1)).alias("_size"))
    # One row per partition: bounded by the partition count.
    offsets = sizes.select(
        "_b",
        F.coalesce(F.sum("_size").over(Window.orderBy("_b").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy("_b").orderBy(key))
    return (stored.withColumn("_r", local)
            .join(F.broadcast(offsets), "_b")
            .withColumn("_g", F.col("_off") + F.col("_r") - F.lit(1))
            .drop("_b", "_r", "_off"))
