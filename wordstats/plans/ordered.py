"""Marts stored in their read order, so that reading the first rows reads
the first files, and every row knows its place without a global window.

Rows are range-partitioned by the order, sorted within the partition and
written to a folder per partition with their number in it (``_at``).  How
many rows each partition has is counted on what was written and stored
beside it: one row per partition.  A row's position is its partition's
offset plus its number, so reading positions needs neither a sort nor a
shuffle, and the first k rows lie in the partitions whose offset is below k:
the others' folders are not opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_HIDDEN = ("_part", "_at")


def order_columns(keys: list[str]) -> list[Column]:
    """Sort columns of names, "-" before a name meaning descending; nulls last."""
    return [F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_last() for k in keys]


def write_ordered(df: DataFrame, path: str, keys: list[str], parts: int | None = None) -> None:
    """Store ``df`` in the order of ``keys`` under ``path``."""
    spark = df.sparkSession
    order = order_columns(keys)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(parts, *order)
     .withColumn("_part", F.spark_partition_id())
     .sortWithinPartitions("_part", *order)
     .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
     .write.mode("overwrite").partitionBy("_part").parquet(f"{path}/rows"))
    written = spark.read.schema(_stored_schema(df)).parquet(f"{path}/rows")
    sizes = written.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    # One row per partition.
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    (sizes.select(F.col("_part").cast("int").alias("_part"), "n",
                  F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first"))
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/index"))


def _stored_schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", `_at` LONG, `_part` INT"


def read_ordered(spark: SparkSession, path: str, first: int | None = None,
                 position: str | None = None) -> DataFrame:
    """The stored rows, or the ``first`` of them in order, with their place
    (from 1) as ``position`` where named.  Rows come as Spark reads them:
    order by the position where a sorted result is wanted."""
    rows = spark.read.parquet(f"{path}/rows")
    if first is None and position is None:
        return rows.drop(*_HIDDEN)
    index = spark.read.parquet(f"{path}/index")
    if first is not None:
        # as many parts as the write made
        parts = [r["_part"] for r in index.filter(F.col("first") < first).select("_part").collect()]
        rows = rows.filter(F.col("_part").isin(parts))
    # One row per partition of the write: bounded, as is its broadcast.
    placed = (rows.join(F.broadcast(index.select("_part", "first")), "_part")
              .withColumn("_position", F.col("first") + F.col("_at") + F.lit(1)))
    if first is not None:
        placed = placed.filter(F.col("_position") <= F.lit(first))
    columns = [c for c in rows.columns if c not in _HIDDEN]
    return placed.select(*columns, *([F.col("_position").alias(position)] if position else []))
