"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordstats.operators.lookup import store

#: Words of a text: runs of anything but space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


#: Most bytes and rows of a batch of texts that goes to a Python worker at once.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    """Keep the batches that Python workers get small, whatever the texts'
    lengths: a worker's and an executor's memory then follow ``BATCH_BYTES``
    and the longest text, not the number of rows in a batch.  Sets two
    options of the session, which hold for what it runs from then on."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(col: str = "text") -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(col), F.lit(""))


def id_remainder(divisor: int, col: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo ``divisor`` (null for a null id)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(divisor)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, whatever the optimiser
    makes of the projections around it."""
    return F.transform(F.array(value), body)[0]


def with_replaced(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` plus the given columns; input columns whose names clash with
    them (in any letter case) are dropped first."""
    taken = {name.lower() for name in columns}
    keep = [f"`{c}`" for c in df.columns if c.lower() not in taken]
    return df.select(*keep, *[c.alias(name) for name, c in columns.items()])


def running_totals(df: DataFrame, order: list[Column], value: Column) -> tuple[DataFrame, int]:
    """``df`` with ``_before``: the sum of ``value`` over the rows that come
    earlier in ``order``, and the sum over all rows.

    No task sees more than its share: the rows are range-partitioned by the
    order and stored with their partition's number, one aggregate row per
    partition gives the partitions' offsets, and the running sum inside a
    partition is a window over that partition.  ``order`` should tell rows
    apart, so that no single key outgrows a partition.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = store(df.withColumn("_value", value.cast("long"))
                   .repartitionByRange(parts, *order)
                   .withColumn("_part", F.spark_partition_id()), "ordered")
    per_part = stored.groupBy("_part").agg(F.sum("_value").alias("_sum"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: bounded by the partition count, so broadcast.
    offsets = per_part.select("_part", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_offset"))
    total = per_part.agg(F.coalesce(F.sum("_sum"), F.lit(0)).alias("n")).first()["n"]
    inside = (Window.partitionBy("_part").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    out = (stored.join(F.broadcast(offsets), "_part")
           .withColumn("_before", F.col("_offset") + F.coalesce(F.sum("_value").over(inside), F.lit(0)))
           .drop("_part", "_offset", "_value"))
    return out, int(total)
