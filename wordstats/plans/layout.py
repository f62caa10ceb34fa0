"""Fact tables stored in buckets of the id, so that a load's lookup of stored
ids moves the batch's ids only.

``bucketed`` declares the layout before the first load; it is kept beside the
table's commits, so every later reader and writer of the path -- loads, runs,
streams, in any session -- follows it.  Each load's partition holds one file
per bucket, sorted by id; the session's catalog names the folder as an
external table, which is how Spark learns of the buckets.  The join on the id
then takes the stored side as it lies: one task per bucket reads that bucket
of every load whose ids may be in range.

Choose the number of buckets for the table's final size (a bucket of some
hundred MB of ids): it can't be changed later, and every load writes that many
files, so small loads should be gathered before they are written.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from wordstats.plans import commits

KEY = "puzzle_number"


def _marker(path: str) -> str:
    return f"{path.rstrip('/')}/{commits.LOG}/buckets"


def buckets(spark: SparkSession, path: str) -> int | None:
    """The table's number of buckets; None where it has none."""
    text = commits.read_text(spark, _marker(path))
    return int(text) if text else None


def bucketed(spark: SparkSession, path: str, number: int) -> None:
    """Declare that the table at ``path``, which holds nothing yet, is stored
    in ``number`` buckets of its id.  Declaring the same again does nothing."""
    if number < 1:
        raise ValueError("a table has one bucket or more")
    there = buckets(spark, path)
    if there is None:
        if commits.has_loads(spark, path):
            raise ValueError(f"{path} holds loads without buckets")
        commits.create_once(spark, _marker(path), str(number))
        there = buckets(spark, path)
    if there != number:
        raise ValueError(f"{path} has {there} buckets")


def _name(path: str) -> str:
    return f"facts_{hashlib.md5(path.rstrip('/').encode()).hexdigest()}"


def _table(spark: SparkSession, path: str, number: int, schema: str) -> str:
    """The catalog's name for the folder, with the partitions it has now."""
    at = path.rstrip("/").replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(path)} ({schema}) USING parquet PARTITIONED BY (load_id) "
              f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {number} BUCKETS LOCATION '{at}'")
    spark.sql(f"ALTER TABLE {_name(path)} RECOVER PARTITIONS")
    return _name(path)


def read(spark: SparkSession, path: str, number: int, schema: str) -> DataFrame:
    return spark.table(_table(spark, path, number, schema))


def write(rows: DataFrame, path: str, number: int, schema: str, load_id: int) -> None:
    """Replace load ``load_id`` with ``rows`` (which may be none)."""
    spark = rows.sparkSession
    # Spread as the buckets are: each is written by one task, as one file.
    spread = rows.drop("load_id").repartition(number, KEY)
    listed = ", ".join(f"`{c}`" for c in spread.columns)
    spark.sql(f"INSERT OVERWRITE TABLE {_table(spark, path, number, schema)} "
              f"PARTITION (load_id = {load_id}) ({listed}) SELECT {listed} FROM {{rows}}", rows=spread)


def forget(spark: SparkSession, path: str) -> None:
    """Take the folder's name out of the session's catalog; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
