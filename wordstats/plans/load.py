"""The fact table on storage and the insert-if-absent load into it.

Layout: Parquet under ``path``, partitioned by ``load_id`` (0 = the first
load, then one id per later batch).  A load writes only its own partition
with dynamic partition overwrite, and labels its batch against the rows of
*earlier* loads only, so re-running the same load id -- a retried job or a
replayed micro-batch -- rewrites the same rows instead of adding or losing
any.

Loads that may run at once don't choose their ids: ``begin_load`` claims one
and labels the batch against what is committed, ``finish_load`` commits it.
Of two such loads the one that commits later finds the other's commit, takes
out the ids that it brought, and tries again, so no row is lost and no id is
stored twice; until a load is committed, readers don't see its rows.

The table's declarations hold for what is written: a null in a ``REQUIRED``
column stops the writing job, whoever wrote the rows, and ``write_rows``,
which takes rows that were not labelled, refuses ids that are in the table
or come twice.  Rows that a load refuses can be kept with their reasons under
a quarantine folder, partitioned by load like the table.

A table declared with ``layout.bucketed`` is stored in buckets of the id, and
a load looks stored ids up without shuffling them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordstats.operators.lookup import store
from wordstats.plans import commits, layout
from wordstats.operators.ingest import (
    ALL_LABELS,
    inserted_rows,
    label_batch,
    refused_rows,
    stored_with_counts,
)

FACT_SCHEMA = T.StructType([
    T.StructField("puzzle_number", T.LongType()),
    T.StructField("answer", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("day_name", T.StringType()),
    T.StructField("difficulty", T.FloatType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
    T.StructField("load_id", T.LongType()),
])

_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FACT_SCHEMA)

#: Columns that are never null.
REQUIRED = ("puzzle_number", "answer", "date")

REFUSED_SCHEMA = T.StructType([
    T.StructField("page", T.LongType()),
    T.StructField("pos", T.LongType()),
    T.StructField("game", T.LongType()),
    T.StructField("answer", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("day_name", T.StringType()),
    T.StructField("difficulty", T.FloatType()),
    T.StructField("reason", T.StringType()),
    T.StructField("load_id", T.LongType()),
])


class KeyTaken(ValueError):
    pass


def read_table(spark: SparkSession, path: str, before_load: int | None = None) -> DataFrame:
    """The fact table (empty when nothing was written yet), without loads
    that are not committed; with ``before_load``, only rows of earlier loads
    (partition pruning)."""
    number = layout.buckets(spark, path)
    try:
        df = layout.read(spark, path, number, _DDL) if number else spark.read.schema(FACT_SCHEMA).parquet(path)
    except Exception as e:  # nothing landed yet
        if number or ("PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e)):
            raise
        df = spark.createDataFrame([], FACT_SCHEMA)
    running = commits.pending(spark, path)
    if running:     # loads that run now or died: few
        df = df.filter(~F.col("load_id").isin(running))
    if before_load is not None:
        df = df.filter(F.col("load_id") < F.lit(before_load))
    return df


def _required(name: str) -> Column:
    """The column, where a null stops the job."""
    return F.when(F.col(name).isNull(), F.raise_error(F.lit(f"{name} must not be null"))).otherwise(F.col(name))


def _write(rows: DataFrame, path: str, load_id: int) -> None:
    """Store rows whose ids are known to be new as load ``load_id``."""
    whole = (rows.withColumns({name: _required(name) for name in REQUIRED})
             .withColumn("loaded_at", F.localtimestamp())
             .withColumn("load_id", F.lit(load_id).cast("long"))
             .select(*FACT_SCHEMA.fieldNames()))
    number = layout.buckets(rows.sparkSession, path)
    if number:
        layout.write(whole, path, number, _DDL, load_id)
    else:
        (whole.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("load_id")
         .parquet(path))


def write_rows(rows: DataFrame, path: str, load_id: int = 0) -> None:
    """Store table-form rows as load ``load_id`` (replacing that load only).
    Where an id comes twice, or is in another load, nothing is stored:
    ``KeyTaken`` names some of them."""
    rows = store(rows, "rows")
    others = read_table(rows.sparkSession, path).filter(F.col("load_id") != F.lit(load_id))
    # Only ids within the new rows' range can clash.
    lo = rows.agg(F.min("puzzle_number")).scalar()
    hi = rows.agg(F.max("puzzle_number")).scalar()
    ids = (rows.select("puzzle_number", F.lit(True).alias("_new"))
           .unionByName(others.filter(F.col("puzzle_number").between(lo, hi))
                        .select("puzzle_number", F.lit(False).alias("_new"))))
    taken = (ids.groupBy("puzzle_number").agg(F.count(F.lit(1)).alias("_n"), F.max("_new").alias("_new"))
             .filter((F.col("_n") > 1) & F.col("_new") & F.col("puzzle_number").isNotNull())
             .select("puzzle_number").limit(5).collect())
    if taken:
        raise KeyTaken(f"puzzle_number not unique: {sorted(r[0] for r in taken)}")
    _write(rows, path, load_id)


def write_refused(labelled: DataFrame, path: str, load_id: int) -> None:
    """Keep a load's failed rows with their reasons (replacing that load's only)."""
    (refused_rows(labelled).withColumn("load_id", F.lit(load_id).cast("long"))
     .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in REFUSED_SCHEMA])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("load_id").parquet(path))


def read_refused(spark: SparkSession, path: str, table_path: str | None = None) -> DataFrame:
    """The refused rows; with the table's path, of committed loads only."""
    try:
        df = spark.read.schema(REFUSED_SCHEMA).parquet(path)
    except Exception as e:  # nothing was refused yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        df = spark.createDataFrame([], REFUSED_SCHEMA)
    running = commits.pending(spark, table_path) if table_path else []
    return df.filter(~F.col("load_id").isin(running)) if running else df


def insert_if_absent(spark: SparkSession, path: str, batch: DataFrame, load_id: int,
                     today: Column | str | None = None, accept_late: bool = False,
                     counts_path: str | None = None, mark: Column | None = None,
                     quarantine_path: str | None = None) -> DataFrame:
    """Label ``batch`` against the earlier loads, store its inserted rows as
    load ``load_id`` and return the counters (one row; inserted, skipped,
    failed, outside: together the batch's rows), also stored under
    ``counts_path`` when given; failed rows are kept under
    ``quarantine_path`` when given.

    The labelled batch is stored first, so the write reads the same labels
    and the batch is not recomputed; the storing job counts them.
    """
    table = read_table(spark, path, before_load=load_id)
    labelled, seen = stored_with_counts(label_batch(batch, table, today, accept_late, mark, outside=True))
    if quarantine_path:
        write_refused(labelled, quarantine_path, load_id)
    _write(inserted_rows(labelled), path, load_id)
    counts = spark.range(1).select(*[F.lit(seen[l]).cast("long").alias(l) for l in ALL_LABELS],
                                   F.lit(load_id).cast("long").alias("load_id"))
    if counts_path:
        (counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("load_id").parquet(counts_path))
    return counts


@dataclass
class Load:
    """A load between its claim and its commit."""

    path: str
    load_id: int
    seen: int                   # commits that its labels know of
    rows: DataFrame             # what it will store
    labelled: DataFrame
    counts: dict[str, int]


def begin_load(spark: SparkSession, path: str, batch: DataFrame, today: Column | str | None = None,
               accept_late: bool = False) -> Load:
    """Claim an id and label ``batch`` against the committed loads."""
    seen = len(commits.committed(spark, path))
    table = read_table(spark, path)
    load_id = commits.claim(spark, path, table.agg(F.max("load_id")).first()[0])
    labelled, counts = stored_with_counts(label_batch(batch, table, today, accept_late, outside=True))
    return Load(path, load_id, seen, inserted_rows(labelled), labelled, counts)


def finish_load(spark: SparkSession, load: Load, quarantine_path: str | None = None) -> dict[str, int]:
    """Store the rows and commit; the counters (inserted, skipped, failed,
    outside).  Rows whose ids another load committed meanwhile count as
    skipped.  Failed rows are kept under ``quarantine_path`` when given,
    before the commit that lets readers see them."""
    if quarantine_path:
        write_refused(load.labelled, quarantine_path, load.load_id)
    while True:
        _write(load.rows, load.path, load.load_id)
        if commits.commit(spark, load.path, load.seen, load.load_id):
            return load.counts
        done = commits.committed(spark, load.path)
        newer = read_table(spark, load.path).filter(F.col("load_id").isin(done[load.seen:]))
        load.rows = store(load.rows.join(newer.select("puzzle_number"), "puzzle_number", "left_anti")
                          .select(*load.rows.columns), "uncontested")
        kept = load.rows.count()
        load.counts = load.counts | {"inserted": kept,
                                     "skipped": load.counts["skipped"] + load.counts["inserted"] - kept}
        if not kept and not layout.buckets(spark, load.path):   # no rows would leave the old ones
            _clear(spark, load.path, load.load_id)
        load.seen = len(done)


def _clear(spark: SparkSession, path: str, load_id: int) -> None:
    """Take out what an uncommitted load has written."""
    fs, at = commits._file_system(spark, f"{path.rstrip('/')}/load_id={load_id}")
    fs.delete(at, True)
