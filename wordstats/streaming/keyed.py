"""The streaming load with the ids in the stream's own state.

``start_stream_load`` looks every micro-batch up in the table.  Here Spark's
state store (RocksDB, under the checkpoint) holds one row per id, the first
valid one, and a micro-batch reads and writes the state of its own ids only:
the table is read once, when the stream first starts, for the ids it has then.

The state is a streaming aggregate: the smallest arrival and the latest
micro-batch per id, combined by task before the shuffle, so a hot id moves one
row a task.  An id is new where all its arrivals are of the present micro-batch
(every micro-batch has its own time, which replays keep); its row is then
stored as load ``first_load + batch_id``, which a replay overwrites.

What differs from ``start_stream_load``:

* from its first start on, the stream is the table's only writer;
* an invalid row counts as failed, also where its id is stored;
* within a micro-batch rows arrive by page and part, then by file and block,
  then by position: documents without page numbers should come in files of
  their own (a stream can't number the documents inside a file);
* failed rows are counted, not kept.

The state grows by one row per id and is never dropped: an id that came once
is known for good.  Every micro-batch opens and commits every state partition,
whatever it brings, so there are only as many as the application runs tasks at
once (``spark.default.parallelism`` at the first start; never more than
``spark.sql.shuffle.partitions``) unless ``state_partitions`` is given.  They
stay for the life of the checkpoint: give a number for the cluster's final
size.  A commit writes what changed; Spark's maintenance takes the snapshots.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wordstats.operators.ingest import ALL_LABELS, in_window, parsed
from wordstats.operators.lookup import store
from wordstats.plans import commits
from wordstats.plans.load import _write, read_table
from wordstats.sources.pages import stream_pages
from wordstats.streaming.ingest import stream_start

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
_PARTITIONS = "spark.sql.shuffle.partitions"
_FEWEST_PARTITIONS = 8      # executors may still be starting
_STORED = "timestamp'1970-01-01 00:00:00Z'"     # the arrival of what the table had


@contextmanager
def _state_in_rocksdb(spark: SparkSession, partitions: int | None):
    """A query keeps the settings it was started with; the session's stay."""
    given = int(spark.conf.get(_PARTITIONS))
    at_once = max(_FEWEST_PARTITIONS, spark.sparkContext.defaultParallelism)
    settings = {_PROVIDER: _ROCKSDB, _CHANGELOG: "true", _PARTITIONS: str(partitions or min(given, at_once))}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _stored_ids(spark: SparkSession, table_path: str, checkpoint: str) -> str:
    """The folder with the ids that the table had when the stream first
    started, written whole before anything of the stream runs."""
    path = f"{checkpoint.rstrip('/')}_ids"
    if commits.read_text(spark, f"{path}/_SUCCESS") is None:
        read_table(spark, table_path).select("puzzle_number").write.mode("overwrite").parquet(path)
    return path


def _events(pages: DataFrame, mark: Column, today: Column | str | None, accept_late: bool) -> DataFrame:
    """(kind, id, at): for every row one event that counts it (kind: valid,
    failed or outside) and, if it is valid, one of kind ``id``."""
    rows = parsed(pages)
    d = F.col("_date")
    valid = F.col("_id").isNotNull() & F.col("_answer").isNotNull() & d.isNotNull()
    kind = (F.when(d.isNotNull() & ~in_window(mark, today, accept_late), F.lit("outside"))
            .when(valid, F.lit("valid")).otherwise(F.lit("failed")))
    at = F.struct(F.current_timestamp().alias("arrived"), "page", F.col("arrival.part").alias("part"),
                  F.col("arrival.file").alias("file"), F.col("arrival.block").alias("block"), "pos",
                  F.col("_answer").alias("answer"), d.alias("date"),
                  F.col("day_name").cast("string").alias("day_name"),
                  F.col("difficulty").cast("float").alias("difficulty"))
    told = rows.select(kind.alias("kind"), F.col("_id").alias("id"), at.alias("at"))
    none = F.lit(None)
    counted = F.struct("kind", none.cast("long").alias("id"),
                       none.cast(told.schema["at"].dataType).alias("at"))
    known = F.struct(F.lit("id").alias("kind"), "id", "at")
    return told.select(F.inline(F.when(F.col("kind") == "valid", F.array(counted, known))
                                .otherwise(F.array(counted))))


def start_keyed_load(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
                     counts_path: str | None = None, today: Column | str | None = None,
                     accept_late: bool = False, available_now: bool = True,
                     state_partitions: int | None = None, **source_options) -> StreamingQuery:
    """Load landed pages into the table as they come; see above."""
    ids = _stored_ids(spark, table_path, checkpoint)
    first_load, latest = stream_start(spark, table_path, checkpoint)
    arriving = _events(stream_pages(spark, landing, **source_options), F.lit(latest).cast("date"),
                       today, accept_late)
    place = arriving.schema["at"].dataType
    # All of it comes with the first micro-batch.
    stored = (spark.readStream.schema("puzzle_number LONG").parquet(ids)
              .select(F.lit("id").alias("kind"), F.col("puzzle_number").alias("id"),
                      F.struct(*[(F.expr(_STORED) if f.name == "arrived" else F.lit(None)).cast(f.dataType)
                                 .alias(f.name) for f in place]).alias("at")))
    state = (arriving.unionByName(stored).groupBy("kind", "id")
             .agg(F.min("at").alias("first"), F.max("at.arrived").alias("latest"),
                  F.count(F.lit(1)).alias("n")))

    def load(changed: DataFrame, batch_id: int) -> None:
        changed = store(changed, "changed")
        load_id = first_load + batch_id
        new = changed.filter((F.col("kind") == "id") & (F.col("first.arrived") == F.col("latest"))
                             & (F.col("first.arrived") > F.expr(_STORED)))
        _write(new.select(F.col("id").alias("puzzle_number"), "first.answer", "first.date",
                          "first.day_name", "first.difficulty"), table_path, load_id)
        if counts_path:
            so_far = [F.max(F.when(F.col("kind") == k, F.col("n"))).alias(k) for k in ("valid", "failed", "outside")]
            (changed.agg(*so_far).withColumns({"inserted": new.select(F.count(F.lit(1))).scalar(),
                                               "load_id": F.lit(load_id).cast("long")})
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("load_id").parquet(counts_path))

    with _state_in_rocksdb(spark, state_partitions):
        writer = (state.writeStream.outputMode("update").foreachBatch(load)
                  .option("checkpointLocation", checkpoint))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
            processingTime="1 minute")
        return writer.start()


def keyed_counts(spark: SparkSession, counts_path: str) -> DataFrame:
    """One row: the counters of all micro-batches so far (inserted, skipped,
    failed, outside: together the rows that arrived)."""
    inserted = F.coalesce(F.sum("inserted"), F.lit(0))
    total = {k: F.coalesce(F.max(k), F.lit(0)) for k in ("valid", "failed", "outside")}
    of = {"inserted": inserted, "skipped": total["valid"] - inserted,
          "failed": total["failed"], "outside": total["outside"]}
    return spark.read.parquet(counts_path).agg(*[of[l].cast("long").alias(l) for l in ALL_LABELS])
