"""Structured Streaming form of the load: landed pages -> fact table.

``readStream`` picks up new page files; each micro-batch is loaded with
``insert_if_absent`` as load ``first_load + batch_id`` (by default one past
the table's latest load when the stream first starts, kept for restarts).  The
fetch window is the stream's, too: the table's latest date when the stream
first starts, kept beside the checkpoint, so that the result doesn't depend on
how files fall into micro-batches or starts.  Inside a
micro-batch rows are ordered by ``(page, pos)``; micro-batches follow
arrival order.  The checkpoint records which files were consumed; a
replayed micro-batch relabels against earlier loads only and overwrites
its own partition, so replays are idempotent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wordstats.plans.load import insert_if_absent, read_table
from wordstats.sources.pages import stream_pages


def stream_start(spark: SparkSession, table_path: str, checkpoint: str) -> tuple[int, str | None]:
    """The load id of micro-batch 0 and the mark of the fetch window: one
    past the table's latest load and its latest date (as text, since Python's
    dates end with the year 9999; null: empty) when the
    stream first starts, then read back from next to the checkpoint."""
    marker = f"{checkpoint.rstrip('/')}_start"
    try:
        kept = spark.read.schema("first_load LONG, mark STRING").json(marker).first()
        return kept["first_load"], kept["mark"]
    except Exception as e:  # first start: no marker yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
    start = read_table(spark, table_path).agg(
        F.coalesce(F.max("load_id") + 1, F.lit(0).cast("long")).alias("first_load"),
        F.max("date").cast("string").alias("mark"))
    start.coalesce(1).write.json(marker)
    kept = spark.read.schema("first_load LONG, mark STRING").json(marker).first()
    return kept["first_load"], kept["mark"]


def start_stream_load(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
                      counts_path: str | None = None, today: Column | str | None = None,
                      accept_late: bool = False, first_load: int | None = None,
                      available_now: bool = True, quarantine_path: str | None = None,
                      **source_options) -> StreamingQuery:
    own_first, latest = stream_start(spark, table_path, checkpoint)
    if first_load is None:
        first_load = own_first
    rows = stream_pages(spark, landing, **source_options)
    mark = F.lit(latest).cast("date")

    def load(batch: DataFrame, batch_id: int) -> None:
        insert_if_absent(spark, table_path, batch, first_load + batch_id, today,
                         accept_late, counts_path, mark, quarantine_path)

    writer = (rows.writeStream.foreachBatch(load)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
