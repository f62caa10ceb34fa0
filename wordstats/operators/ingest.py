"""Insert-if-absent loading of answer batches into the fact table.

Rules, per batch row in arrival order (null pages first).  Rows read from
landed files arrive by page and part, then by file, then as they stand in
the file: the order of the files is taken from the files, not from how Spark
deals them to tasks (``arrival`` of ``sources.pages``).  Files are numbered
by one sort of their distinct (file, block) places, which the driver lists
anyway; what is shuffled per row is numbers only.  Other batches arrive by
``(page, pos)``, then by the row's number in the stored batch.

1. Fetch window: in an incremental load only rows dated after the table's
   latest date (the high-water mark) and up to ``today`` are fetched; a
   late row -- dated on or before the mark -- is never seen again unless
   ``accept_late`` is set.  An empty table means a full load: no window,
   and no ``today`` limit either.
   Rows whose date does not parse are fetched (and then fail).  Rows that
   are not fetched are labelled ``outside`` where asked for, so that the
   counters add up to the batch.
2. ``skipped`` -- the id is already in the table, or an earlier *valid*
   row of the batch carries it (the first valid row wins; the id test
   comes before validation, so later invalid rows are skipped too);
3. ``failed`` -- invalid: null id, null answer, or a date that is not a
   whole ``yyyy-MM-dd`` date (years from 10000 on have more digits);
4. ``inserted`` -- otherwise.

Instead of a window over each id (one group = one task, however hot the
id), the first valid arrival per id is an aggregate with map-side partial
aggregation.  The batch's ids, one row each, are looked up among the table's
(an existence join: a table in buckets of the id is read as it lies), stored
and joined back once; both sides of that join are plain shuffles, so AQE can
split a hot id's partition.  The batch itself is stored first, so the pages
are parsed once per load.  Rows without an id are labelled without any join,
so they cannot pile up on the null key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from wordstats.operators.lookup import store

LABELS = ("inserted", "skipped", "failed")
ALL_LABELS = (*LABELS, "outside")

# Years have four digits, or more (then with or without a sign).
WHOLE_DATE = r"^\s*(\d{4}|\+?\d{5,})-\d{2}-\d{2}\s*$"

TABLE_COLUMNS = ["puzzle_number", "answer", "date", "day_name", "difficulty"]


def strip_upper(col: Column) -> Column:
    """Upper-case, then strip surrounding whitespace (not only spaces)."""
    return F.regexp_replace(F.upper(col), r"^\s+|\s+$", "")


def high_water_mark(table: DataFrame) -> DataFrame:
    """One row: ``_hwm`` = latest date in the table (null when empty)."""
    return table.agg(F.max("date").alias("_hwm"))


def _numbered(rows: DataFrame) -> tuple[DataFrame, Column]:
    """``rows`` and their arrival key.  For rows read from files, ``arrival``
    gives way to ``_part`` and ``_seq``: the rank of the row's (file, block)
    among all, then its number within it."""
    if "arrival" not in rows.columns:
        return rows, F.struct("page", "pos", "_row")
    placed = rows.withColumns({"_file": F.col("arrival.file"), "_block": F.col("arrival.block")})
    # One row per file split, as many as the driver lists to read them.
    splits = (placed.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"))
              .select("_file", "_block", F.row_number().over(Window.orderBy("_file", "_block"))
                      .cast("long").alias("_split")))
    # A row's number ends with its place in its task, which read the block in order.
    seq = F.shiftleft("_split", 33).bitwiseOR(F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)))
    out = (placed.join(splits, ["_file", "_block"])
           .withColumns({"_part": F.col("arrival.part"), "_seq": seq})
           .drop("arrival", "_file", "_block", "_split"))
    return out, F.struct("page", "_part", "_seq")


def parsed(batch: DataFrame) -> DataFrame:
    """``batch`` with what a load reads from it: ``_id``, ``_answer``, ``_date``."""
    text_date = F.col("date").cast("string")
    return batch.select(
        *batch.columns,
        F.col("game").cast("long").alias("_id"),
        strip_upper(F.col("answer")).alias("_answer"),
        F.when(text_date.rlike(WHOLE_DATE), text_date.try_cast("date")).alias("_date"))


def in_window(mark: Column, today: Column | str | None, accept_late: bool) -> Column:
    """Whether a row with a date is in the fetch window."""
    d = F.col("_date")
    keep = F.lit(True)
    if not accept_late:
        # A scalar subquery: the mark is computed once, nothing is joined.
        # (no mark yet -> the comparison is null -> keep)
        keep = F.coalesce(d > mark, F.lit(True))
    if today is not None:
        if isinstance(today, str):
            # "current": the date at which each batch runs (long-running streams)
            limit = F.current_date() if today == "current" else F.lit(today).cast("date")
        else:
            limit = today
        # no mark: a full load, which has no window
        keep = F.coalesce(keep & (mark.isNull() | (d <= limit)), F.lit(False))
    return keep


def known_ids(ids: DataFrame, table: DataFrame) -> DataFrame:
    """``ids`` with ``_known``: whether the table has the row's ``_fid``."""
    stored = table.select(F.col("puzzle_number").cast("long").alias("puzzle_number"))
    return ids.select("*", F.col("_fid").isin(stored).alias("_known"))


def label_batch(batch: DataFrame, table: DataFrame, today: Column | str | None = None,
                accept_late: bool = False, mark: Column | None = None,
                outside: bool = False) -> DataFrame:
    """Label every fetched batch row; keeps the batch columns (but
    ``arrival``) plus the parsed ``_id``, ``_answer``, ``_date`` and
    ``label``.  ``mark`` stands in for the table's latest date where one fetch
    is loaded in several batches.  With ``outside``, rows out of the fetch
    window come too, labelled so."""
    rows = store(parsed(batch).withColumn("_row", F.monotonically_increasing_id()), "batch")
    rows, arrival = _numbered(rows)
    d = F.col("_date")
    if mark is None:
        mark = high_water_mark(table).scalar()
    keep = in_window(mark, today, accept_late)
    fetched = rows.filter(d.isNull() | keep)

    valid = F.col("_id").isNotNull() & F.col("_answer").isNotNull() & d.isNotNull()
    out = [c for c in (*batch.columns, "_id", "_answer", "_date") if c != "arrival"]
    # Rows without an id can match nothing: they fail without joining, so
    # however many there are they never gather on one join key.
    no_id = fetched.filter(F.col("_id").isNull()).select(*out, F.lit("failed").alias("label"))
    with_id = fetched.filter(F.col("_id").isNotNull())
    # Stored ids outside the batch's id range cannot match: the range (two
    # scalar subqueries) reaches the table scan, where Parquet statistics
    # skip the row groups of earlier loads.
    lo = with_id.agg(F.min("_id")).scalar()
    hi = with_id.agg(F.max("_id")).scalar()
    per_id = store(known_ids(
        with_id.groupBy(F.col("_id").alias("_fid")).agg(F.min(F.when(valid, arrival)).alias("_first")),
        table.filter(F.col("puzzle_number").cast("long").between(lo, hi))), "ids")
    joined = with_id.join(per_id, F.col("_id") == F.col("_fid"), "left")
    label = (F.when(F.col("_known"), F.lit("skipped"))
             .when(F.col("_first").isNotNull() & (arrival > F.col("_first")), F.lit("skipped"))
             .when(~valid, F.lit("failed"))
             .otherwise(F.lit("inserted")))
    labelled = joined.select(*out, label.alias("label")).unionByName(no_id)
    if outside:
        beyond = rows.filter(d.isNotNull() & ~keep)
        labelled = labelled.unionByName(beyond.select(*out, F.lit("outside").alias("label")))
    return labelled


def counters(labels: tuple[str, ...] = LABELS) -> list[Column]:
    return [F.count(F.when(F.col("label") == F.lit(l), F.lit(1))).alias(l) for l in labels]


def label_counts(labelled: DataFrame, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """One row: a counter per label (inserted, skipped, failed)."""
    return labelled.agg(*counters(labels))


def stored_with_counts(labelled: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """The stored labelled batch and its counters, one per label, observed by
    the job that writes it: nothing is read a second time for them."""
    seen = Observation("load")
    done = store(labelled.observe(seen, *counters(ALL_LABELS)), "labelled")
    return done, {l: int(seen.get[l]) for l in ALL_LABELS}


def inserted_rows(labelled: DataFrame) -> DataFrame:
    """The rows to append, in table form (without ``loaded_at``)."""
    return (labelled.filter(F.col("label") == F.lit("inserted"))
            .select(F.col("_id").alias("puzzle_number"), F.col("_answer").alias("answer"),
                    F.col("_date").alias("date"), F.col("day_name").cast("string").alias("day_name"),
                    F.col("difficulty").cast("float").alias("difficulty")))


REFUSED_COLUMNS = ["page", "pos", "game", "answer", "date", "day_name", "difficulty"]


def refused_rows(labelled: DataFrame) -> DataFrame:
    """The failed rows as they arrived, with what is wrong with them:
    ``reason`` names each missing or unusable declared column."""
    has_date = F.col("date").isNotNull()
    wrong = [
        F.when(F.col("_id").isNull(), F.lit("no id")),
        F.when(F.col("_answer").isNull(), F.lit("no answer")),
        F.when(~has_date, F.lit("no date")),
        F.when(has_date & F.col("_date").isNull(), F.lit("no whole date")),
    ]
    return (labelled.filter(F.col("label") == F.lit("failed"))
            .select(*REFUSED_COLUMNS, F.concat_ws(", ", *wrong).alias("reason")))


def load_result(table: DataFrame, labelled: DataFrame) -> DataFrame:
    """The table after the load: existing rows plus inserted ones."""
    return table.select(*TABLE_COLUMNS).unionByName(inserted_rows(labelled))
