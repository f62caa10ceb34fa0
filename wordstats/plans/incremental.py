"""Marts kept up from load to load, without reading earlier loads again.

Letter counts and pattern statistics are sums, minima and maxima, so each
update stores those of the loads it finds new and the marts are read from
the sum of all updates.  An update's rows count only once its marker, written
last, says which loads it covers; an update that dies is made again.

The trailing mean of a row depends on the rows just before it, so an update
computes the rows from the smallest new key on, starting from the last
``rows`` - 1 ones before it, and stores them as a segment.  A segment holds
until a later one begins: with loads that only add later keys every segment
is that load's rows, and a load that adds earlier keys replaces what follows
them.  The last rows are stored with the segment, so an update that only adds
later keys reads nothing older than the load.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordstats.functions.numeric import round_at
from wordstats.functions.words import DEFAULT_LENGTH
from wordstats.operators.difficulty import PATTERN_KEYS
from wordstats.operators.frequency import count_names, letter_counts
from wordstats.operators.lookup import store
from wordstats.operators.reporting import TREND_ROWS
from wordstats.operators.staging import stage_answers
from wordstats.operators.trailing import trailing_mean
from wordstats.plans.load import read_table

_MARKER = "run STRING, at LONG, loads ARRAY<LONG>, low LONG, high LONG"


def _markers(spark: SparkSession, path: str) -> list:
    """The finished updates, oldest first: one small row each."""
    try:
        found = spark.read.schema(_MARKER).json(f"{path}/markers").collect()
    except Exception as e:  # nothing yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return []
    return sorted(found, key=lambda r: (r["at"], r["run"]))


def _mark(spark: SparkSession, path: str, run: str, loads: list[int], low: int | None, high: int | None) -> None:
    row = [(run, time.time_ns(), loads, low, high)]
    spark.createDataFrame(row, _MARKER).coalesce(1).write.mode("append").json(f"{path}/markers")


def new_loads(spark: SparkSession, table_path: str, path: str) -> tuple[list[int], DataFrame]:
    """(load ids without an update, their rows: only their folders are read)."""
    table = read_table(spark, table_path)
    loads = {r["load_id"] for r in table.select("load_id").distinct().collect()}
    missing = sorted(loads - {x for m in _markers(spark, path) for x in m["loads"]})
    rows = table.filter(F.col("load_id").isin(missing)) if missing else table.limit(0)
    return missing, rows.drop("loaded_at", "load_id")


def update_counts(spark: SparkSession, table_path: str, path: str, n: int = DEFAULT_LENGTH) -> list[int]:
    """Store letter counts and pattern statistics of the loads that have none
    yet; the loads it took."""
    missing, rows = new_loads(spark, table_path, path)
    if missing:
        run = uuid.uuid4().hex
        staged = store(stage_answers(rows, n), "staged")
        d = F.col("difficulty")
        patterns = (staged.filter(d.isNotNull()).groupBy(*PATTERN_KEYS)
                    .agg(F.count(F.lit(1)).alias("n"), F.sum(d.cast("double")).alias("total"),
                         F.min(d).alias("low"), F.max(d).alias("high")))
        letter_counts(staged, n).write.parquet(f"{path}/letters/run={run}")
        patterns.write.parquet(f"{path}/patterns/run={run}")
        _mark(spark, path, run, missing, None, None)
    return missing


def _finished(spark: SparkSession, path: str, name: str) -> DataFrame:
    runs = [m["run"] for m in _markers(spark, path)]
    return spark.read.option("basePath", f"{path}/{name}").parquet(*[f"{path}/{name}/run={r}" for r in runs])


def merged_letter_counts(spark: SparkSession, path: str, n: int = DEFAULT_LENGTH) -> DataFrame:
    """letter, total_count, count_1..count_N over all updates: an update has
    one row per letter."""
    return (_finished(spark, path, "letters").groupBy("letter")
            .agg(*[F.sum(c).alias(c) for c in ("total_count", *count_names(n))]))


def merged_difficulty_by_pattern(spark: SparkSession, path: str) -> DataFrame:
    """The difficulty mart over all updates: an update has one row per pattern."""
    return (_finished(spark, path, "patterns").groupBy(*PATTERN_KEYS)
            .agg(F.sum("n").alias("word_count"),
                 round_at(F.sum("total") / F.sum("n"), 2).alias("avg_difficulty"),
                 round_at(F.min("low"), 2).cast("float").alias("min_difficulty"),
                 round_at(F.max("high"), 2).cast("float").alias("max_difficulty")))


# --- the trailing mean ----------------------------------------------------------

def _scored(rows: DataFrame, n: int) -> DataFrame:
    return (stage_answers(rows, n).filter(F.col("difficulty").isNotNull())
            .select("puzzle_number", "difficulty"))


def update_trend(spark: SparkSession, table_path: str, path: str, rows: int = TREND_ROWS,
                 n: int = DEFAULT_LENGTH) -> int | None:
    """Bring the stored trend up to date; the first puzzle that was computed
    anew (null: nothing was)."""
    missing, raw = new_loads(spark, table_path, path)
    if not missing:
        return None
    key = F.col("puzzle_number")
    fresh = store(_scored(raw, n), "scored")
    low = fresh.agg(F.min(key)).first()[0]
    run = uuid.uuid4().hex
    if low is None:
        _mark(spark, path, run, missing, None, None)
        return None
    past = [m for m in _markers(spark, path) if m["low"] is not None]
    if past and low > past[-1]["high"]:
        before = spark.read.parquet(f"{path}/tails/run={past[-1]['run']}")
        after = fresh
    else:       # earlier keys, or the first update
        old = read_trend(spark, path).select("puzzle_number", "difficulty") if past else fresh.limit(0)
        before = old.filter(key < low).orderBy(key.desc()).limit(rows - 1)
        after = old.filter(key >= low).unionByName(fresh)
    known = store(before.withColumn("_old", F.lit(True)).unionByName(after.withColumn("_old", F.lit(False))),
                  "affected")
    trend = trailing_mean(known, "puzzle_number", "difficulty", rows, "rolling_avg")
    (trend.filter(~F.col("_old")).drop("_old").write.parquet(f"{path}/segments/run={run}"))
    (known.drop("_old").orderBy(key.desc()).limit(rows - 1)
     .coalesce(1).write.parquet(f"{path}/tails/run={run}"))
    _mark(spark, path, run, missing, low, known.agg(F.max(key)).first()[0])
    return low


def read_trend(spark: SparkSession, path: str) -> DataFrame:
    """puzzle_number, difficulty, rolling_avg of every scored puzzle."""
    markers = [m for m in _markers(spark, path) if m["low"] is not None]
    ends, end = [], None
    for m in reversed(markers):     # a segment holds until a later one begins
        ends.append((m["run"], end))
        end = m["low"] if end is None else min(end, m["low"])
    # One row per update.
    manifest = F.broadcast(spark.createDataFrame(ends, "run STRING, end LONG"))
    segments = (spark.read.option("basePath", f"{path}/segments")
                .parquet(*[f"{path}/segments/run={m['run']}" for m in markers]))
    return (segments.join(manifest, "run")
            .filter(F.col("end").isNull() | (F.col("puzzle_number") < F.col("end")))
            .select("puzzle_number", "difficulty", "rolling_avg"))
