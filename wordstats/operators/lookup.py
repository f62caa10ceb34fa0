"""Size-checked lookups against small derived tables.

The frequency tables are aggregates with one row per distinct letter (or
per position and letter).  For words over an alphabet that is a few
hundred rows, but nothing in the data model forbids arbitrary characters,
so nothing is broadcast by a hint:

* ``materialise`` writes the small table once as Parquet under the shared
  checkpoint directory (reliable: it survives executor loss, and the heavy
  pass that produced it is not repeated by every consumer) and counts it
  there;
* the lookups (``scoring.lookup_letters``) join the stored table without a
  hint: Spark knows its size in bytes, broadcasts it below its threshold and
  otherwise shuffles on the key, re-planned by AQE.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wordstats.session import scratch_dir

@dataclass(frozen=True)
class Materialised:
    df: DataFrame
    rows: int


def _write(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    # Read back with the schema just written: no footer-inference job.
    return spark.read.schema(df.schema).parquet(path)


def store(df: DataFrame, name: str = "stored") -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint directory and
    return the stored copy: lineage is cut, one job computes it (a plain
    ``checkpoint`` of an uncached plan computes it twice), and readers get
    column pruning and pushed filters."""
    return _write(df, name)


def materialise(df: DataFrame) -> Materialised:
    """Store ``df``; its row count is observed by the writing job itself."""
    seen = Observation("rows")
    done = _write(df.observe(seen, F.count(F.lit(1)).alias("rows")), "lookup")
    return Materialised(done, int(seen.get["rows"]))
