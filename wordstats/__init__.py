"""wordstats: letter and position statistics over fixed-length words, on Spark.

Every public operator is a lazy ``DataFrame -> DataFrame`` function built
from ``pyspark.sql.functions`` built-ins. The packages are:

* ``wordstats.functions``  column expressions (letters, rounding, buckets)
* ``wordstats.sources``    readers: landed JSON pages, seed CSV, fact table,
                           and the adapters that derive word data from the
                           test corpus
* ``wordstats.operators``  staging, frequencies, scoring, history, reports,
                           data-quality checks, batch labelling for loads
* ``wordstats.plans``      the end-to-end run and mart materialisation
* ``wordstats.streaming``  the Structured Streaming form of the load
"""

from wordstats.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
