"""Benchmark the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

All queries run once as a warm-up pass, then each runs ``BENCH_RUNS``
timed times; the median is reported.  A run executes the whole plan into the ``noop`` sink
(every row and column produced, nothing collected).  ``value`` is the sum
of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "top_predictions",
    "word_scores",
    "answer_history",
    "letter_frequency",
    "position_frequency",
    "difficulty_by_pattern",
    "difficulty_trend",
    "quality_report",
    "ingest_incremental",
    "corpus_letter_frequency",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from wordstats.plans.catalog import QUERIES
    from wordstats.session import build_session

    spark = build_session(f"local[{cpus}]", cpus)
    names = [n for n in HEADLINE if n in QUERIES]

    def once(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:      # warm-up pass: JIT and caches settle before timing
        once(name)
    times = {name: round(statistics.median(once(name) for _ in range(runs)), 3)
             for name in names}
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
        "runs": runs,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
