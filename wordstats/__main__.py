"""One run from the command line; the exit code says whether it published.

    python -m wordstats --table T --marts M --candidates C.csv [--landing L]
                        [--today YYYY-MM-DD] [--accept-late] [--state S]
                        [--quarantine Q] [--database D]

Scheduling is left to whatever runs jobs on the cluster.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="wordstats", description=__doc__.splitlines()[0])
    p.add_argument("--table", required=True, help="fact table folder (Parquet)")
    p.add_argument("--marts", required=True, help="marts folder")
    p.add_argument("--candidates", required=True, help="candidate CSV (header: word)")
    p.add_argument("--landing", help="landed JSON pages to load first")
    p.add_argument("--today", default="current",
                   help="last date that an increment fetches (default: the current date)")
    p.add_argument("--accept-late", action="store_true", help="load rows dated before the mark")
    p.add_argument("--state", help="folder where counts are kept from run to run")
    p.add_argument("--quarantine", help="folder for refused rows and their reasons")
    p.add_argument("--database", help="catalog database of the published marts")
    p.add_argument("--master", help="Spark master (default: from the environment)")
    args = p.parse_args(argv)

    from wordstats.plans.refresh import RunConfig, read_candidates, run
    from wordstats.session import build_session

    spark = build_session(args.master)
    cfg = RunConfig(table_path=args.table, marts_path=args.marts, landing=args.landing,
                    today=args.today, accept_late=args.accept_late, state_path=args.state,
                    quarantine_path=args.quarantine, database=args.database)
    result = run(spark, cfg, read_candidates(spark, args.candidates))
    failing = [r.asDict() for r in result["report"].filter("failures > 0").collect()]
    print(json.dumps({"load": result["load"], "published": result["published"],
                      "run": result["run"], "failing_checks": failing}, default=str))
    return 0 if result["published"] else 1


if __name__ == "__main__":
    sys.exit(main())
