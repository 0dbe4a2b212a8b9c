"""Command-line jobs (what the reference ran as one notebook job per table).

    python -m postlake land --records PATH [PATH …] --raw RAW [--ds YYYY-MM-DD] [--comments RAW_COMMENTS]
                            [--rejects PATH] [--newest N | --top N] [--comment-limit N]
    python -m postlake run  --raw RAW --out ROOT --from YYYY-MM-DD [--to YYYY-MM-DD] [--scope day|all] [--database NAME]

``land`` normalises API-shaped record files into the raw table (replacing
the run date's partition when ``--ds`` is given, else the fetch dates
present), their nested comments into the raw comments table, and broken
lines into the rejects folder. ``run`` builds bronze, silver and all gold tables for the date
range, one job per layer. Uses the active session, or a local one.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from postlake.plans.backfill import run_range
from postlake.plans.landing import land_files


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from postlake.session import local_session
    return local_session()


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="postlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    land = sub.add_parser("land", help="record files → raw submissions table")
    land.add_argument("--records", nargs="+", required=True)
    land.add_argument("--raw", required=True)
    land.add_argument("--ds")
    land.add_argument("--format", default="json", choices=("json", "parquet"))
    land.add_argument("--comments", help="raw comments table for the records' nested comments")
    land.add_argument("--rejects", help="folder for rejected lines (default: <raw>_rejects)")
    fetched = land.add_mutually_exclusive_group()
    fetched.add_argument("--newest", type=int, help="newest records per subreddit")
    fetched.add_argument("--top", type=int, help="highest-scored records per subreddit")
    land.add_argument("--comment-limit", type=int, help="first comments per submission")
    run = sub.add_parser("run", help="raw → bronze → silver → gold for a date range")
    run.add_argument("--raw", required=True)
    run.add_argument("--out", required=True)
    run.add_argument("--from", dest="ds_from", required=True)
    run.add_argument("--to", dest="ds_to")
    run.add_argument("--scope", choices=("day", "all"), default="day")
    run.add_argument("--database", help="register the written tables in this database")
    args = ap.parse_args(argv)

    spark = _session()
    if args.cmd == "land":
        done = land_files(spark, args.records, args.raw, args.comments,
                          args.rejects or args.raw.rstrip("/") + "_rejects", args.ds, args.format,
                          args.newest, args.top, args.comment_limit)
        result = {"landed": args.raw, "read": done.read, "rows": done.landed, "rejected": done.rejected,
                  "rejected_comments": done.rejected_comments}
    else:
        res = run_range(spark, args.raw, args.out, args.ds_from, args.ds_to or args.ds_from, args.scope,
                        database=args.database)
        result = {"days": [d.isoformat() for d in res.days], "bronze_counts": res.bronze_counts,
                  "tables": res.paths}
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
