"""Run one registered flow end to end: read, transform, stamp, write, check.

    python -m rillet.plans.run flow_threat /path/to/tables /path/to/out [--format parquet|json|csv]
        [--partition-by col] [--sort-within col] [--as-of '2025-01-01 00:00:00'] [--master local[*]]

With ``--source name=format:path`` (once per source; formats csv, parquet, json, rows, html) the
flow runs on landed files instead of the tables, which then is given as ``-``:

    python -m rillet.plans.run flow_listings - /path/to/out --source listings=csv:/landing/resorts.csv

The output folder is fully replaced; the written row count is compared with a
read-back count (a mismatch raises). Exit code 0 on success.
"""

from __future__ import annotations

import argparse
import sys

from rillet.plans.catalog import QUERIES, load_all
from rillet.plans.landed import run_flow
from rillet.session import build_session, cluster_conf
from rillet.sinks import replace_files, with_processing_time


def main(argv: list[str] | None = None) -> int:
    load_all()
    ap = argparse.ArgumentParser(prog="rillet.plans.run")
    ap.add_argument("query", choices=sorted(QUERIES))
    ap.add_argument("tables")
    ap.add_argument("out")
    ap.add_argument("--format", default="parquet", choices=["parquet", "json", "csv"])
    ap.add_argument("--partition-by", action="append", default=[])
    ap.add_argument("--sort-within", action="append", default=[])
    ap.add_argument("--as-of", default=None, help="fixed processing time instead of the query start")
    ap.add_argument("--source", action="append", default=[], metavar="NAME=FORMAT:PATH")
    ap.add_argument("--master", default=None, help="only where spark-submit does not set it")
    ap.add_argument("--input-bytes", type=int, help="with --cores: sizes splits and shuffle partitions for the cluster")
    ap.add_argument("--cores", type=int)
    args = ap.parse_args(argv)
    sizing = cluster_conf(args.input_bytes, args.cores) if args.input_bytes and args.cores else None
    spark = build_session(args.master, extra=sizing)
    if args.source:
        rows = run_flow(spark, args.query, dict(x.split("=", 1) for x in args.source), args.as_of)
    else:
        rows = QUERIES[args.query](spark, args.tables)
    df = with_processing_time(rows, as_of=args.as_of)
    n = replace_files(df, args.out, fmt=args.format, partition_by=args.partition_by, sort_within=args.sort_within)
    print(f"{args.query}: wrote {n} rows to {args.out}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
