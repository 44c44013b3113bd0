"""Job entry points (``spark-submit`` or ``python -m clipstat``).

  transform RAW OUT [--as-of YYYY-MM-DD]   landed JSON -> processed tables (B1), prints the load report
  analyze OUT [--by channel_id] [--keywords "how to,guide"] [--days N --as-of D]
                                           analysis + chart marts under OUT/marts (B2, B3)
  ingest LANDING TABLE                     append newly landed comment snapshots (streaming, available-now)

The session comes from the cluster (``getOrCreate``); with ``--input-gb`` its
partition sizes follow the input.  Nothing is collected but the load report, the
counts of skipped files and the list of written marts.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from clipstat.functions.dims import DEFAULT_KEYWORDS
from clipstat.plans.marts import chart_tables, write_marts
from clipstat.plans.transform import read_tables, transform_and_save
from clipstat.session import cluster_conf, use_utc
from clipstat.streaming.landing import start_comment_ingest


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="clipstat")
    p.add_argument("--input-gb", type=float, default=None, help="size of the input, to size partitions for it")
    p.add_argument("--cores", type=int, default=None, help="cores of the cluster (default: Spark's parallelism)")
    sub = p.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("transform")
    t.add_argument("raw")
    t.add_argument("out")
    t.add_argument("--as-of", default=None)
    t.add_argument("--skip-damaged", action="store_true", help="leave files that don't parse out, and report them")
    a = sub.add_parser("analyze")
    a.add_argument("out")
    a.add_argument("--by", default="", help="comma-separated group keys, e.g. channel_id")
    a.add_argument("--keywords", default=",".join(DEFAULT_KEYWORDS))
    a.add_argument("--days", type=int, default=None, help="only videos published in the last N days")
    a.add_argument("--as-of", default=None, help="reference day for --days (default: today)")
    s = sub.add_parser("ingest")
    s.add_argument("landing")
    s.add_argument("table")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"clipstat-{args.cmd}").getOrCreate()
    use_utc(spark)
    if args.input_gb is not None:
        cores = args.cores or spark.sparkContext.defaultParallelism
        for k, v in cluster_conf(int(args.input_gb * 1e9), cores).items():
            if k.startswith("spark.sql."):
                spark.conf.set(k, v)
    if args.cmd == "transform":
        skipped: dict[str, dict[str, int]] = {}
        report = transform_and_save(spark, args.raw, args.out, as_of=args.as_of, skip_damaged=args.skip_damaged, skipped=skipped)
        for row in report.collect():
            print(json.dumps(row.asDict()))
        for kind, counts in skipped.items():
            print(json.dumps({"kind": kind, **counts}))
    elif args.cmd == "analyze":
        channel, videos, comments = read_tables(spark, args.out)
        by = [b for b in args.by.split(",") if b]
        keywords = [k for k in args.keywords.split(",") if k]
        tables = chart_tables(channel, videos, comments, keywords, by, recent_days=args.days, as_of=args.as_of)
        paths = write_marts(tables, args.out)
        print(json.dumps({"marts": paths}))
    else:
        start_comment_ingest(spark, args.landing, args.table).awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
