"""Batch and streaming jobs, one sub-command per pipeline step.

    spark-submit --py-files rainrisk.zip rainrisk/jobs.py <command> [options]
    python -m rainrisk.jobs <command> [options]                      (local)

  plan          pages still to fetch (backfill plan) → Parquet
  load          validate and load landed raw data into bronze (one year or all)
  load-files    the same for flat ``<Region>_<yyyy>.parquet`` files
  build         full silver and gold rebuild from bronze
  refresh       recompute one year of silver (daily), then gold
  feed-land     15-minute feed: payload files → partitioned Parquet (stream)
  feed-latest   latest reading per station from the landed feed (stream)

Each job reads and writes paths in shared storage; nothing is collected to
the driver except the small reports printed at the end.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

if __package__ in (None, ""):  # run as a file by spark-submit: make the package importable
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("rainrisk").getOrCreate()
    from rainrisk.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return spark


def _municipalities(spark: SparkSession, path: str):
    return spark.read.parquet(path).select("codigo_ibge", "municipio", "latitude", "longitude")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="rainrisk.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)

    a = sub.add_parser("plan")
    a.add_argument("--bronze", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())

    for name in ("load", "load-files"):
        a = sub.add_parser(name)
        a.add_argument("--raw", required=True)
        a.add_argument("--bronze", required=True)
        a.add_argument("--year", type=int)
        a.add_argument("--report", help="write the per-unit report here")
        a.add_argument("--accept-failures", action="store_true",
                       help="load what is sound although some units are not")

    a = sub.add_parser("build")
    a.add_argument("--bronze", required=True)
    a.add_argument("--municipalities", required=True)
    a.add_argument("--silver", required=True)
    a.add_argument("--gold", required=True)

    a = sub.add_parser("refresh")
    a.add_argument("--bronze", required=True)
    a.add_argument("--municipalities", required=True)
    a.add_argument("--silver", required=True)
    a.add_argument("--gold", required=True)
    a.add_argument("--state", required=True)
    a.add_argument("--year", type=int, default=dt.date.today().year)

    a = sub.add_parser("feed-land")
    a.add_argument("--payload", required=True)
    a.add_argument("--landed", required=True)
    a.add_argument("--checkpoint", required=True)
    a.add_argument("--json-lines", action="store_true", help="files of JSON lines instead of one array each")
    a.add_argument("--rejects", help="side folder for what cannot land (default: beside --landed)")
    a.add_argument("--max-rejects", type=int, help="with --once: fail beyond so many of them")
    a.add_argument("--once", action="store_true", help="availableNow instead of every 15 min")

    a = sub.add_parser("feed-latest")
    a.add_argument("--landed", required=True)
    a.add_argument("--snapshot", required=True)
    a.add_argument("--checkpoint", required=True)
    a.add_argument("--once", action="store_true")

    args = p.parse_args(argv)
    spark = _session()
    from rainrisk.plans import flows
    from rainrisk.streaming import feed_stream as S

    if args.cmd == "plan":
        flows.pages_to_fetch(spark, args.bronze, args.as_of) \
            .write.mode("overwrite").parquet(args.out)
    elif args.cmd in ("load", "load-files"):
        if args.cmd == "load":
            report = flows.daily_load(spark, args.raw, args.bronze, year=args.year,
                                      raise_on_failure=not args.accept_failures)
        else:
            report = flows.daily_load_files(spark, args.raw, args.bronze, year=args.year,
                                            raise_on_failure=not args.accept_failures)
        if args.report:
            report.write.mode("overwrite").parquet(args.report)
        report.groupBy("status").count().show(truncate=False)
    elif args.cmd == "build":
        flows.build_silver_gold(spark, args.bronze, _municipalities(spark, args.municipalities),
                                args.silver, args.gold).show(truncate=False)
    elif args.cmd == "refresh":
        flows.refresh_silver_year(spark, args.bronze, _municipalities(spark, args.municipalities),
                                  args.silver, args.gold, args.year,
                                  state_path=args.state).show(truncate=False)
    elif args.cmd == "feed-land":
        side = args.rejects or f"{args.landed.rstrip('/')}-rejects"
        q = S.land_feed(spark, args.payload, args.landed, args.checkpoint, side,
                        json_array=not args.json_lines, available_now=args.once)
        S.run_available_now(q)
        print("readings and files that could not land:", S.check_rejects(spark, side, args.max_rejects))
    elif args.cmd == "feed-latest":
        q = S.latest_snapshot_stream(spark, args.landed, args.snapshot, args.checkpoint,
                                     available_now=args.once)
        S.run_available_now(q)
    return 0


if __name__ == "__main__":
    sys.exit(main())
