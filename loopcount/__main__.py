"""Command line of the two jobs: ``python -m loopcount import|profile ...``, or on a cluster

    zip -r loopcount.zip loopcount
    spark-submit --conf spark.checkpoint.dir=hdfs:///shared/loopcount --py-files loopcount.zip \\
        loopcount_job.py import --volumes hdfs:///in/volumes/ --layouts hdfs:///in/layouts.csv \\
        --points hdfs:///in/sites.csv --lines hdfs:///in/roads.csv --output hdfs:///out/observations
    spark-submit ... loopcount_job.py profile --observations hdfs:///out/observations \\
        --output hdfs:///out/dow_profile [--day-of-week Tue]
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import SparkSession

from loopcount.plans import jobs


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="loopcount")
    sub = p.add_subparsers(dest="job", required=True)
    imp = sub.add_parser("import", help="clean and place raw counts, write observations (E1)")
    imp.add_argument("--volumes", required=True, nargs="+", help="raw volume CSV files or folders")
    imp.add_argument("--layouts", required=True, nargs="+", help="site layout CSV files")
    imp.add_argument("--points", required=True, nargs="+", help="site point CSV files (WKT, SITE_NO)")
    imp.add_argument("--lines", nargs="+", help="road line CSV files (WKT, hfidl, hfidr); optional")
    imp.add_argument("--output", required=True, help="observations table path")
    imp.add_argument("--mode", default="merge", choices=["merge", "create"],
                     help="merge into the table by feature id, or create it")
    imp.add_argument("--layouts-by-date", action="store_true", help="take the layout valid on the day of a count, not the first one")
    imp.add_argument("--state", help="profile state table to keep up with the import")
    imp.add_argument("--max-broadcast-bytes", type=int, help="largest lookup to broadcast")
    prof = sub.add_parser("profile", help="average observations by site, weekday and slot (E2)")
    source = prof.add_mutually_exclusive_group(required=True)
    source.add_argument("--observations", help="observations table path")
    source.add_argument("--state", help="profile state table path, instead of the observations")
    prof.add_argument("--output", required=True, help="profile table path")
    prof.add_argument("--day-of-week", nargs="+", help="only these weekdays, e.g. Tue")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName(f"loopcount-{args.job}").getOrCreate()
    start = time.perf_counter()
    if args.job == "import":
        jobs.import_job(spark, args.output, args.volumes, args.layouts, args.points, args.lines,
                        mode=args.mode, max_broadcast_bytes=args.max_broadcast_bytes, state_path=args.state, by_date=args.layouts_by_date)
    elif args.state:
        jobs.state_profile_job(spark, args.state, args.output, day_of_week=args.day_of_week)
    else:
        jobs.profile_job(spark, args.observations, args.output, day_of_week=args.day_of_week)
    print(f"{args.job} finished in {time.perf_counter() - start:.1f} s", file=sys.stderr)
    return 0


if __name__ == "__main__":
    sys.exit(main())
