"""Run metric definitions from the command line (e.g. under spark-submit).

    python -m metricstore --definitions metrics.yaml --sql-dir sql \\
        --view events=s3://bucket/events \\
        --store s3://bucket/metrics --dt-start "2024-01-05 00:00:00" --dt-end "2024-01-06 00:00:00"

Under spark-submit, submit a script that calls ``metricstore.__main__.main()``
with the package shipped by ``--py-files``.

The session comes from the submitting environment (``getOrCreate``); all
definitions run through one ``run_all``; the run report is printed and, with
``--report``, appended as Parquet.  The exit code is 1 if any stage failed.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="metricstore", description=__doc__.splitlines()[0])
    p.add_argument("--definitions", required=True, help="YAML file with one or more metric definitions")
    p.add_argument("--sql-dir", help="folder holding the files named by sql_query")
    p.add_argument("--store", help="store folder (ORC, partitioned)")
    p.add_argument("--table", help="central catalog table to append records to")
    p.add_argument("--store-format", default="orc", choices=("orc", "parquet"))
    p.add_argument("--mode", default="append", choices=("append", "overwrite_partitions"))
    p.add_argument("--dt-start", help="start of the run's time range, bound as :dt_start")
    p.add_argument("--dt-end", help="end of the run's time range (exclusive), bound as :dt_end")
    p.add_argument("--run-log", action="store_true", help="commit runs in a log beside the store; only committed runs count")
    p.add_argument("--lookback", type=int, metavar="SECONDS",
                   help="compute only the buckets of [dt-start, dt-end) that are missing or whose data may still come")
    p.add_argument("--cache-database", default="cache")
    p.add_argument("--report", help="folder to append the run report to (Parquet)")
    p.add_argument("--strict", action="store_true", help="fail on null or unconvertible val/measure_time")
    p.add_argument(
        "--view", action="append", default=[], metavar="NAME=PATH[@FORMAT]",
        help="register files as a temp view before the run (format defaults to parquet); repeatable",
    )
    return p.parse_args(argv)


def register_views(spark, specs) -> None:
    for spec in specs:
        name, sep, target = spec.partition("=")
        if not sep or not name or not target:
            raise SystemExit(f"--view expects NAME=PATH[@FORMAT], got {spec!r}")
        path, _, fmt = target.partition("@")
        spark.read.format(fmt or "parquet").load(path).createOrReplaceTempView(name)


def main(argv=None, spark=None) -> int:
    from pyspark.sql import SparkSession

    from metricstore.plans.incremental import run_incremental
    from metricstore.plans.runner import Runner
    from metricstore.plans.spec import load_definitions, sql_folder_loader
    from metricstore.sources.sql import time_range_params

    args = parse_args(argv)
    if not args.store and not args.table:
        raise SystemExit("give --store and/or --table")
    with open(args.definitions, encoding="utf-8") as handle:
        loader = sql_folder_loader(args.sql_dir) if args.sql_dir else None
        specs = load_definitions(handle.read(), sql_loader=loader)
    spark = spark or SparkSession.builder.appName("metricstore").getOrCreate()
    register_views(spark, args.view)
    runner = Runner(
        spark,
        store_path=args.store,
        table=args.table,
        store_format=args.store_format,
        mode=args.mode,
        params=time_range_params(args.dt_start, args.dt_end),
        cache_database=args.cache_database,
        strict=args.strict,
        run_log=args.run_log or None,
    )
    if args.lookback is None:
        result = runner.run_all(specs)
    else:
        if not (args.store and args.dt_start and args.dt_end):
            raise SystemExit("--lookback needs --store, --dt-start and --dt-end")
        result = run_incremental(runner, specs, datetime.fromisoformat(args.dt_start), datetime.fromisoformat(args.dt_end),
                                 lookback=args.lookback)
    report = result.report(spark)
    report.show(len(result.outcomes), truncate=120)
    if args.report:
        report.write.mode("append").parquet(args.report)
    return 0 if result.ok else 1


if __name__ == "__main__":
    sys.exit(main())
