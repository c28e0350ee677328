"""Command line: the streaming application, the table inspection, the clear-and-count check and a
dashboard report.

    python -m tickwise stream [--source kafka|files --path DIR]
    python -m tickwise inspect [--database D --table T --table-path P --warehouse-dir W --sample-size N]
    python -m tickwise clear-check [--database D --table T --table-path P]
    python -m tickwise dashboard [--source parquet|kafka]
    python -m tickwise compact --table-path P --target T

Settings come from the environment (blank = unset) and are overridden by flags.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from tickwise.config import Settings, build_session, release_scratch
from tickwise.plans import catalog, dashboard
from tickwise.plans.inspection import inspect, print_report, print_rows


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tickwise")
    sub = p.add_subparsers(dest="command", required=True)
    helps = {"stream": "run the storage and window-statistics queries (Kafka or a folder of JSON lines)",
             "inspect": "report on the stored table (files, schema, counts, time range, rows per symbol)",
             "clear-check": "delete the stored table's files, then count and sample it (destructive)",
             "dashboard": "print the dashboard tables from the stored folder or the topic",
             "compact": "rewrite the stored folder's small files into large time-ordered files elsewhere"}
    for name, text in helps.items():
        s = sub.add_parser(name, help=text, description=text)
        s.add_argument("--database")
        s.add_argument("--table")
        s.add_argument("--table-path")
        s.add_argument("--warehouse-dir")
        s.add_argument("--master")
        s.add_argument("--catalog", choices=["in-memory", "hive"],
                       help="where table definitions live; hive: the metastore the cluster is configured for")
        s.add_argument("--partition-by-day", action="store_true",
                       help="stored table uses day=YYYY-MM-DD partition folders")
        if name == "stream":
            s.add_argument("--source", choices=["kafka", "files"], default="kafka")
            s.add_argument("--path", help="folder of JSON-lines files for --source files")
            s.add_argument("--exactly-once", action="store_true")
            s.add_argument("--live-metadata", action="store_true",
                           help="let edits of the metadata file take effect while the stream runs")
        if name == "inspect":
            s.add_argument("--sample-size", type=int)
        if name == "dashboard":
            s.add_argument("--source", choices=["parquet", "kafka"], default="parquet")
            s.add_argument("--output", help="write each result as a Parquet folder below this path instead of "
                                            "printing its rows")
        if name == "compact":
            s.add_argument("--target", required=True)
            s.add_argument("--rows-per-file", type=int, default=5_000_000)
    return p


def settings_from(args: argparse.Namespace) -> Settings:
    s = Settings.from_env()
    overrides = {"database": args.database, "table": args.table, "output_path": args.table_path,
                 "warehouse_dir": args.warehouse_dir, "sample_size": getattr(args, "sample_size", None),
                 "partition_by_day": args.partition_by_day or None, "catalog": args.catalog}
    return replace(s, **{k: v for k, v in overrides.items() if v is not None})


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    settings = settings_from(args)
    spark = build_session(f"tickwise-{args.command}", master=args.master, settings=settings)
    try:
        if args.command == "stream":
            from tickwise.streaming.app import run_forever
            run_forever(spark, settings, source=args.source, path=args.path, exactly_once=args.exactly_once,
                        live_metadata=args.live_metadata)
        elif args.command == "inspect":
            print(f"--- database\n{settings.database}")
            print_report(inspect(spark, settings))
        elif args.command == "clear-check":
            name = catalog.register_table(spark, settings.database, settings.table, settings.output_path,
                                          replace=False, partition_by_day=settings.partition_by_day)
            print_rows("databases", catalog.show_databases(spark))
            print_rows("tables", catalog.show_tables(spark, settings.database))
            deleted = catalog.clear_location(spark, settings.output_path, name)
            print(f"Deleted {deleted} entries under {settings.output_path}")
            print_rows("stored ticks", spark.sql(f"SELECT COUNT(*) AS record_count FROM {name}"))
            print_rows("ten of them", spark.sql(f"SELECT * FROM {name} LIMIT 10"))
        elif args.command == "dashboard":
            frames = (dashboard.from_parquet(spark, settings) if args.source == "parquet"
                      else dashboard.from_topic(spark, settings))
            for name in ("latest", "analytics", "trends", "grid", "symbols"):
                df = getattr(frames, name)
                if args.output:
                    df.write.mode("overwrite").parquet(f"{args.output.rstrip('/')}/{name}")
                else:
                    print_rows(name, df)
        elif args.command == "compact":
            out = catalog.compact(spark, settings.output_path, args.target, args.rows_per_file,
                                  partition_by_day=settings.partition_by_day)
            print(f"compacted into {len(out.inputFiles())} files at {args.target}")
    finally:
        if args.command != "stream":
            release_scratch(spark)
        spark.stop()
    return 0
