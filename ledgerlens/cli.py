"""Command line: run a SQL script into a table, or load delimited files.

    python -m ledgerlens run-script --source-db sales --script q.sql \\
        --target sales.result --log run.log
    python -m ledgerlens load --folder /data/in --names Sales.SalesTerritory \\
        --database sales --log load.log
    python -m ledgerlens report monthly_status_report --tables /data/tables \\
        --csv /data/out/monthly_status_report

The session comes from ``SparkSession.builder.getOrCreate()`` (spark-submit
or the cluster's defaults decide master and resources); ``--local`` starts a
local one for trying things out.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session(local: bool) -> SparkSession:
    from ledgerlens.session import configure, get_session
    if local:
        return get_session()
    return configure(SparkSession.builder.appName("ledgerlens").getOrCreate())


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerlens")
    parser.add_argument("--local", action="store_true", help="start a local session")
    sub = parser.add_subparsers(dest="command", required=True)

    run = sub.add_parser("run-script", help="run a SQL script file into a target table")
    run.add_argument("--source-db", help="database the script reads (default: current)")
    run.add_argument("--script", required=True, help="file with one Spark SQL statement")
    run.add_argument("--target", required=True, help="table to create or replace")
    run.add_argument("--log", help="text log file")
    run.add_argument("--log-table", help="catalog table receiving the run log rows")

    load = sub.add_parser("load", help="load delimited files into catalog tables")
    load.add_argument("--folder", required=True)
    load.add_argument("--names", required=True, nargs="+", help="file names without .csv")
    load.add_argument("--database")
    load.add_argument("--tolerant", action="store_true", help="bad dates become NULL")
    load.add_argument("--log", help="text log file")
    load.add_argument("--log-table")

    rep = sub.add_parser("report", help="run a registered report and write it as CSV")
    rep.add_argument("name", help="report name (see __spark_entry__.queries())")
    rep.add_argument("--tables", required=True, help="folder with the Parquet tables")
    rep.add_argument("--csv", required=True, help="output folder (header line, sorted)")

    args = parser.parse_args(argv)
    spark = _session(args.local)
    if args.command == "run-script":
        from ledgerlens.sources.scripts import run_script
        out = run_script(spark, args.script, args.target, log_path=args.log,
                         log_table=args.log_table, source_database=args.source_db)
        print(json.dumps({"target": args.target, "columns": out.columns}))
        return 0
    if args.command == "report":
        from ledgerlens.plans.registry import QUERIES
        from ledgerlens.sources.files import write_csv
        df = QUERIES[args.name](spark, args.tables)
        write_csv(df, args.csv, sort_by=df.columns)
        print(json.dumps({"report": args.name, "csv": args.csv, "columns": df.columns}))
        return 0
    from ledgerlens.sources.csv_loader import load_tables
    from ledgerlens.sources.runlog import RunLog
    log = RunLog(spark, args.log_table, args.log)
    try:
        results = load_tables(spark, args.folder, args.names, database=args.database, log=log,
                              tolerant=args.tolerant)
    finally:
        log.close()
    print(json.dumps(results))
    return 0 if all(r["status"] == "ok" for r in results) else 1


if __name__ == "__main__":
    sys.exit(main())
