"""Reconcile a CSV source with a SQLite or JDBC table and write the report.

    python -m evenkeel.jobs.reconcile --source-file source.csv --sqlite-db target.db \\
        --table target_table --key-columns id --compare-columns amount,date

The report is a folder of CSV files. Passwords are read from the environment
variable that ``--password-env`` names, never from the command line.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from evenkeel.functions.names import parse_list
from evenkeel.plans.reconcile import Reconciliation, check_absent, reconcile
from evenkeel.session import input_size, session, size_shuffles
from evenkeel.sinks.jdbc import load_target
from evenkeel.sinks.staged import load_exactly_once
from evenkeel.sources.csv import read_csv_strict
from evenkeel.sources.jdbc import jdbc_table, named_as, range_column
from evenkeel.sources.sqlite import sqlite_table


# The names of the flags that existing scripts give.
def parser() -> argparse.ArgumentParser:
    flags = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    flags.add_argument("--source-file", required=True, help="CSV file, folder or glob")
    flags.add_argument("--delimiter", default=",", help="delimiter of the CSV")
    flags.add_argument("--one-line-rows", action="store_true", help="no cell holds a line break: split large CSV files")
    flags.add_argument("--table", "--oracle-table", required=True, help="target table")
    flags.add_argument("--key-columns", required=True, help="comma-separated keys on both sides")
    flags.add_argument("--compare-columns", help="comma-separated; all non-key source columns if blank")
    flags.add_argument("--report-file", default="reconciliation_report", help="report folder")
    flags.add_argument("--keep-report", action="store_true", help="fail if the report folder exists; it is replaced by default")
    flags.add_argument("--where", help="condition on target rows: SQLite's SQL there, else Spark SQL")
    flags.add_argument("--debug", action="store_true", help="print the physical plan")

    flags.add_argument("--sqlite-db", help="SQLite file that all executors can open")

    flags.add_argument("--jdbc-url", help="JDBC URL of the target database")
    flags.add_argument("--oracle-dsn", help="host:port/service, in place of --jdbc-url")
    flags.add_argument("--user", "--oracle-user", help="database user")
    flags.add_argument("--password-env", help="environment variable with the password")
    flags.add_argument("--partition-column", help="number, date or timestamp column to split reads by")
    flags.add_argument("--predicate", action="append", help="condition of one parallel read; repeat until all rows are covered once")
    flags.add_argument("--single-read", action="store_true", help="read the table in one task")
    flags.add_argument("--partitions", type=int, default=16, help="parallel reads of the table")
    flags.add_argument("--connections", type=int, default=16, help="parallel writers of --load-target")
    flags.add_argument("--input-bytes", type=int, help="size of both sides; twice the CSV's by default")
    flags.add_argument("--load-target", action="store_true", help="insert the source rows first")
    flags.add_argument("--truncate-target", action="store_true", help="empty the table before that")
    flags.add_argument("--direct-load", action="store_true", help="insert without a staging table; a task that runs again may double rows")
    flags.add_argument("--target-label", help="name of the target in the report")
    flags.add_argument("--decimals", default=None, help="text of decimals: plain, stripped, float or oracle")
    return flags


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> dict[str, int]:
    flags = parser()
    args = flags.parse_args(argv)
    if (args.sqlite_db is None) == (args.jdbc_url is None and args.oracle_dsn is None):
        flags.error("give either --sqlite-db or one of --jdbc-url and --oracle-dsn")
    if args.sqlite_db is not None and (args.load_target or args.truncate_target):
        flags.error("--load-target and --truncate-target need a JDBC target")

    spark = spark or session("reconcile")
    size_shuffles(spark, args.input_bytes or 2 * input_size(spark, args.source_file))
    if args.keep_report:
        check_absent(spark, args.report_file)
    result = plan(spark, args)
    if args.debug:
        result.report().explain("formatted")
    summary = result.write(args.report_file, mode="errorifexists" if args.keep_report else "overwrite")
    print("Both sides compared.")
    for name, count in summary.items():
        print(f"{name}: {count}")
    print(f"report: {args.report_file}")
    return summary


def plan(spark: SparkSession, args: argparse.Namespace) -> Reconciliation:
    """Read both sides, after the target load if one is asked for."""
    keys = parse_list(args.key_columns)
    compare = parse_list(args.compare_columns) if args.compare_columns else None
    used = None if compare is None else [*keys, *compare]
    source = read_csv_strict(spark, args.source_file, args.delimiter, used, not args.one_line_rows, trim=False)
    if args.sqlite_db is not None:
        # A Python source is not pruned by Spark: it is told which columns to read.
        present = sqlite_table(spark, args.sqlite_db, args.table).columns
        needed = [name for name in present if name in set(source.columns)]
        target = sqlite_table(spark, args.sqlite_db, args.table, columns=needed, where=args.where)
        return reconcile(source, target, keys, compare, target_label=args.target_label or "target")

    url = args.jdbc_url or f"jdbc:oracle:thin:@//{args.oracle_dsn}"
    properties = _credentials(args)
    if args.load_target:
        load = load_target if args.direct_load else load_exactly_once
        load(
            source,
            url,
            args.table,
            keys,
            compare,
            args.truncate_target,
            connections=args.connections,
            properties=properties,
        )
    split_by = args.partition_column
    if split_by is None and not args.predicate and not args.single_read:
        split_by = range_column(spark, url, args.table, keys, properties)
        if split_by is None:
            raise ValueError("no key splits the read: give --partition-column, --predicate or --single-read")
    target = jdbc_table(
        spark,
        url,
        args.table,
        partition_column=split_by,
        partitions=args.partitions,
        predicates=args.predicate,
        properties=properties,
    )
    target = named_as(target, source.columns)
    label = args.target_label or ("oracle" if args.oracle_dsn else "target")
    decimals = args.decimals or ("oracle" if args.oracle_dsn else "plain")
    return reconcile(source, target, keys, compare, args.where, label, decimals)


def _credentials(args: argparse.Namespace) -> dict[str, str]:
    properties = {}
    if args.user:
        properties["user"] = args.user
    if args.password_env:
        properties["password"] = os.environ[args.password_env]
    return properties


if __name__ == "__main__":
    main()
