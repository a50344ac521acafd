"""Append a glob of CSV files to a managed table, without their bad rows.

    python -m evenkeel.jobs.load_csvs --csv 'hdfs:///data/*.csv' --table sales_csv \\
        --database analytics_db --schema 'id INT, name STRING, amount DOUBLE, category STRING'
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from evenkeel.session import input_size, session, size_shuffles
from evenkeel.sinks.warehouse import append_to_table, create_database
from evenkeel.sources.csv import read_csv_dropping_bad


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    flags = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    flags.add_argument("--csv", required=True, help="file, folder or glob")
    flags.add_argument("--database", required=True)
    flags.add_argument("--table", required=True)
    flags.add_argument("--schema", required=True, help="columns as in CREATE TABLE")
    flags.add_argument("--delimiter", default=",")
    flags.add_argument("--format", default="parquet", help="table format; hive needs --hive")
    flags.add_argument("--hive", action="store_true", help="use the Hive metastore")
    flags.add_argument("--warehouse", help="warehouse folder")
    flags.add_argument("--partitions", type=int, help="fixed partition count, else left to AQE")
    flags.add_argument("--input-bytes", type=int, help="size of the CSV files; their listing's by default")
    flags.add_argument("--escape", default="\\", help="stands before a quote in a quoted cell")
    args = flags.parse_args(argv)

    spark = spark or session("load-csvs", hive=args.hive, warehouse=args.warehouse)
    size_shuffles(spark, args.input_bytes or input_size(spark, args.csv))
    create_database(spark, args.database)
    rows = read_csv_dropping_bad(spark, args.csv, args.schema, args.delimiter, args.partitions, escape=args.escape)
    append_to_table(rows, args.database, args.table, args.format, rebalance=args.partitions is None)
    print(f"appended {args.csv} to {args.database}.{args.table}")


if __name__ == "__main__":
    main()
