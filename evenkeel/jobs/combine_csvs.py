"""Combine CSV files, each under a tag made from its name, or convert one file.

    python -m evenkeel.jobs.combine_csvs --csv 'data/*.csv' --output combined
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from evenkeel.session import input_size, session, size_shuffles
from evenkeel.sinks.files import write_per_file
from evenkeel.sources.combine import csv_by_header


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    flags = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    flags.add_argument("--csv", required=True, help="file, folder or glob")
    flags.add_argument("--output", required=True, help="folder; one sub-folder per file")
    flags.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    flags.add_argument("--delimiter", default=",")
    flags.add_argument("--text", action="store_true", help="keep all columns as text")
    flags.add_argument("--same-header", action="store_true", help="all files share one header")
    flags.add_argument("--tag-length", type=int, help="cut tags to so many characters")
    args = flags.parse_args(argv)

    spark = spark or session("combine-csvs")
    size_shuffles(spark, input_size(spark, args.csv))
    groups = csv_by_header(spark, args.csv, args.delimiter, not args.text, args.same_header, args.tag_length)
    write_per_file(groups, args.output, args.format, tag_length=args.tag_length)
    print(f"combined {args.csv} in {args.output}")


if __name__ == "__main__":
    main()
