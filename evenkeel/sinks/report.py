"""Report lines as CSV that Python's ``csv`` module reads back unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_report_csv(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a folder of CSV files, each with a header, in the order of ``lines``.

    Blanks and NULLs become empty cells and quotes are doubled. An empty report
    still has one file with the header.
    """
    (
        lines.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_report_csv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Report written by ``write_report_csv``; empty cells are NULL."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return spark.read.schema(schema).csv(path, header=True, escape='"', multiLine=True)
