"""Readers: CSV, Parquet, JDBC tables and SQLite files."""

from evenkeel.sources.combine import combine_csv, csv_by_header
from evenkeel.sources.csv import (
    read_csv_dropping_bad,
    read_csv_inferred,
    read_csv_strict,
    read_csv_typed,
)
from evenkeel.sources.jdbc import jdbc_table
from evenkeel.sources.parquet import read_parquet
from evenkeel.sources.sqlite import sqlite_table

__all__ = [
    "combine_csv",
    "csv_by_header",
    "jdbc_table",
    "read_csv_dropping_bad",
    "read_csv_inferred",
    "read_csv_strict",
    "read_csv_typed",
    "read_parquet",
    "sqlite_table",
]
