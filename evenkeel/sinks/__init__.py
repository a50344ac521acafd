"""Writers: report CSV, warehouse tables, database tables, per-file output."""

from evenkeel.sinks.files import write_converted, write_per_file
from evenkeel.sinks.jdbc import LoadError, load_target
from evenkeel.sinks.report import read_report_csv, write_report_csv
from evenkeel.sinks.staged import load_exactly_once
from evenkeel.sinks.warehouse import append_to_table, create_database

__all__ = [
    "LoadError",
    "append_to_table",
    "create_database",
    "load_exactly_once",
    "load_target",
    "read_report_csv",
    "write_converted",
    "write_per_file",
    "write_report_csv",
]
