"""Managed tables of the session's catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evenkeel.functions.names import literal, quoted


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database unless it is there; at ``location`` if one is given."""
    place = f" LOCATION {literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{place}")


def append_to_table(
    df: DataFrame, database: str, table: str, table_format: str = "parquet", rebalance: bool = True
) -> None:
    """Append rows by column name to a managed table, creating it at first.

    ``table_format="hive"`` needs a session with Hive support. ``rebalance`` lets
    AQE write files of even size in place of one per input split; it shuffles the
    rows but splits and merges partitions at run time.
    """
    rows = df.hint("rebalance") if rebalance else df
    name = f"{quoted(database)}.{quoted(table)}"
    rows.write.mode("append").format(table_format).saveAsTable(name)
