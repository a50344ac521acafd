"""File outputs of the CSV jobs."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.sources.combine import FILE, SHEET


def write_per_file(
    groups: Iterable[DataFrame],
    path: str,
    table_format: str = "parquet",
    mode: str = "errorifexists",
    tag_length: int | None = None,
) -> None:
    """Write tables of ``csv_by_header`` to one ``sheet_name=...`` folder per file.

    Each folder has the columns of its own file only. Two files with the same
    sheet name are an error, raised before anything is written; ``tag_length`` is
    the one that ``csv_by_header`` was given.
    """
    files = getattr(groups, "files", None)
    groups = list(groups)
    if files is None and groups:
        each = [group.select(F.col(FILE).alias("file"), SHEET).distinct() for group in groups]
        files = reduce(DataFrame.unionAll, each)
    if files is not None:
        _check_sheets(files)
    for position, group in enumerate(groups):
        (
            group.drop(FILE)
            .write.mode(mode if position == 0 else "append")
            .partitionBy(SHEET)
            .option("header", True)
            .option("escape", '"')
            .format(table_format)
            .save(path)
        )


def write_converted(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write one table as Parquet."""
    df.write.mode(mode).parquet(path)


def _check_sheets(files: DataFrame) -> None:
    """``files`` are (file, sheet_name)."""
    shared = files.groupBy(SHEET).agg(F.min("file").alias("one"), F.max("file").alias("other")).where("one <> other").first()
    if shared is not None:
        raise ValueError(f"{shared.one} and {shared.other} share the sheet name {shared[SHEET]!r}")
