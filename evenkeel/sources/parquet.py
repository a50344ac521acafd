"""Parquet reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    """Parquet files as they are split on disk, or shuffled to ``partitions``.

    Leave ``partitions`` unset unless too few or too uneven files hurt: the
    shuffle moves every row that is read.
    """
    paths = [path] if isinstance(path, str) else path
    df = spark.read.parquet(*paths)
    return df if partitions is None else df.repartition(partitions)
