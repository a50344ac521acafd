"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Shuffle bytes per reduce task to aim at; AQE merges what turns out smaller.
SHUFFLE_PARTITION_BYTES = 200 << 20


def session(
    app_name: str = "evenkeel",
    hive: bool = False,
    warehouse: str | None = None,
    input_bytes: int | None = None,
    **config: str,
) -> SparkSession:
    """Session with adaptive execution on; other settings come from the launcher.

    ``input_bytes`` (both tables together) sets how many shuffle partitions AQE
    starts from. It only ever merges partitions of a join, so the default of 200
    would leave terabytes to each task of a very large one.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if input_bytes is not None:
        partitions = max(200, -(-input_bytes // SHUFFLE_PARTITION_BYTES))
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions)
        )
    if warehouse is not None:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    if hive:
        builder = builder.enableHiveSupport()
    for key, value in config.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def input_size(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files at ``paths`` (files, folders or globs), from their listing."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        place = hadoop.Path(path)
        files = place.getFileSystem(conf)
        for found in files.globStatus(place) or []:
            total += files.getContentSummary(found.getPath()).getLength()
    return total


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Shuffle partitions to start from in this session, as for ``session(input_bytes=...)``."""
    partitions = max(200, -(-input_bytes // SHUFFLE_PARTITION_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))


def allow_local_scratch(spark: SparkSession) -> None:
    """Let a local session without ``spark.checkpoint.dir`` use a temporary folder; for trials and tests."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local["):
        spark.conf.set("spark.evenkeel.local.scratch", "true")


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path in the shared folder that ``spark.checkpoint.dir`` names.

    Without that setting it is an error, but in a local session that allows a temporary
    folder by ``spark.evenkeel.local.scratch=true``.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        allowed = spark.conf.get("spark.evenkeel.local.scratch", "false") == "true"
        if not (allowed and spark.sparkContext.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="evenkeel-")
    return f"{shared.rstrip('/')}/evenkeel-{uuid.uuid4().hex}/{name}"
