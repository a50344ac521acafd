"""Helpers that several of the operators share."""

from __future__ import annotations

import ctypes
import functools
import itertools
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.session import allow_local_scratch, scratch_path

# Fixed value: what counts as white space in all word contracts.
WORD = r"[^\x20\x09-\x0D]+"


def _marks() -> str:
    """Ranges of the combining marks (Mn, Mc) in the planes that scripts use, for a character class."""
    marks = [c for c in range(0x300, 0x20000) if unicodedata.category(chr(c)) in ("Mn", "Mc")]
    starts = [c for c in marks if unicodedata.category(chr(c - 1)) not in ("Mn", "Mc")]
    ends = [c for c in marks if unicodedata.category(chr(c + 1)) not in ("Mn", "Mc")]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends, strict=True))


MARKS = _marks()
# A word of letters; a mark belongs to the letter before it.
LETTERS = rf"[^\W\d_]+(?:[{MARKS}]+[^\W\d_]*)*"


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as make it differ from every column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh table of the shared folder and read back.

    This cuts the lineage: what reads it later does not run ``df`` again, and a lost
    executor loses none of it.
    """
    spark = df.sparkSession
    allow_local_scratch(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(id_column: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; NULL ids count as the empty text."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % n


def crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of token ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))


def texts_of(column: pa.Array) -> list[str]:
    return ["" if text is None else text for text in column.to_pylist()]


def table_batches(columns: dict[str, list], schema: pa.Schema, rows: int = 4096):
    """Record batches of at most ``rows`` rows."""
    n = len(next(iter(columns.values())))
    for start in range(0, n, rows):
        part = {name: values[start : start + rows] for name, values in columns.items()}
        yield pa.RecordBatch.from_pydict(part, schema=schema)


# What a worker process keeps from task to task, by owner.
_KEPT: dict[str, dict] = {}


def kept_for(owner: str | None) -> dict:
    """What this worker process keeps for ``owner``; what it keeps for others is dropped."""
    for other in [name for name in _KEPT if name != owner]:
        del _KEPT[other]
    return {} if owner is None else _KEPT.setdefault(owner, {})


def hand_back() -> None:
    """Give memory that is free in this process back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
        trim(0)


def tidied(step: Callable[[Iterator], Iterator], owner: str | None = None) -> Callable[[Iterator], Iterator]:
    """``step`` over a task's batches, in a worker process that other stages use next.

    A worker outlives its tasks for a minute, and a few of them stand beside an executor.
    So a task first drops what is kept for others than ``owner``, and at its end hands
    back what it has freed.
    """

    @functools.wraps(step)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_for(owner)
        try:
            yield from step(batches)
        finally:
            hand_back()

    return run


def offsets_of(lengths) -> np.ndarray:
    return np.fromiter(itertools.chain((0,), itertools.accumulate(lengths)), np.int64)
