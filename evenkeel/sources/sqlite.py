"""Table of SQLite files, read in parallel through a Python data source.

The files must lie where every executor can open them (a shared mount). Values
arrive as the text Python prints for them, which is the text the comparison uses:
SQLite types belong to values, not to columns, so no column type would do.
"""

from __future__ import annotations

import glob
import heapq
import json
import os
import sqlite3
import sys
from collections.abc import Iterator, Sequence
from contextlib import closing
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "evenkeel_sqlite"
BATCH_ROWS = 8192
# Bytes of a database file per read task, as far as its rowids allow.
BYTES_PER_RANGE = 64 << 20


def sqlite_table(
    spark: SparkSession,
    path: str,
    table: str,
    columns: Sequence[str] | None = None,
    where: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Columns of a table as text, NULL where SQLite has NULL.

    ``path`` is a database file or a glob of files that all hold the table.
    ``where`` is a condition in SQLite's own dialect and runs inside SQLite on a
    read-only connection. Each file is read in ``ranges`` slices of rowid (one
    per 64 MB by default); views and tables without rowid are read in one.
    """
    files = _files(path)
    with closing(_open(files[0])) as db:
        present = _table_columns(db, table)
    names = present if columns is None else list(dict.fromkeys(columns))
    absent = [name for name in names if name not in present]
    if absent:
        raise ValueError(f"SQLite table {table} lacks columns: {absent}")
    # Executors need not have this package installed.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(SqliteSource)
    reader = spark.read.format(FORMAT).option("files", json.dumps(files)).option("table", table)
    if where is not None:
        reader = reader.option("where", where)
    if ranges is not None:
        reader = reader.option("ranges", ranges)
    return reader.schema(T.StructType([T.StructField(name, T.StringType()) for name in names])).load()


class SqliteSource(DataSource):
    """Batch source over rowid ranges of SQLite files."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: T.StructType) -> SqliteReader:
        return SqliteReader(self.options, schema)


class RowidRange(InputPartition):
    """Rows of one file with ``first <= rowid <= last``; all rows if ``rowid`` is None."""

    def __init__(self, file: str, rowid: str | None, first: int, last: int) -> None:
        self.file = file
        self.rowid = rowid
        self.first = first
        self.last = last


class SqliteReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType) -> None:
        self.files = json.loads(options["files"])
        self.table = options["table"]
        self.where = options.get("where")
        self.ranges = int(options["ranges"]) if "ranges" in options else None
        self.columns = schema.fieldNames()

    def partitions(self) -> list[RowidRange]:
        parts = []
        for file in self.files:
            wanted = self.ranges or -(-os.path.getsize(file) // BYTES_PER_RANGE)
            with closing(_open(file)) as db:
                parts += _ranges(db, file, self.table, wanted)
        return parts

    def read(self, partition: RowidRange) -> Iterator[pa.RecordBatch]:
        names = ", ".join(_quoted(name) for name in self.columns) or "NULL"
        query = f"SELECT {names} FROM {_quoted(self.table)}"
        conditions = [f"({self.where}\n)"] if self.where else []
        arguments: tuple[int, ...] = ()
        if partition.rowid is not None:
            conditions.append(f"{partition.rowid} BETWEEN ? AND ?")
            arguments = (partition.first, partition.last)
        if conditions:
            query += " WHERE " + " AND ".join(conditions)
        schema = pa.schema([(name, pa.string()) for name in self.columns])
        with closing(_open(partition.file)) as db, closing(db.execute(query, arguments)) as cursor:
            while rows := cursor.fetchmany(BATCH_ROWS):
                arrays = [pa.array(map(_text, cells), pa.string()) for cells in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays[: len(schema)], schema=schema)


def _text(value: object) -> str | None:
    return value if value is None or isinstance(value, str) else str(value)


def _files(path: str) -> list[str]:
    scheme, separator, rest = path.partition(":")
    local = path
    if separator and len(scheme) > 1:
        if scheme != "file":
            raise ValueError(f"SQLite needs a mounted file system, not {path}")
        local = unquote("/" + rest.lstrip("/"))
    files = [local] if os.path.isfile(local) else sorted(glob.glob(local))
    if not files:
        raise FileNotFoundError(f"SQLite database not found: {path}")
    return files


def _open(file: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{quote(file)}?mode=ro", uri=True)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _table_columns(db: sqlite3.Connection, table: str) -> list[str]:
    names = [row[1] for row in db.execute(f"PRAGMA table_info({_quoted(table)})")]
    if not names:
        raise ValueError(f"SQLite table not found or without columns: {table}")
    return names


def _ranges(db: sqlite3.Connection, file: str, table: str, wanted: int) -> list[RowidRange]:
    rowid = _rowid_name(db, table)
    if rowid is None:
        return [RowidRange(file, None, 0, 0)]
    rows = f"FROM {_quoted(table)}"

    def end(function: str, condition: str = "true") -> int | None:
        # one end per query: SQLite looks up a lone min or max in the index
        return db.execute(f"SELECT {function}({rowid}) {rows} WHERE {condition}").fetchone()[0]

    if end("min") is None:
        return [RowidRange(file, rowid, 0, -1)]
    # Cut the widest range in two and shrink both halves to the rowids they
    # hold, so that gaps in the numbers do not leave all rows to one task.
    spans = [_span(end("min"), end("max"))]
    while len(spans) < wanted:
        _, low, high = spans[0]
        if low == high:
            break
        middle = low + (high - low) // 2
        heapq.heapreplace(spans, _span(low, end("max", f"{rowid} <= {middle}")))
        heapq.heappush(spans, _span(end("min", f"{rowid} > {middle}"), high))
    return [RowidRange(file, rowid, low, high) for _, low, high in spans]


def _span(low: int, high: int) -> tuple[int, int, int]:
    """Heap entry that puts the widest range first."""
    return low - high, low, high


def _rowid_name(db: sqlite3.Connection, table: str) -> str | None:
    """Name by which the table's rowid can be reached, if it has one."""
    (kind,) = db.execute(
        "SELECT type FROM sqlite_master WHERE lower(name) = lower(?) AND type IN ('table', 'view')",
        (table,),
    ).fetchone() or ("view",)
    if kind != "table":
        return None
    taken = {name.lower() for name in _table_columns(db, table)}
    for name in ("rowid", "_rowid_", "oid"):
        if name not in taken:
            try:
                db.execute(f"SELECT {name} FROM {_quoted(table)} LIMIT 0")
            except sqlite3.OperationalError:
                return None
            return name
    return None
