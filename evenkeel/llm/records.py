"""Token ids as length-delimited binary records with a separate offset index.

A dataset is a folder of shards. Shard ``part-00007.rec`` holds framed records::

    length of the payload   8 bytes, little-endian
    masked crc32 of these   4 bytes
    payload                 doc_id (8 bytes, signed), bytes per id (1), then the ids
    masked crc32 of it      4 bytes

and ``part-00007.idx`` its index, 24 bytes per record: doc_id, byte offset, ids in the
shard before it. A masked checksum is the crc32 turned right by 15 bits plus a constant,
so that a checksum stored in a payload does not look like its own. Ids take 2 bytes each
where the whole vocabulary fits that, else 4. ``manifest`` is a
Parquet table of the shards, written last: a folder without it is not a dataset.

Documents stand in ascending doc_id order, shard after shard. A task writes under a name
of its own and moves the finished files into place, so a task that runs again, or twice
at a time, leaves the same bytes.
"""

from __future__ import annotations

import random
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import table_batches, texts_of
from evenkeel.llm.tokens import encoder

MASK_DELTA = 0xA282EAD8  # Fixed value: the constant that masking adds.
HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<I")
INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("start", "<u8")])
LEAD = struct.Struct("<qB")  # doc_id, bytes per id
NO_ID = -(1 << 63)  # how a NULL doc_id is written


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, TAIL.pack(masked(length)), payload, TAIL.pack(masked(payload))))


def record(doc_id: int, ids: np.ndarray, width: int) -> bytes:
    return frame(LEAD.pack(doc_id, width) + ids.astype(f"<u{width}").tobytes())


def read_frame(stream, where: str = "") -> bytes | None:
    """Next payload of ``stream``; None at its end; an error if a byte is wrong."""
    head = stream.read(HEAD.size)
    if not head:
        return None
    if len(head) < HEAD.size:
        raise ValueError(f"{where}: cut short in a record's length")
    length, check = HEAD.unpack(head)
    if masked(head[:8]) != check:
        raise ValueError(f"{where}: wrong checksum of a record's length")
    rest = stream.read(length + TAIL.size)
    if len(rest) < length + TAIL.size:
        raise ValueError(f"{where}: cut short in a record")
    payload = rest[:length]
    if masked(payload) != TAIL.unpack(rest[length:])[0]:
        raise ValueError(f"{where}: wrong checksum of a record")
    return payload


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


SHARDS = "shard int, records long, tokens long, bytes long"


def write_records(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    shards: int | None = None,
) -> None:
    """Encode every text of ``docs`` and write it to ``folder``.

    NULL texts count as empty and become the end id alone. NULL ids come first. Rows that
    repeat an id are all written, in the order of their texts. An empty table gives
    a dataset without records. Other columns are not looked at. ``shards``: how many
    files; Spark's number of shuffle partitions if not given.
    """
    named = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    order = ["doc_id", "text"]
    ranged = named.repartitionByRange(shards, "doc_id") if shards else named.repartitionByRange("doc_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The range partition is the shard: its number is the order of the shards.
        shard = TaskContext.get().partitionId()
        store, base = _opened(folder)
        store.create_dir(base, recursive=True)
        name, attempt = f"{base}/part-{shard:05}", f"{base}/attempt-{uuid.uuid4().hex}"
        encode = encoder(vocabulary)
        width = 2 if encode.tokenizer.get_vocab_size() <= 1 << 16 else 4
        records = tokens = offset = 0
        with (
            store.open_output_stream(f"{attempt}.rec") as data,
            store.open_output_stream(f"{attempt}.idx") as index,
        ):
            for batch in batches:
                encoded = encode.batch(texts_of(batch.column("text")))
                entries = []
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                    doc_id = NO_ID if doc_id is None else doc_id
                    framed = record(doc_id, ids, width)
                    data.write(framed)
                    entries.append((doc_id, offset, tokens))
                    offset += len(framed)
                    tokens += len(ids)
                index.write(np.array(entries, INDEX).tobytes())
                records += len(entries)
        store.move(f"{attempt}.rec", f"{name}.rec")
        store.move(f"{attempt}.idx", f"{name}.idx")
        yield pa.RecordBatch.from_pydict(
            {"shard": [shard], "records": [records], "tokens": [tokens], "bytes": [offset]},
            schema=pa.schema(
                [("shard", pa.int32()), ("records", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())]
            ),
        )

    written = ranged.sortWithinPartitions(*order).mapInArrow(write, SHARDS)
    written.write.parquet(f"{folder}/manifest")


READ = pa.schema(
    [("doc_id", pa.int64()), ("shard", pa.int32()), ("start", pa.int64()), ("ids", pa.binary())]
)


def read_records(
    spark: SparkSession, folder: str, shuffle_seed: int | None = None, only: list[int] | None = None
) -> DataFrame:
    """(doc_id, shard, start, ids) of a dataset; ``ids`` are little-endian 32-bit integers.

    ``start`` counts the ids of all documents before it, in all shards. The index is read
    first and the records by their offsets: in their order, or with ``shuffle_seed`` in
    an order shuffled within each shard and between shards. ``only`` picks doc_ids
    through the index alone.
    """
    manifest = spark.read.schema(SHARDS).parquet(f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard, so the running sum over them is short.
    starts = manifest.where("records > 0").select(
        "shard", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("first")
    )
    key = F.col("shard") if shuffle_seed is None else F.xxhash64("shard", F.lit(shuffle_seed))
    chosen = None if only is None else np.array(sorted(only), np.int64)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _opened(folder)
        for batch in batches:
            for shard, first in zip(*(batch.column(n).to_pylist() for n in ("shard", "first")), strict=True):
                name = f"{base}/part-{shard:05}"
                with store.open_input_stream(f"{name}.idx") as stream:
                    index = np.frombuffer(stream.read(), INDEX)
                if chosen is not None:
                    index = index[np.isin(index["doc_id"], chosen)]
                if shuffle_seed is not None:
                    index = index[random.Random(f"{shuffle_seed}/{shard}").sample(range(len(index)), len(index))]
                yield from _read_shard(store, name, index, shard, first, shuffle_seed is None and chosen is None)

    # A number of partitions of its own: by their few bytes Spark would join them into one.
    dealt = starts.repartition(max(1, manifest.count()), key)
    return dealt.mapInArrow(read, "doc_id long, shard int, start long, ids binary")


def _read_shard(store, name, index, shard, first, in_order) -> Iterator[pa.RecordBatch]:
    """Records at the offsets of ``index``, in batches of a few MB."""
    rows: dict[str, list] = {field: [] for field in READ.names}
    size = 0
    with store.open_input_file(f"{name}.rec") as source:
        stream = pa.BufferedInputStream(source, 1 << 20) if in_order else source
        for doc_id, offset, start in index.tolist():
            if not in_order:
                source.seek(offset)
            payload = read_frame(stream, f"{name}.rec at {offset}")
            told, width = LEAD.unpack_from(payload) if payload else (None, 0)
            if told != doc_id:
                raise ValueError(f"{name}: index and records disagree at byte {offset}")
            ids = np.frombuffer(payload, f"<u{width}", offset=LEAD.size).astype("<u4").tobytes()
            row = (None if doc_id == NO_ID else doc_id, shard, first + start, ids)
            for field, value in zip(READ.names, row, strict=True):
                rows[field].append(value)
            size += len(payload)
            if size > 4 << 20:
                yield from table_batches(rows, READ)
                rows, size = {field: [] for field in READ.names}, 0
    if rows["doc_id"]:
        yield from table_batches(rows, READ)


def digests(records: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of ``read_records``."""
    return records.select(
        "doc_id",
        "start",
        F.expr("octet_length(ids) DIV 4").cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
