"""Exact deduplication over an extendible-hash index in shared files.

Only DataFrame functions. The index has four tables in the shared folder:

* ``keys``: every 64-bit text hash with its number of rows;
* ``directory``: buckets, each a prefix of the hash. A bucket with more keys than a
  page holds is split in two at double the directory, round after round. Copies of a
  text are one key, so a hot text never splits a bucket, it only lengthens a chain;
* ``pages``: the rows of all keys that occur more than once, with their texts, in the
  order of the buckets: the task that writes a page file owns that range of keys;
* the chains: rows of one key are grouped by the bytes of their texts.

A key that occurs once needs no comparison, so the texts of unique rows are only read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import free_name, stored

MAX_DEPTH = 56


def _slot(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def _key(text: Column, key_bits: int) -> Column:
    hashed = F.xxhash64(text)
    return hashed.bitwiseAND(F.lit(-(1 << (64 - key_bits))).cast("long")) if key_bits < 64 else hashed


def build_directory(keys: DataFrame, page_keys: int) -> tuple[DataFrame, int]:
    """Buckets (depth, prefix) with at most ``page_keys`` of the distinct ``keys`` each.

    Returns them with the global depth. At ``MAX_DEPTH`` a bucket stays overfull.
    """
    total = keys.count()
    depth = max(0, min(MAX_DEPTH, math.ceil(math.log2(max(1, total / page_keys)))))
    pending, closed = keys.select("key"), None
    while True:
        counts = stored(
            pending.groupBy(_slot(F.col("key"), depth).alias("prefix")).agg(F.count("*").alias("n")),
            f"directory-{depth}",
        )
        fits = F.lit(True) if depth == MAX_DEPTH else F.col("n") <= page_keys
        done = counts.where(fits).select(F.lit(depth).alias("depth"), "prefix")
        closed = done if closed is None else closed.unionAll(done)
        overfull = counts.where(~fits)
        if overfull.isEmpty():
            return closed, depth
        pending = pending.withColumn("prefix", _slot(F.col("key"), depth)).join(
            overfull.select("prefix"), "prefix", "left_semi"
        ).select("key")
        depth += 1


def exact_dedup(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    page_keys: int = 4096,
    key_bits: int = 64,
) -> DataFrame:
    """One row per row of ``docs``: which row of its equal texts stays.

    Returns the id column, ``keep_id`` (the largest id among rows of the same text),
    ``group_size``, ``kept``, ``text_sha256`` and ``chain_length`` (texts that share
    its hash key).

    NULL texts count as empty and are equal to empty ones. A NULL id loses against any
    other. Rows that repeat both the text and the largest id are one row written
    several times: each of them reports ``kept``. An empty table gives an empty result.
    Other columns are not looked at. ``key_bits`` shortens the hash, for tests of
    chains.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), text.alias("text"), _key(text, key_bits).alias("key"))

    keys = stored(rows.groupBy("key").agg(F.count("*").alias("n")), "keys")
    buckets, depth = build_directory(keys, page_keys)
    # Every slot of the directory points to its bucket, which may have several.
    first, width = f"shiftleft(prefix, {depth} - depth)", f"shiftleft(1L, {depth} - depth)"
    slots = buckets.selectExpr(
        f"explode(sequence({first}, {first} + {width} - 1)) AS slot", f"{first} AS bucket"
    )
    repeated = (
        keys.where("n > 1")
        .withColumn("slot", _slot(F.col("key"), depth))
        .join(slots, "slot")
        .select("key", "bucket")
    )
    pages = stored(
        rows.join(repeated, "key")
        .select("bucket", "key", "id", "text")
        .repartitionByRange("bucket", "key", "id")
        .sortWithinPartitions("bucket", "key"),
        "pages",
    )
    chain = Window.partitionBy("bucket", "key")
    groups = (
        pages.groupBy("bucket", "key", "text")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("bucket", "key", F.sha2("text", 256).alias("sha"), "keep_id", "group_size")
        .withColumn("chain_length", F.count("*").over(chain))
        .withColumn("digests", F.size(F.collect_set("sha").over(chain)))
    )
    # Membership is told by key and SHA-256; two texts with both alike end the job.
    told = F.when(F.col("digests") == F.col("chain_length"), F.col("sha")).otherwise(
        F.raise_error(F.lit("two texts of one key share a SHA-256"))
    )
    groups = groups.select("key", told.alias("sha"), "keep_id", "group_size", "chain_length")
    shown = rows.select("id", "key", F.sha2("text", 256).alias("sha")).join(groups, ["key", "sha"], "left")
    single = F.col("group_size").isNull()
    return shown.select(
        F.col("id").alias(id_column),
        F.when(single, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        F.coalesce("chain_length", F.lit(1)).cast("long").alias("chain_length"),
    )


def keep_first_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the kept row of each text alone, all columns as they were.

    Of rows that repeat both id and text, one stays. Any column names are allowed.
    """
    found = exact_dedup(docs, id_column, text_column).where("kept")
    shown = lambda name: (F.coalesce(F.col(name).cast("string"), F.lit("")), F.col(name).isNull())
    names = [free_name(docs, name) for name in ("row_id", "row_null", "row_sha")]
    kept = found.select(*[c.alias(n) for c, n in zip((*shown(id_column), F.col("text_sha256")), names, strict=True)]).distinct()
    sha = F.sha2(F.coalesce(F.col(text_column), F.lit("")), 256)
    marked = docs.withColumns(dict(zip(names, (*shown(id_column), sha), strict=True)))
    # The join leaves rows where they can be told apart without moving again.
    return marked.join(kept, names, "left_semi").dropDuplicates(names).select(*docs.columns)
