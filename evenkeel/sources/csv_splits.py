"""Records of quoted CSV files, read in several tasks a file although cells hold line breaks.

Spark's text reader deals out whole lines. Where a line starts, the reader of a CSV is either
between records or inside a quoted cell, so a line maps those two states to two states, and so
does a split of a file, whatever comes before it. The first pass keeps each split's map, one
row a split. Windows over these rows tell every split's true first state; the second pass
then cuts each split into records. A record that spans splits is put together from the ends
that the first pass kept, at most two for each split; a piece longer than ``KEPT`` is read
again from its own file.

Lines are classified and records are parsed by Spark's expressions. Between them Python cuts
Arrow batches at the records' ends.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evenkeel.functions.names import as_path
from evenkeel.session import scratch_path

# What a line does to the state: nothing, turn it, end between records, end in a cell.
SAME, TURN, BETWEEN, INSIDE = range(4)
BOM = "﻿"
# Characters of a piece of a record that the first pass keeps.
KEPT = 1 << 20
SPLIT_STATES = "file string, start long, first long, header string, turns array<boolean>, head string, head_ends boolean, head_kept boolean, tails array<string>, tail_lines array<long>, tails_kept array<boolean>"
RECORDS = "file string, start long, line long, header boolean, record string"


def cell_pattern(delimiter: str) -> str:
    sep = re.escape(delimiter)
    plain = f"[^{sep}]*+" if len(delimiter) == 1 else f"(?:(?!{sep})[\\s\\S])*+"
    return f'(?:"[^"]*+(?:""[^"]*+)*+"\\s*+|(?!"){plain})'


def _patterns(delimiter: str) -> tuple[str, str]:
    """Lines that end inside a cell: of those that start between records, and inside a cell."""
    sep, cell = re.escape(delimiter), cell_pattern(delimiter)
    inside = '[^"]*+(?:""[^"]*+)*+'
    return f'^(?:{cell}{sep})*+"{inside}$', f'^{inside}(?:"\\s*+(?:{sep}{cell})*+{sep}"{inside})?$'


def _kind(line: Column, delimiter: str) -> Column:
    opens, stays = _patterns(delimiter)
    told = [(False, True, SAME), (True, False, TURN), (False, False, BETWEEN), (True, True, INSIDE)]
    kind = F.when(~F.contains(line, F.lit('"')), SAME)
    for from_between, from_inside, value in told[:-1]:
        kind = kind.when((line.rlike(opens) == from_between) & (line.rlike(stays) == from_inside), value)
    return kind.otherwise(INSIDE).cast("byte")


def _lines(spark: SparkSession, path: str | list[str], delimiter: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    start = F.col("_metadata.file_block_start")
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        start.alias("start"),
        _kind(F.when(start == 0, F.ltrim("value", F.lit(BOM))).otherwise(F.col("value")), delimiter).alias("kind"),
        F.col("value").alias("line"),
    )


def _after(kinds: np.ndarray, inside: bool) -> np.ndarray:
    """Whether the state after each line is inside a cell."""
    at = np.maximum.accumulate(np.where(kinds >= BETWEEN, np.arange(len(kinds)), -1))
    turns = np.cumsum(kinds == TURN)
    base = np.where(at >= 0, kinds[at] == INSIDE, inside)
    return base ^ ((turns - np.where(at >= 0, turns[at], 0)) % 2 == 1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], np.ndarray, pa.Array]]:
    """((file, start), kinds, lines) of each stretch of one split in a batch."""
    file, start, kind, line = batch.columns
    if not batch.num_rows:
        return
    changes = np.zeros(batch.num_rows, bool)
    changes[0] = True
    starts = start.to_numpy()
    changes[1:] = (starts[1:] != starts[:-1]) | pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
    ends = [*np.flatnonzero(changes).tolist(), batch.num_rows]
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        yield (file[a].as_py(), int(starts[a])), kind.slice(a, b - a).to_numpy(), line.slice(a, b - a)


def _first_line(lines: pa.Array) -> int | None:
    """Place of the first line with a character."""
    return next((k for k in range(len(lines)) if lines[k].as_py().lstrip(BOM) not in ("", "\r")), None)


class _Piece:
    """Lines of a record so far; their text is let go beyond ``KEPT``, if there is that bound."""

    def __init__(self, line: int, bound: int | None = KEPT):
        self.line, self.bound, self.parts, self.size, self.kept = line, bound, [], 0, True

    def add(self, lines: pa.Array) -> None:
        if self.kept and len(lines):
            self.parts += lines.to_pylist()
            self.size += sum(map(len, self.parts[-len(lines) :])) + len(lines)
            if self.bound is not None and self.size > self.bound:
                self.parts, self.kept = [], False

    def text(self) -> str | None:
        return "\n".join(self.parts) if self.kept else None


class _SplitState:
    """A split's map of states, and the pieces of records at its ends under each first state."""

    def __init__(self, key: tuple[str, int]):
        self.key, self.lines, self.first, self.header = key, 0, None, None
        self.inside = [False, True]
        self.head, self.head_ends = _Piece(0), False
        self.tails = [_Piece(0), _Piece(0)]

    def add(self, kinds: np.ndarray, lines: pa.Array) -> None:
        found = _first_line(lines) if self.first is None else None
        if found is not None:
            self.first = self.lines + found
        for first in (0, 1):
            after = _after(kinds, self.inside[first])
            ends = np.flatnonzero(~after)
            if found is not None and not first and self.key[1] == 0 and (until := ends[ends >= found]).size:
                self.header = "\n".join(lines.slice(found, until[0] - found + 1).to_pylist())
            self.inside[first] = bool(after[-1])
            if first and not self.head_ends:
                self.head.add(lines.slice(0, ends[0] + 1) if len(ends) else lines)
                self.head_ends = len(ends) > 0
            if len(ends):
                self.tails[first] = _Piece(self.lines + int(ends[-1]) + 1)
                self.tails[first].add(lines.slice(ends[-1] + 1))
            else:
                self.tails[first].add(lines)
        self.lines += len(lines)

    def row(self) -> dict:
        return {
            "file": self.key[0], "start": self.key[1], "first": self.first, "header": self.header, "turns": self.inside,
            "head": self.head.text(), "head_ends": self.head_ends, "head_kept": self.head.kept,
            "tails": [t.text() for t in self.tails], "tail_lines": [t.line for t in self.tails], "tails_kept": [t.kept for t in self.tails],
        }


_STATE_SCHEMA = pa.schema(
    [("file", pa.string()), ("start", pa.int64()), ("first", pa.int64()), ("header", pa.string()), ("turns", pa.list_(pa.bool_())), ("head", pa.string()),
     ("head_ends", pa.bool_()), ("head_kept", pa.bool_()), ("tails", pa.list_(pa.string())), ("tail_lines", pa.list_(pa.int64())),
     ("tails_kept", pa.list_(pa.bool_()))]
)
_RECORD_SCHEMA = pa.schema(
    [("file", pa.string()), ("start", pa.int64()), ("line", pa.int64()), ("header", pa.bool_()), ("record", pa.string())]
)


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _SplitState | None = None
    for batch in batches:
        for key, kinds, lines in _runs(batch):
            if now is None or key != now.key:
                if now is not None:
                    yield pa.RecordBatch.from_pylist([now.row()], _STATE_SCHEMA)
                now = _SplitState(key)
            now.add(kinds, lines)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.row()], _STATE_SCHEMA)


def _cut(inside_at: set[tuple[str, int]], ends_too: set[tuple[str, int]] | None = None):
    """Mapper of lines to the records that lie within one split.

    ``inside_at``: splits that start inside a cell. With ``ends_too`` it gives the pieces at
    the ends of those splits instead: the head as line -1.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, skipping, line, first, piece = None, False, False, 0, None, _Piece(0, None)

        def rows(texts: list[str] | pa.Array, places: list[int]) -> pa.RecordBatch:
            n = len(places)
            header = [first is not None and now[1] == 0 and place == first for place in places]
            told = [pa.array([now[0]] * n, pa.string()), pa.array([now[1]] * n, pa.int64()), pa.array(places, pa.int64())]
            return pa.RecordBatch.from_arrays([*told, pa.array(header), pa.array(texts, pa.string())], schema=_RECORD_SCHEMA)

        def left_open() -> Iterator[pa.RecordBatch]:
            if ends_too is not None and now in ends_too and inside:
                yield rows([piece.text()], [-1 if skipping else piece.line])

        for batch in batches:
            for key, kinds, lines in _runs(batch):
                if key != now:
                    if now is not None:
                        yield from left_open()
                    now, inside, line, first = key, key in inside_at, 0, None
                    skipping, piece = inside, _Piece(0, None)
                if first is None and (at := _first_line(lines)) is not None:
                    first = line + at
                after = _after(kinds, inside)
                ends = np.flatnonzero(~after)
                inside = bool(after[-1])
                if not len(ends):
                    if ends_too is not None or not skipping:
                        piece.add(lines)
                    line += len(lines)
                    continue
                firsts = np.concatenate([[0], ends[:-1] + 1])
                single = firsts == ends
                single[0] &= not (piece.parts or skipping)
                if ends_too is None:
                    alone = ends[single]
                    if len(alone):
                        yield rows(lines.take(pa.array(alone)).cast(pa.string()), (line + alone).tolist())
                    texts, places = [], []
                    for k in np.flatnonzero(~single).tolist():
                        if k == 0 and skipping:
                            continue
                        own = _Piece(line + int(firsts[k]), None) if k else piece
                        own.add(lines.slice(firsts[k], ends[k] - firsts[k] + 1))
                        texts.append(own.text())
                        places.append(own.line)
                    if texts:
                        yield rows(texts, places)
                elif now in ends_too and skipping:
                    piece.add(lines.slice(0, ends[0] + 1))
                    yield rows([piece.text()], [-1])
                skipping = False
                piece = _Piece(line + int(ends[-1]) + 1, None)
                piece.add(lines.slice(ends[-1] + 1))
                line += len(lines)
        if now is not None:
            yield from left_open()

    return cut


def csv_records(spark: SparkSession, path: str | list[str], delimiter: str = ",") -> DataFrame:
    """The records of ``records_and_headers``."""
    return records_and_headers(spark, path, delimiter)[0]


def records_and_headers(spark: SparkSession, path: str | list[str], delimiter: str = ",") -> tuple[DataFrame, DataFrame]:
    """Records, and (file, record) of each file's header, which the first pass has seen.

    Records are (file, start, line, header, record), read in as many tasks as the files have
    splits. ``start`` is where the record's split begins in its file and ``line`` its first
    line there, so the three put records in the order of their files. ``header`` marks the
    first one of each file. Records keep their line breaks, but for the last one, and a byte
    order mark; those without a character have no row. A cell that is still open at the end
    of its file gives a record that no parser takes. The splits that start inside a cell are
    told to every task: at most one name and number for each split.
    """
    lines = _lines(spark, path, delimiter)
    found = scratch_path(spark, "split-states")
    lines.mapInArrow(_states, SPLIT_STATES).write.parquet(found)
    kept = spark.read.parquet(found)
    late = kept.groupBy("file").agg(F.max(F.when(F.col("start") == 0, F.col("first"))).alias("of_first"), F.max("first").alias("of_any"))
    if not (bad := late.where("of_first IS NULL AND of_any IS NOT NULL").limit(1)).isEmpty():
        raise ValueError(f"the first split of {bad.first().file} holds blank lines alone")
    states = _first_states(kept)
    inside_at = {(r.file, r.start) for r in states.where("inside").select("file", "start").collect()}
    whole = lines.mapInArrow(_cut(inside_at), RECORDS)
    pieces = _pieces(states)
    lost = pieces.where("text IS NULL").select("file", "start").distinct().collect()
    if lost:
        # Long pieces: read again, from their files only.
        files = {r.file for r in lost}
        again = _lines(spark, [as_path(f) for f in sorted(files)], delimiter).mapInArrow(
            _cut(inside_at, {(r.file, r.start) for r in lost}), RECORDS
        )
        texts = again.select("file", "start", (F.col("line") == -1).alias("is_head"), F.col("record").alias("found"))
        pieces = (
            pieces.withColumn("is_head", F.col("place") == 0)
            .join(texts, ["file", "start", "is_head"], "left")
            .withColumn("text", F.coalesce("text", "found"))
        )
    records = whole.unionByName(_joined(pieces)).where("record NOT IN ('', '\\r')")
    seen = kept.where("header IS NOT NULL").selectExpr("file", "header AS record")
    if not kept.where("start = 0 AND first IS NOT NULL AND header IS NULL").isEmpty():
        # A header of many lines, or longer than its split.
        rest = records.where("header").select("file", "record").join(seen, "file", "left_anti")
        return records, seen.unionAll(rest)
    return records, seen


def _first_states(states: DataFrame) -> DataFrame:
    """``states`` with ``inside``: whether the split starts inside a cell.

    The splits of a file are a window of numbers; its length is that of the file in splits.
    """
    w = Window.partitionBy("file").orderBy("start")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("turns")[0] == F.col("turns")[1]
    turned = F.col("turns")[0] & ~F.col("turns")[1]
    narrow = states.select("file", "start", fixed.alias("fixed"), F.col("turns")[0].alias("to"), F.when(turned, 1).otherwise(0).alias("turn"))
    counted = narrow.withColumn("upto", F.sum("turn").over(w))
    base = F.last(F.when(F.col("fixed"), F.col("to").cast("int")), ignorenulls=True).over(before)
    since = F.last(F.when(F.col("fixed"), F.col("upto")), ignorenulls=True).over(before)
    turns = F.coalesce(F.max("upto").over(before), F.lit(0)) - F.coalesce(since, F.lit(0))
    known = counted.withColumn("inside", (F.coalesce(base, F.lit(0)) + turns) % 2 == 1).select("file", "start", "inside")
    return states.join(known, ["file", "start"])


def _pieces(states: DataFrame) -> DataFrame:
    """(file, start, place, line, header, text): parts of records that span splits; heads are place 0.

    ``text`` is NULL for a piece that was not kept.
    """
    first = F.col("inside").cast("int")
    after = F.get("turns", first)
    line = F.get("tail_lines", first)
    head = F.struct(
        F.lit(0).alias("place"), F.lit(0).cast("long").alias("line"), F.lit(False).alias("header"),
        F.when(F.col("head_kept"), F.col("head")).alias("text"),
    )
    tail = F.struct(
        F.lit(1).alias("place"), line.alias("line"), ((F.col("start") == 0) & line.eqNullSafe(F.col("first"))).alias("header"),
        F.when(F.get("tails_kept", first), F.get("tails", first)).alias("text"),
    )
    has_tail = after & (~F.col("inside") | F.col("head_ends"))
    parts = F.array_compact(F.array(F.when(F.col("inside"), head), F.when(has_tail, tail)))
    return states.select("file", "start", F.explode(parts).alias("part")).select("file", "start", "part.*")


def _joined(pieces: DataFrame) -> DataFrame:
    """Records of their pieces: a tail, whole splits, a head."""
    order = Window.partitionBy("file").orderBy("start", "place")
    numbered = pieces.withColumn("record_number", F.sum("place").over(order))
    gathered = numbered.groupBy("file", "record_number").agg(F.sort_array(F.collect_list(F.struct("start", "place", "line", "header", "text"))).alias("parts"))
    return gathered.select(
        "file",
        F.col("parts")[0]["start"].alias("start"),
        F.col("parts")[0]["line"].alias("line"),
        F.col("parts")[0]["header"].alias("header"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("record"),
    )
