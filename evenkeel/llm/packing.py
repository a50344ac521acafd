"""Packing of documents into windows of at most 1024 tokens, in their order.

The documents of a partition are one stream of tokens in ascending doc_id order. Windows
are cut from it by dynamic programming over the places where a cut is allowed: ends of
documents (free), ends of sentences (``sentence_cost``) and, inside of sentences too
long for that, every ``step`` tokens (``inner_cost``). With S the position of a place,

    best(j) = cost of a cut at j + window_cost + min over i of best(i) + padding(S_j - S_i)

where padding is what is missing to the window, and nothing at a power of two. The first
kind of transition is a minimum of best(i) + S_i over a sliding range of i, which
a monotone queue keeps; the second looks up the few places at these distances.
"""

from __future__ import annotations

import functools
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import table_batches, texts_of, tidied
from evenkeel.llm.tokens import STORE, encoder

WINDOW = 1024
SENTENCE_COST = 6
INNER_COST = 48
WINDOW_COST = 16
LONG_SENTENCE = 192
STEP = 32
BLOCK = 1 << 18  # tokens that one run of the dynamic programme looks at


def best_cuts(positions: list[int], costs: list[int], window: int = WINDOW, window_cost: int = WINDOW_COST) -> list[int]:
    """Indexes of the chosen places, first and last included.

    ``positions`` ascend, at most ``window`` apart. Ties go to the longer window.
    """
    ends, starts = _at_powers(np.asarray(positions), window)
    near = 0  # of the pairs in ``ends`` and ``starts``, the next
    best, back = [0] * len(positions), [0] * len(positions)
    queue = deque([(positions[0], 0)])  # of (best + position, index), ascending in both
    for j in range(1, len(positions)):
        at = positions[j]
        while positions[queue[0][1]] < at - window:
            queue.popleft()
        least, i = queue[0]
        least += window - at
        while ends[near] == j:
            k = starts[near]
            if best[k] < least or best[k] == least and k < i:
                least, i = best[k], k
            near += 1
        best[j] = least + costs[j] + window_cost
        back[j] = i
        value = best[j] + at
        while queue and queue[-1][0] > value:
            queue.pop()
        queue.append((value, j))
    chosen = [len(positions) - 1]
    while chosen[-1]:
        chosen.append(back[chosen[-1]])
    return chosen[::-1]


def _at_powers(positions: np.ndarray, window: int) -> tuple[list[int], list[int]]:
    """Pairs of places, end and start, a power of two apart; ascending by end, -1 behind the last."""
    ends, starts = [], []
    shifted = positions - positions[0] + window  # so that no place looked at lies below 0
    index = np.full(int(shifted[-1]) + 1, -1, np.int32)  # of the place at each position
    index[shifted] = np.arange(len(positions), dtype=np.int32)
    for k in range(window.bit_length()):
        start = index[shifted - (1 << k)]
        end = np.flatnonzero(start >= 0)
        ends.append(end)
        starts.append(start[end])
    ends, starts = np.concatenate(ends), np.concatenate(starts)
    order = np.argsort(ends, kind="stable")
    return [*ends[order].tolist(), -1], starts[order].tolist()


class Places:
    """Where the ids of documents may be cut."""

    def __init__(self, vocabulary: str):
        tokenizer = encoder(vocabulary).tokenizer
        names = tokenizer.get_vocab()
        size = max(names.values()) + 1
        self.ends, self.opens = np.zeros(size, bool), np.zeros(size, bool)
        for name, i in names.items():
            # In this vocabulary's writing a space is Ġ and a line break Ċ.
            self.ends[i] = name.rstrip("\"')]").endswith((".", "!", "?", "Ċ"))
            self.opens[i] = name.startswith(("Ġ", "Ċ"))

    def of(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions behind the first id up to the last, and their costs.

        ``ids`` are documents one after another; ``ends``: where each ends.
        """
        cut = np.zeros(len(ids) + 1, bool)
        cut[1:-1] = self.ends[ids[:-1]] & self.opens[ids[1:]]
        cut[ends - 1] = False  # the end id stays with its document
        cut[ends] = True
        cut[0] = False
        positions = np.flatnonzero(cut)
        costs = np.full(len(positions), SENTENCE_COST)
        costs[np.searchsorted(positions, ends)] = 0
        gaps = np.diff(positions, prepend=0)
        if (gaps > LONG_SENTENCE).any():
            more = np.concatenate(
                [np.arange(p - g + STEP, p, STEP) for p, g in zip(positions, gaps, strict=True) if g > LONG_SENTENCE]
            )
            positions = np.concatenate([positions, more])
            costs = np.concatenate([costs, np.full(len(more), INNER_COST)])
            order = np.argsort(positions, kind="stable")
            positions, costs = positions[order], costs[order]
        return positions, costs


@functools.cache
def _places(vocabulary: str) -> Places:
    """One table per worker process."""
    return Places(vocabulary)


PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


class Packer:
    """Packs a stream of documents, holding a block of them at a time."""

    def __init__(self, vocabulary: str, first_sequence: int, block: int = BLOCK):
        self.places, self.sequence, self.block = _places(vocabulary), first_sequence, block
        # Documents not yet given out whole: (doc_id, ids, ids given out before).
        self.docs: list[tuple[int | None, np.ndarray, int]] = []
        self.fresh: list[np.ndarray] = []  # ids whose places are not known yet
        self.positions, self.costs = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> list[tuple]:
        self.docs.append((doc_id, ids, 0))
        self.fresh.append(ids)
        self.tokens += len(ids)
        return self.flush() if self.tokens >= self.block else []

    def flush(self, last: bool = False) -> list[tuple]:
        """Pieces of the windows chosen so far; the open one at the end waits for more."""
        if not self.tokens:
            return []
        positions, costs = self.positions, self.costs
        if self.fresh:
            ids, ends = np.concatenate(self.fresh), np.cumsum([len(ids) for ids in self.fresh])
            found = self.places.of(ids, ends)
            positions = np.concatenate([positions, found[0] + self.tokens - len(ids)])
            costs = np.concatenate([costs, found[1]])
            self.fresh = []
        chosen = best_cuts(positions.tolist(), costs.tolist())
        cuts = positions[chosen]
        if not last:
            cuts = cuts[:-1]
        out = []
        doc, offset = 0, 0  # offset: of the document in the stream
        given = int(cuts[-1])
        for left, right in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            at = left
            while at < right:
                doc_id, ids, done = self.docs[doc]
                end = offset + len(ids) - done
                upto = min(right, end)
                start = done + at - offset
                piece = ids[start : start + upto - at]
                out.append((doc_id, start, upto - at, piece.tobytes(), len(ids), self.sequence, at - left))
                at = upto
                if at == end:
                    doc, offset = doc + 1, end
            self.sequence += 1
        rest = self.docs[doc:]
        if rest and given > offset:
            doc_id, ids, done = rest[0]
            rest[0] = (doc_id, ids, done + given - offset)
        self.docs = rest
        kept = chosen[-1] if last else chosen[-2]
        self.positions, self.costs = positions[kept:] - given, costs[kept:]
        self.tokens -= given
        return out


def pack(
    docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", block: int = BLOCK
) -> DataFrame:
    """Pieces of documents: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are little-endian 32-bit integers. Each id of a document, its end id included,
    is in exactly one piece. A NULL or empty text is its end id alone. NULL ids come
    first. Rows that repeat an id are documents of their own. A document longer than
    a window lies in several. An empty table gives no pieces. Other columns are not
    looked at.
    """
    named = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(vocabulary, TaskContext.get().partitionId() << 40, block)
        encode = encoder(vocabulary)

        def rows(pieces: list[tuple]) -> Iterator[pa.RecordBatch]:
            columns = zip(*pieces, strict=True)
            yield from table_batches(dict(zip(PIECES.names, map(list, columns), strict=True)), PIECES)

        for batch in batches:
            encoded = encode.batch(texts_of(batch.column("text")))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded, strict=True):
                if pieces := packer.add(doc_id, ids):
                    yield from rows(pieces)
        if pieces := packer.flush(last=True):
            yield from rows(pieces)

    return (
        named.repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(tidied(packed, STORE), "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    )


def digested(pieces: DataFrame) -> DataFrame:
    """``pieces`` with the crc32 of their ids in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
