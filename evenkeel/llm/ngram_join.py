"""Similarity self-join on five-word shingle sets with a token-group matrix.

Two texts link when 100 * |intersection| >= 75 * |union|. A set of n shingles shares at
least 75 % of them with any partner, which is used three times:

1. The whole corpus as one group. Every set is dealt out by slices of the hash space; a
   slice tells which shingles occur in two texts or more, and how many. A set with less
   than 75 % such shingles can have no partner and is done. Alone here all texts count.
2. Groups. The remaining sets are sorted by their least hash, so that similar ones stand
   together, and cut into groups. A group stores the union of its shingles and its
   members as rows of places in it: its row of the token-group matrix.
3. Queries. The rarest shingles of a set, as many as it may lack and one more, must hit
   any partner among the partner's own. Groups that hit are candidates; the overlap of
   the query with a group's union bounds that with each member, and only groups that
   reach 75 % are opened and counted.

Blocks of linked sets give a spanning forest and numbers of links, never all pairs.
Copies are one set. Hashes have 64 bits in a text; between texts 40 and the bits of
the slice's number are compared.
"""

from __future__ import annotations

import contextlib
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm.common import free_name, offsets_of, stored, tidied
from evenkeel.llm.components import components
from evenkeel.llm.shingles import shingle_sets

PERCENT = 75
REST = 40  # bits of a hash that are sent besides the number of its slice
FLUSH_TOKENS = 2_000_000
FLUSH_SETS = 60_000
GROUP_SETS = 256
GROUP_CELLS = 4_000_000
DOCS_IN_SLICE = 4096


def least_overlap(n: int | np.ndarray):
    """Shingles that a set of ``n`` shares with any partner, at least."""
    return -(-PERCENT * n // 100)


@contextlib.contextmanager
def _batches(spark: SparkSession, size: str):
    """Rows with arrays in them: batches to Python by size, not by number of rows."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


# ---------------------------------------------------------------------------
# Step 1: shingles by slices of the hash space
# ---------------------------------------------------------------------------

SETS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary())])
DEALT = pa.schema([("slice", pa.int64()), ("flush", pa.int64()), ("tokens", pa.binary()), ("owners", pa.binary())])


def set_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest) of (doc_id, text); the digest of an empty set is NULL."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                ],
                schema=SETS,
            )

    return docs.mapInArrow(tidied(told), "doc_id long, n_shingles long, digest binary")


def _pack40(rest: np.ndarray) -> bytes:
    """40-bit numbers in 5 bytes each: all low 32-bit parts, then all high bytes."""
    return (rest & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (rest >> np.uint64(32)).astype(np.uint8).tobytes()


def _unpack40(data: bytes) -> np.ndarray:
    n = len(data) // 5
    low = np.frombuffer(data, "<u4", n).astype(np.uint64)
    return low | (np.frombuffer(data, np.uint8, n, 4 * n).astype(np.uint64) << np.uint64(32))


def _deal(bits: int):
    """Texts to rows (slice, flush, tokens, owners); a flush is some thousand sets of one task.

    Each flush also sends the table of its sets, in a slice of its own below 0.
    """

    def flushed(number: int, sets: dict[bytes, np.ndarray]) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(s) for s in sets.values()], np.int64)
        tokens = np.concatenate(list(sets.values()))
        owners = np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)
        slices = (tokens >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)
        order = np.argsort(slices, kind="stable")
        tokens, owners, slices = tokens[order], owners[order], slices[order]
        rest = (tokens >> np.uint64(64 - bits - REST)) & np.uint64((1 << REST) - 1)
        starts = np.flatnonzero(np.diff(slices, prepend=-1))
        ends = np.append(starts[1:], len(slices))
        rows = [[-1 - number], [number], [b"".join(sets)], [sizes.astype("<u4").tobytes()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, DEALT.types, strict=True)], schema=DEALT)
        for i in range(0, len(starts), 64):
            part = list(zip(starts[i : i + 64].tolist(), ends[i : i + 64].tolist(), strict=True))
            columns = [
                slices[starts[i : i + 64]].astype(np.int64),
                [number] * len(part),
                [_pack40(rest[a:b]) for a, b in part],
                [owners[a:b].tobytes() for a, b in part],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, DEALT.types, strict=True)], schema=DEALT)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        sets: dict[bytes, np.ndarray] = {}
        size = 0
        for batch in batches:
            texts = batch.column("text")
            for i in range(0, len(texts), 500):
                for tokens in shingle_sets(texts.slice(i, 500).to_pylist()):
                    if not len(tokens) or (key := digest(tokens)) in sets:
                        continue
                    sets[key] = tokens
                    size += len(tokens)
                    if size >= FLUSH_TOKENS or len(sets) >= FLUSH_SETS:
                        yield from flushed(number, sets)
                        number, sets, size = number + 1, {}, 0
        if sets:
            yield from flushed(number, sets)

    return deal


SHARED = pa.schema([("flush", pa.int64()), ("slice", pa.int64()), ("tokens", pa.binary()), ("owners", pa.binary()), ("counts", pa.binary())])
SHARED_SQL = "flush long, slice long, tokens binary, owners binary, counts binary"


def _in_slice(table: pa.Table) -> pa.Table:
    """What a slice tells each flush: its shingles that occur elsewhere, and how often (eighths of log2)."""
    where = table.column("slice")[0].as_py() if table.num_rows else -1
    columns = {name: table.column(name).to_pylist() for name in DEALT.names}
    if where < 0:
        none = [None] * table.num_rows
        return pa.Table.from_pydict({"flush": columns["flush"], "slice": columns["slice"], "tokens": columns["tokens"], "owners": columns["owners"], "counts": none}, schema=SHARED)
    parts = [_unpack40(data) for data in columns["tokens"]]
    tokens = np.concatenate(parts)
    order = np.argsort(tokens, kind="stable")
    ranked = tokens[order]
    heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    runs = np.diff(np.append(heads, len(ranked)))
    count = np.empty(len(tokens), np.int64)
    count[order] = np.repeat(runs, runs)
    out: dict[str, list] = {name: [] for name in SHARED.names}
    at = 0
    for flush, part, owners in zip(columns["flush"], parts, columns["owners"], strict=True):
        own = count[at : at + len(part)]
        at += len(part)
        shared = own > 1
        if shared.any():
            out["flush"].append(flush)
            out["slice"].append(where)
            out["tokens"].append(_pack40(part[shared]))
            out["owners"].append(np.frombuffer(owners, np.uint16)[shared].tobytes())
            out["counts"].append(np.minimum(255, np.round(np.log2(own[shared]) * 8)).astype(np.uint8).tobytes())
    return pa.Table.from_pydict(out, schema=SHARED)


LEFT = pa.schema([("least", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("tokens", pa.binary()), ("counts", pa.binary())])
LEFT_SQL = "least long, n long, digest binary, tokens binary, counts binary"


def _of_flush(table: pa.Table) -> pa.Table:
    """Sets of a flush that have enough shared shingles for a partner, with these shingles."""
    columns = {name: table.column(name).to_pylist() for name in SHARED.names}
    head = next(i for i, s in enumerate(columns["slice"]) if s < 0)
    digests, sizes = columns["tokens"][head], np.frombuffer(columns["owners"][head], "<u4").astype(np.int64)
    slices = [i for i, s in enumerate(columns["slice"]) if s >= 0]
    out: dict[str, list] = {name: [] for name in LEFT.names}
    if slices:
        tokens = np.concatenate([_unpack40(columns["tokens"][i]) | (np.uint64(columns["slice"][i]) << np.uint64(REST)) for i in slices])
        owners = np.concatenate([np.frombuffer(columns["owners"][i], np.uint16) for i in slices])
        counts = np.concatenate([np.frombuffer(columns["counts"][i], np.uint8) for i in slices])
        enough = np.bincount(owners, minlength=len(sizes)) >= least_overlap(sizes)
        kept = enough[owners]
        tokens, owners, counts = tokens[kept], owners[kept], counts[kept]
        order = np.lexsort((tokens, owners))
        tokens, owners, counts = tokens[order], owners[order], counts[order]
        bounds = np.searchsorted(owners, np.arange(len(sizes) + 1))
        for i in np.flatnonzero(enough).tolist():
            a, b = int(bounds[i]), int(bounds[i + 1])
            # The order of sorting must not follow the slices, whose low numbers are in every set.
            mixed = (tokens[a:b] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1)
            out["least"].append(int(mixed.min()))
            out["n"].append(int(sizes[i]))
            out["digest"].append(digests[16 * i : 16 * i + 16])
            out["tokens"].append(tokens[a:b].tobytes())
            out["counts"].append(counts[a:b].tobytes())
    return pa.Table.from_pydict(out, schema=LEFT)


# ---------------------------------------------------------------------------
# Step 2: groups and their rows of the matrix
# ---------------------------------------------------------------------------

GROUP = pa.schema(
    [
        ("gid", pa.int64()),
        ("digests", pa.binary()),  # 16 bytes for each member
        ("sizes", pa.binary()),  # shingles of each member, shared or not
        ("lengths", pa.binary()),  # shared shingles of each member
        ("union", pa.binary()),  # shared shingles of all members, ascending
        ("places", pa.binary()),  # of each member's shingles in the union
        ("counts", pa.binary()),  # how common each shingle of the union is
    ]
)
GROUP_SQL = "gid long, digests binary, sizes binary, lengths binary, union binary, places binary, counts binary"


class Group:
    """A row of the token-group matrix."""

    def __init__(self, row: dict):
        self.gid, digests = row["gid"], row["digests"]
        self.digests = [digests[i : i + 16] for i in range(0, len(digests), 16)]
        self.sizes = np.frombuffer(row["sizes"], "<i8")
        self.lengths = np.frombuffer(row["lengths"], "<i8")
        self.union = np.frombuffer(row["union"], "<u8")
        self.places = np.frombuffer(row["places"], "<u4")
        self.counts = np.frombuffer(row["counts"], np.uint8)
        self.bounds = offsets_of(self.lengths.tolist())

    def member(self, i: int) -> np.ndarray:
        """Places of a member's shingles in the union."""
        return self.places[self.bounds[i] : self.bounds[i + 1]]

    def cells(self) -> np.ndarray:
        """(member, shingle of the union): 1 where it has it."""
        out = np.zeros((len(self.sizes), len(self.union)), np.float32)
        out[np.repeat(np.arange(len(self.sizes)), self.lengths), self.places] = 1
        return out


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive sets with the same least hash to groups; copies of a set are left out."""
    number = TaskContext.get().partitionId() << 33
    held: list[tuple] = []
    size, least, last = 0, None, None

    def group() -> pa.RecordBatch:
        lengths = np.array([len(t) for _, _, t, _ in held], "<i8")
        joined = np.concatenate([t for _, _, t, _ in held])
        counts = np.concatenate([c for *_, c in held])
        union, first, places = np.unique(joined, return_index=True, return_inverse=True)
        columns = [
            number,
            b"".join(d for d, *_ in held),
            np.array([n for _, n, *_ in held], "<i8").tobytes(),
            lengths.tobytes(),
            union.astype("<u8").tobytes(),
            places.astype("<u4").tobytes(),
            counts[first].tobytes(),
        ]
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, GROUP.types, strict=True)], schema=GROUP)

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in LEFT.names]
        for own_least, n, own, tokens, counts in zip(*columns, strict=True):
            if own == last:
                continue
            tokens, counts, last = np.frombuffer(tokens, "<u8"), np.frombuffer(counts, np.uint8), own
            full = len(held) >= GROUP_SETS or (len(held) + 1) * (size + len(tokens)) > GROUP_CELLS
            if held and (own_least != least or full):
                yield group()
                number, held, size = number + 1, [], 0
            held.append((own, n, tokens, counts))
            size, least = size + len(tokens), own_least
    if held:
        yield group()


# ---------------------------------------------------------------------------
# Step 3: candidates by rare shingles, bounds, opened groups
# ---------------------------------------------------------------------------

PROBES = pa.schema([("slice", pa.int64()), ("gid", pa.int64()), ("tokens", pa.binary()), ("members", pa.binary())])
HITS = pa.schema([("g", pa.int64()), ("h", pa.int64()), ("members", pa.binary())])


def _probes(slices: int):
    """The rarest shingles of each member, as many as it may lack of a partner and one more."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                group = Group(row)
                tokens, members = [], []
                # An order of all shingles: by how common they are, then by their hash.
                rank = np.lexsort((group.union, group.counts)).argsort()
                for i, n in enumerate(group.sizes.tolist()):
                    own = group.member(i)
                    lacking = n - len(own)  # shingles of no other text stand first and find nothing
                    k = n - least_overlap(n) + 1 - lacking
                    own = own[np.argsort(rank[own])[:k]]
                    tokens.append(group.union[own])
                    members.append(np.full(len(own), i, np.uint16))
                tokens, members = np.concatenate(tokens), np.concatenate(members)
                where = (tokens % np.uint64(slices)).astype(np.int64)
                order = np.argsort(where, kind="stable")
                tokens, members, where = tokens[order], members[order], where[order]
                starts = np.flatnonzero(np.diff(where, prepend=-1))
                ends = np.append(starts[1:], len(where)).tolist()
                parts = list(zip(starts.tolist(), ends, strict=True))
                columns = [where[starts], [group.gid] * len(parts), [tokens[a:b].tobytes() for a, b in parts], [members[a:b].tobytes() for a, b in parts]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, PROBES.types, strict=True)], schema=PROBES)

    return probe


def _hits(table: pa.Table) -> pa.Table:
    """Pairs of groups g < h with the members of g that hit h in this slice."""
    gids, tokens, members = [], [], []
    for gid, t, m in zip(*(table.column(n).to_pylist() for n in ("gid", "tokens", "members")), strict=True):
        tokens.append(np.frombuffer(t, "<u8"))
        members.append(np.frombuffer(m, np.uint16))
        gids.append(np.full(len(tokens[-1]), gid, np.int64))
    found: dict[tuple[int, int], set[int]] = {}
    if gids:
        tokens, members, gids = np.concatenate(tokens), np.concatenate(members), np.concatenate(gids)
        order = np.lexsort((members, gids, tokens))
        tokens, members, gids = tokens[order], members[order], gids[order]
        heads = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        ends = np.append(heads[1:], len(tokens))
        several = gids[heads] != gids[ends - 1]
        seen = set()
        for a, b in zip(heads[several].tolist(), ends[several].tolist(), strict=True):
            g, m = gids[a:b], members[a:b]
            key = g.tobytes() + m.tobytes()
            if key in seen:
                continue  # another shingle with the same owners
            seen.add(key)
            starts = np.flatnonzero(np.diff(g, prepend=-1))
            names, parts = g[starts].tolist(), np.split(m, starts[1:])
            for i, (name, part) in enumerate(zip(names, parts, strict=True)):
                own = part.tolist()
                for other in names[i + 1 :]:
                    found.setdefault((name, other), set()).update(own)
    columns = [[g for g, _ in found], [h for _, h in found], [np.array(sorted(m), np.uint16).tobytes() for m in found.values()]]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, HITS.types, strict=True)], schema=HITS)


def _queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A group row cut down to the members that ask group h; ``asks`` are lists of members."""
    schema = pa.schema([("h", pa.int64()), *[(f"q_{f.name}", f.type) for f in GROUP]])
    for batch in batches:
        for row in batch.to_pylist():
            group = Group(row)
            asking = np.unique(np.concatenate([np.frombuffer(m, np.uint16) for m in row["asks"]])).tolist()
            places = [group.member(i) for i in asking]
            used, renamed = np.unique(np.concatenate(places), return_inverse=True)
            columns = [
                row["h"],
                group.gid,
                b"".join(group.digests[i] for i in asking),
                group.sizes[asking].tobytes(),
                group.lengths[asking].tobytes(),
                group.union[used].tobytes(),
                renamed.astype("<u4").tobytes(),
                group.counts[used].tobytes(),
            ]
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


LINKS = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("n", pa.int64())])
LINKS_SQL = "a binary, b binary, n long"


def _forest(names: list[bytes], links: np.ndarray) -> list[tuple]:
    """Edges (a, b, 0) that span what ``links`` connects, and numbers of links (a, a, n)."""
    n = len(names)
    label = np.arange(n)
    while True:
        around = np.where(links, label[None, :], n).min(1, initial=n)
        new = np.minimum(label, around)
        new = new[new]
        if (new == label).all():
            break
        label = new
    edges = [(names[i], names[k], 0) for i, k in enumerate(label.tolist()) if i != k]
    return edges + [(names[i], names[i], k) for i, k in enumerate(links.sum(1).tolist()) if k]


def _linked(inter: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (100 + PERCENT) * inter.astype(np.int64) >= PERCENT * (a[:, None] + b[None, :])


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside each group."""
    for batch in batches:
        for row in batch.to_pylist():
            if len(row["digests"]) <= 16:
                continue
            group = Group(row)
            cells = group.cells()
            links = _linked(cells @ cells.T, group.sizes, group.sizes)
            np.fill_diagonal(links, False)
            if rows := _forest(group.digests, links):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), LINKS.types, strict=True)], schema=LINKS)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the queries of one group with the members of another."""
    for batch in batches:
        for row in batch.to_pylist():
            group = Group({name: row[name] for name in GROUP.names})
            query = Group({name: row[f"q_{name}"] for name in GROUP.names})
            at = np.searchsorted(group.union, query.union)
            at[at == len(group.union)] = 0
            known = group.union[at] == query.union
            owner = np.repeat(np.arange(len(query.sizes)), query.lengths)
            hit = known[query.places]
            # The bound: overlap with the group's union, against the smallest member a query could link with.
            overlap = np.bincount(owner[hit], minlength=len(query.sizes))
            low, high = group.sizes.min(), group.sizes.max()
            smallest = np.maximum(low, least_overlap(query.sizes))
            needed = -(-PERCENT * (query.sizes + smallest) // (100 + PERCENT))
            asks = np.flatnonzero((overlap >= needed) & (least_overlap(query.sizes) <= high) & (least_overlap(low) <= query.sizes))
            if not len(asks):
                continue
            cells = group.cells()
            links = np.zeros((len(asks), len(group.sizes)), bool)
            step = max(1, GROUP_CELLS // max(1, len(group.union)))
            for i in range(0, len(asks), step):
                part = asks[i : i + step]
                own = np.zeros((len(part), len(group.union)), np.float32)
                for k, q in enumerate(part.tolist()):
                    places = query.member(q)
                    own[k, at[places[known[places]]]] = 1
                links[i : i + step] = _linked(own @ cells.T, query.sizes[part], group.sizes)
            if not links.any():
                continue
            n, m = links.shape
            square = np.zeros((n + m, n + m), bool)
            square[:n, n:] = links
            square[n:, :n] = links.T
            rows = _forest([query.digests[i] for i in asks.tolist()] + group.digests, square)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), LINKS.types, strict=True)], schema=LINKS)


# ---------------------------------------------------------------------------
# The join
# ---------------------------------------------------------------------------


def set_links(docs: DataFrame, docs_in_slice: int = DOCS_IN_SLICE) -> DataFrame:
    """(a, b, n): spanning edges between linked sets of (doc_id, text) with n = 0, and (a, a, n) parts of numbers of links."""
    spark = docs.sparkSession
    bits = min(24, max(5, math.ceil(math.log2(max(1, docs.count() / docs_in_slice)))))
    slices = 1 << bits
    texts = docs.select("text")
    dealt = texts.mapInArrow(tidied(_deal(bits)), "slice long, flush long, tokens binary, owners binary")
    shared = dealt.groupBy("slice").applyInArrow(_in_slice, SHARED_SQL)
    left = shared.groupBy("flush").applyInArrow(_of_flush, LEFT_SQL)
    left = stored(left, "candidates")
    groups = stored(
        left.repartitionByRange("least", "n", "digest").sortWithinPartitions("least", "n", "digest").mapInArrow(tidied(_grouped), GROUP_SQL),
        "groups",
    )
    hits = (
        groups.mapInArrow(tidied(_probes(slices)), "slice long, gid long, tokens binary, members binary")
        .groupBy("slice")
        .applyInArrow(_hits, "g long, h long, members binary")
        .groupBy("g", "h")
        .agg(F.collect_list("members").alias("asks"))  # a slice gives a pair once
    )
    queries = hits.join(groups, hits["g"] == groups["gid"]).drop("g").mapInArrow(
        tidied(_queries), "h long, " + ", ".join(f"q_{part}" for part in GROUP_SQL.split(", "))
    )
    opened = queries.join(groups, queries["h"] == groups["gid"]).drop("h").mapInArrow(tidied(_opened), LINKS_SQL)
    return opened.unionAll(groups.mapInArrow(tidied(_within), LINKS_SQL))


def ngram_join(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", docs_in_slice: int = DOCS_IN_SLICE) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_copies, n_links) for each row of ``docs``.

    ``component_id`` is the smallest id reachable by links, itself included. ``n_copies``
    are the rows with the same set, ``n_links`` the different sets that it links with.
    A row without words or text has 0 shingles, links with nothing and is a component of
    its own. Rows that repeat an id are rows of their own with one id. NULL ids are
    linked like others but are nobody's smallest id, unless all are NULL. An empty table
    gives an empty result. Other columns are not looked at.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    with _batches(spark, "16m"):
        links = stored(set_links(named, docs_in_slice), "links")
        sets = stored(set_digests(named), "sets")
    roots = components(links.where("n = 0"))
    number = links.where("n > 0").groupBy(F.col("a").alias("digest")).agg(F.sum("n").alias("n_links"))
    classes = sets.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_copies"))
    classes = classes.join(roots.withColumnRenamed("node", "digest"), "digest", "left").join(number, "digest", "left")
    classes = classes.withColumn("root", F.coalesce("root", "digest"))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    told = classes.join(least, "root").select("digest", "component_id", "n_copies", "n_links")
    return sets.join(told, "digest", "left").select(
        F.col("doc_id").alias(id_column),
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def keep_one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the row of the smallest id of each component, all columns as they were.

    Rows without words stay. Rows that share an id stay or go together; a NULL id stays
    only in a component of NULL ids. Any column names are allowed.
    """
    name = free_name(docs, "kept_id")
    kept = (
        ngram_join(docs, id_column, text_column)
        .where(F.col(id_column).eqNullSafe(F.col("component_id")))
        .select(F.col(id_column).alias(name))
        .distinct()
    )
    return docs.join(kept, F.col(id_column).eqNullSafe(F.col(name)), "left_semi")
