"""Language-model scores by subword lattices.

The vocabulary is an existing one of subword pieces. Its pieces get unigram scores from
all training texts: the distinct words with their counts are segmented once each, the
pieces counted, and the counts refined over all segmentations. The probability of a word is the sum over all its segmentations, by
forward recursion in logarithms over the lattice of its pieces, and that of a text the
product over its words and the end. Each distinct word is scored once in the corpus.

The commonest words, a fixed number of them, are scored once and summed where the texts are
read. The others meet their counts in slices of the words' hashes. A task sends its words slice by
slice, with the places of the texts that hold them, and a slice sends back sums for each
text, so that texts themselves are never shuffled.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import stored

MARK = "▁"  # Fixed value: how the vocabulary writes the beginning of a word.
FLUSH_WORDS = 2_000_000
FLUSH_TEXTS = 60_000
TEXTS_IN_SLICE = 16_384
FOLDS, HELD_OUT = 7, 2
ROUNDS = 2
PLAIN_CHARS = 30  # of a word: longer ones are seldom worth the try without logarithms
LEAST_CHANCE = 1e-250  # of a word without logarithms; what is lost below 1e-308 is no part of it
SMOOTHING = 0.1
AT_ONCE = 100_000  # words
COMMON = 4096  # words whose scores every task has: the commonest, at any size of the corpus


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def words_of(text: str | None) -> list[bytes]:
    """Words of a text; bytes lower A-Z alone and split at the six white-space characters alone."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


BYTE = re.compile("<0x[0-9A-F]{2}>")


class Lattice:
    """Log10 probabilities of words from piece scores; the scores of bytes and of the end are no pieces of text."""

    def __init__(self, scores: dict[str, float]):
        self.bytes = {piece: score for piece, score in scores.items() if BYTE.fullmatch(piece)}
        self.scores = {piece: score for piece, score in scores.items() if piece and piece not in self.bytes}
        self.longest = max(map(len, self.scores), default=1)

    def parts(self, char: str) -> list[str]:
        """The bytes of a character that no piece has."""
        return [f"<0x{b:02X}>" for b in char.encode("utf-8", "surrogatepass")]

    def unknown(self, char: str) -> float:
        return sum(self.bytes[part] for part in self.parts(char))

    def word(self, word: str) -> float:
        """Forward recursion: the logarithm of the sum over all segmentations.

        A character that no piece has is its bytes.
        """
        text, scores, longest = MARK + word, self.scores, self.longest
        n = len(text)
        into: list[list[float]] = [[] for _ in range(n + 1)]
        into[0].append(0.0)
        for i in range(n):
            if not into[i]:
                continue
            here = _log_sum(into[i])
            for j in range(i + 1, min(n, i + longest) + 1):
                score = scores.get(text[i:j])
                if score is not None:
                    into[j].append(here + score)
            if text[i] not in scores:
                into[i + 1].append(here + self.unknown(text[i]))
        return _log_sum(into[n])

    def expected(self, word: str, times: int, into: dict[str, float]) -> None:
        """Adds how often each piece is used, over all segmentations by their probability."""
        text, scores, longest = MARK + word, self.scores, self.longest
        n = len(text)
        edges: list[list[tuple[int, list[str], float]]] = [[] for _ in range(n + 1)]  # by their end
        ahead: list[float | None] = [0.0] + [None] * n
        for j in range(1, n + 1):
            for i in range(max(0, j - longest), j):
                if ahead[i] is not None and (score := scores.get(text[i:j])) is not None:
                    edges[j].append((i, [text[i:j]], score))
            if ahead[j - 1] is not None and text[j - 1] not in scores:
                edges[j].append((j - 1, self.parts(text[j - 1]), self.unknown(text[j - 1])))
            if edges[j]:
                ahead[j] = _log_sum([ahead[i] + score for i, _, score in edges[j]])
        # Share of the whole that passes each place, from the end backwards.
        passing = [0.0] * n + [float(times)]
        for j in range(n, 0, -1):
            if passing[j] <= 0:
                continue
            for i, parts, score in edges[j]:
                share = passing[j] * 10 ** (ahead[i] + score - ahead[j])
                passing[i] += share
                for part in parts:
                    into[part] = into.get(part, 0.0) + share


class Lattices:
    """The same for many words at once: words of one length are the rows of matrices.

    A substring is looked up by a rolling 64-bit hash, which a table of the pieces' own
    hashes checks. Chances are plain products; words that are long, or whose chance is too
    small for that, go through ``Lattice`` one by one.
    """

    BASE = np.uint64(0x9E3779B97F4A7C15)
    ROWS = 1 << 17  # characters of the words of one step

    def __init__(self, lattice: Lattice):
        self.lattice = lattice
        self.pieces = [piece for piece in lattice.scores if len(piece) <= PLAIN_CHARS]
        self.chances = 10.0 ** np.array([lattice.scores[piece] for piece in self.pieces] or [0.0])
        self.longest = max(map(len, self.pieces), default=1)
        self.known = set(lattice.scores)
        self._tables(np.array([self._hash(piece) for piece in self.pieces], np.uint64))

    def _hash(self, piece: str) -> int:
        out = 0
        for c in piece:
            out = (out * int(self.BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return out

    def _tables(self, hashes: np.ndarray) -> None:
        """Two tables of hash and place: a large one, and one for what shares a slot there."""
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces of one hash")
        self.tables = []
        left = np.arange(len(hashes))
        for bits in (21, 16, 16, 16):
            slots = self._slots(hashes[left], bits, len(self.tables))
            told, place = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
            _, first = np.unique(slots, return_index=True)
            told[slots[first]], place[slots[first]] = hashes[left[first]], left[first]
            self.tables.append((bits, told, place))
            left = np.delete(left, first)
            if not len(left):
                return
        raise ValueError("too many pieces share their slots")

    @staticmethod
    def _slots(hashes: np.ndarray, bits: int, table: int) -> np.ndarray:
        return ((hashes * np.uint64(0xD6E8FEB86659FD93 + 2 * table)) >> np.uint64(64 - bits)).astype(np.int64)

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the piece with each hash, or -1."""
        out = np.full(hashes.shape, -1, np.int32)
        for number, (bits, told, place) in enumerate(self.tables):
            slots = self._slots(hashes, bits, number)
            hit = (told[slots] == hashes) & (place[slots] >= 0)
            out[hit] = place[slots[hit]]
        return out

    def _edges(self, chars: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """By length of a piece: places and chances at each start; and the characters that are bytes."""
        w, n = chars.shape
        upto = np.zeros((w, n + 1), np.uint64)
        for k in range(n):
            upto[:, k + 1] = upto[:, k] * self.BASE + chars[:, k] + np.uint64(1)
        places, chances, power = [], [], 1
        for length in range(1, min(self.longest, n) + 1):
            power = power * int(self.BASE) & 0xFFFFFFFFFFFFFFFF
            found = self._places(upto[:, length:] - upto[:, : n + 1 - length] * np.uint64(power))
            places.append(found)
            chances.append(np.where(found >= 0, self.chances[found], 0.0))
        unknown = places[0] < 0
        for char in np.unique(chars[unknown]).tolist():
            at = unknown & (chars == char)
            if chr(char) in self.known:
                unknown &= ~at  # a piece that is not in the tables; never so for one character
            else:
                chances[0][at] = 10.0 ** self.lattice.unknown(chr(char))
        return places, chances, unknown

    def _ahead(self, chances: list[np.ndarray], w: int, n: int) -> np.ndarray:
        ahead = np.zeros((w, n + 1))
        ahead[:, 0] = 1.0
        for j in range(1, n + 1):
            for length in range(1, min(len(chances), j) + 1):
                ahead[:, j] += ahead[:, j - length] * chances[length - 1][:, j - length]
        return ahead

    def _steps(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places in ``words``, characters) of words of one length; the long ones are left out."""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        for n in np.unique(lengths[lengths <= PLAIN_CHARS]).tolist():
            at = np.flatnonzero(lengths == n)
            step = max(1, self.ROWS // n)
            for k in range(0, len(at), step):
                own = at[k : k + step]
                text = "".join([MARK + words[i] for i in own.tolist()])
                chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, n)
                yield own, chars.astype(np.uint64)

    def words(self, words: list[str]) -> np.ndarray:
        """Log10 probability of each word."""
        out = np.full(len(words), np.nan)
        for at, chars in self._steps(words):
            _, chances, _ = self._edges(chars)
            last = self._ahead(chances, *chars.shape)[:, -1]
            fine = last >= LEAST_CHANCE
            out[at[fine]] = np.log10(last[fine])
        for i in np.flatnonzero(np.isnan(out)).tolist():
            out[i] = self.lattice.word(words[i])
        return out

    def expected(self, words: list[str], times: list[int], into: dict[str, float]) -> None:
        """Adds how often each piece is used in all ``words``, each as often as ``times`` says."""
        counts, numbers, left = np.zeros(len(self.pieces)), np.array(times, float), np.ones(len(words), bool)
        for at, chars in self._steps(words):
            w, n = chars.shape
            places, chances, unknown = self._edges(chars)
            ahead = self._ahead(chances, w, n)
            fine = ahead[:, n] >= LEAST_CHANCE
            left[at[fine]] = False
            behind = np.zeros((w, n + 1))
            behind[:, n] = np.where(fine, numbers[at] / np.where(fine, ahead[:, n], 1.0), 0.0)
            for i in range(n - 1, -1, -1):
                for length in range(1, min(len(chances), n - i) + 1):
                    behind[:, i] += chances[length - 1][:, i] * behind[:, i + length]
            for length, (found, chance) in enumerate(zip(places, chances, strict=True), 1):
                share = ahead[:, : n + 1 - length] * chance * behind[:, length:]
                hit = found >= 0
                counts += np.bincount(found[hit], share[hit], len(counts))
                if length == 1 and unknown.any():
                    which, inverse = np.unique(chars[unknown], return_inverse=True)
                    for char, total in zip(which.tolist(), np.bincount(inverse, share[unknown]).tolist(), strict=True):
                        for part in self.lattice.parts(chr(char)):
                            into[part] = into.get(part, 0.0) + total
        for i in np.flatnonzero(counts).tolist():
            into[self.pieces[i]] = into.get(self.pieces[i], 0.0) + float(counts[i])
        for i in np.flatnonzero(left).tolist():
            self.lattice.expected(words[i], times[i], into)


def _log_sum(terms: list[float]) -> float:
    if len(terms) == 1:
        return terms[0]
    most = max(terms)
    return most + math.log10(sum([10 ** (t - most) for t in terms]))


def _processor(vocabulary: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary)


# ---------------------------------------------------------------------------
# Counts of training words
# ---------------------------------------------------------------------------


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over the training texts of (doc_id, text), words as bytes."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def emitted() -> Iterator[pa.RecordBatch]:
            words, numbers = list(counts), list(counts.values())
            for i in range(0, len(words), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(words[i : i + 50_000], pa.binary()), pa.array(numbers[i : i + 50_000], pa.int64())], schema=schema)
            counts.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not held_out(doc_id):
                    counts.update(words_of(text))
            if len(counts) > 1_000_000:
                yield from emitted()
        yield from emitted()

    return docs.mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def piece_scores(counts: DataFrame, vocabulary: str, ends: int, rounds: int = ROUNDS) -> dict[str, float]:
    """Log10 probability of each piece, and of the end as the empty string.

    Starts from the vocabulary's own segmentation of each word, then ``rounds`` of
    expectation maximisation over all of them. The result has the size of the
    vocabulary, and so has what a task sends.
    """
    processor = _processor(vocabulary)
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    special = {i for i in range(len(pieces)) if processor.is_control(i) or processor.is_unknown(i)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = _processor(vocabulary)
        total = np.zeros(processor.get_piece_size(), np.int64)
        for batch in batches:
            words = [w.decode("utf-8", "replace") for w in batch.column("word").to_pylist()]
            numbers = batch.column("c").to_pylist()
            for ids, c in zip(processor.encode(words, num_threads=1), numbers, strict=True):
                for i in ids:
                    total[i] += c
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], schema=pa.schema([("piece", pa.int32()), ("n", pa.int64())]))

    found = counts.mapInArrow(count, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    numbers = {r.piece: r.n for r in found}
    used = {piece: float(numbers.get(i, 0)) for i, piece in enumerate(pieces) if i not in special}
    scores = _normed(used, ends)
    for _ in range(rounds):
        scores = _normed({**dict.fromkeys(used, 0.0), **_expected_counts(counts, scores)}, ends)
    return scores


def _normed(used: dict[str, float], ends: int) -> dict[str, float]:
    """Log10 shares after adding ``SMOOTHING`` to each piece."""
    used = {**used, "": float(ends)}
    total = sum(used.values()) + SMOOTHING * len(used)
    return {piece: math.log10((n + SMOOTHING) / total) for piece, n in used.items()}


def _expected_counts(counts: DataFrame, scores: dict[str, float]) -> dict[str, float]:
    """Use of each piece in all training words, each over all its segmentations."""
    shared = counts.sparkSession.sparkContext.broadcast(scores)  # the size of the vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices, total = Lattices(Lattice(shared.value)), {}
        words, times = [], []
        for batch in batches:
            words += [word.decode("utf-8", "surrogatepass") for word in batch.column("word").to_pylist()]
            times += batch.column("c").to_pylist()
            if len(words) >= AT_ONCE:
                lattices.expected(words, times, total)
                words, times = [], []
        lattices.expected(words, times, total)
        schema = pa.schema([("piece", pa.string()), ("n", pa.float64())])
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.float64())], schema=schema)

    found = counts.mapInArrow(count, "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    return {r.piece: r.n for r in found.collect()}


# ---------------------------------------------------------------------------
# Scores
# ---------------------------------------------------------------------------

DEALT = pa.schema([("slice", pa.int64()), ("flush", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("d", pa.binary())])
DEALT_SQL = "slice long, flush long, a binary, b binary, c binary, d binary"


def _batch(columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, DEALT.types, strict=True)], schema=DEALT)


def _deal(slices: int, common):
    """Texts to rows of a slice: words, number of texts of each, these texts' places, counts there.

    Words of ``common`` are summed here. The texts of a flush themselves go in a slice of
    their own below 0: ids, which are NULL, numbers of words, sums of their common words.
    """

    def flushed(number: int, texts: list[tuple[int | None, dict, int, tuple]]) -> Iterator[pa.RecordBatch]:
        ids = np.array([0 if i is None else i for i, *_ in texts], "<i8")
        none = np.array([i is None for i, *_ in texts], np.uint8)
        sizes = np.array([n for _, _, n, _ in texts], "<i8")
        sums = np.array([s for *_, s in texts], "<f8")
        yield _batch([[-1 - number], [number], [ids.tobytes()], [none.tobytes()], [sizes.tobytes()], [sums.tobytes()]])
        place: dict[bytes, int] = {}
        words, owners, counts = [], [], []
        for k, (_, own, _, _) in enumerate(texts):
            words += [place.setdefault(w, len(place)) for w in own]
            counts += own.values()
            owners.append(np.full(len(own), k, np.uint16))
        if not place:
            return
        words, counts, owners = np.array(words, np.int64), np.array(counts, "<u4"), np.concatenate(owners)
        names = list(place)
        where = np.array([zlib.crc32(w) % slices for w in names], np.int64)
        # Words in the order of slices; postings in the order of words.
        by_slice = np.argsort(where, kind="stable")
        rank = np.empty(len(names), np.int64)
        rank[by_slice] = np.arange(len(names))
        order = np.argsort(rank[words], kind="stable")
        numbers = np.bincount(rank[words], minlength=len(names))
        upto = np.concatenate([[0], np.cumsum(numbers)])
        owners, counts = owners[order], counts[order]
        starts = np.flatnonzero(np.diff(where[by_slice], prepend=-1))
        ends = np.append(starts[1:], len(names))
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            p, q = upto[a], upto[b]
            yield _batch(
                [
                    [int(where[by_slice[a]])],
                    [number],
                    [b" ".join([names[i] for i in by_slice[a:b].tolist()])],
                    [numbers[a:b].astype("<u4").tobytes()],
                    [owners[p:q].tobytes()],
                    [counts[p:q].tobytes()],
                ]
            )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        scored = common.value
        texts: list[tuple[int | None, dict, int, tuple]] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                rare, base, score, known = {}, [], [], 0
                for word, times in Counter(words).items():
                    row = scored.get(word)
                    if row is None:
                        rare[word] = times
                    else:
                        base.append(times * row[0])
                        score.append(times * row[1])
                        known += times
                texts.append((doc_id, rare, len(words), (math.fsum(base), math.fsum(score), known)))
                size += len(words)
                if size >= FLUSH_WORDS or len(texts) >= FLUSH_TEXTS:
                    yield from flushed(number, texts)
                    number, texts, size = number + 1, [], 0
        if texts:
            yield from flushed(number, texts)

    return deal


def _in_slice(shared):
    """Sums over the words of a slice for each text: base score, lattice score, known tokens."""

    def told(key, dealt: pa.Table, counted: pa.Table) -> pa.Table:
        columns = {name: dealt.column(name).to_pylist() for name in DEALT.names}
        if not columns["slice"]:
            return DEALT.empty_table()
        if columns["slice"][0] < 0:
            return dealt.select(DEALT.names).cast(DEALT)
        scores, n, v = shared.value
        lattices = Lattices(Lattice(scores))
        counts = dict(zip(counted.column("word").to_pylist(), counted.column("c").to_pylist(), strict=True))
        names = list({word for words in columns["a"] for word in words.split(b" ")})
        own = lattices.words([word.decode("utf-8", "surrogatepass") for word in names]).tolist()
        known: dict[bytes, tuple[float, float, int]] = {}
        for word, score in zip(names, own, strict=True):
            c = counts.get(word, 0)
            known[word] = (math.log10((c + 1) / (n + v + 1)), score, c > 0)
        out: dict[str, list] = {name: [] for name in DEALT.names}
        for where, flush, words, numbers, owners, times in zip(*columns.values(), strict=True):
            rows = [known[word] for word in words.split(b" ")]
            numbers = np.frombuffer(numbers, "<u4")
            values = np.repeat(np.array(rows, np.float64), numbers, axis=0) * np.frombuffer(times, "<u4")[:, None]
            owners = np.frombuffer(owners, np.uint16)
            texts, at = np.unique(owners, return_inverse=True)
            sums = [np.bincount(at, values[:, i]) for i in range(3)]
            out["slice"].append(where)
            out["flush"].append(flush)
            out["a"].append(texts.tobytes())
            out["b"].append(sums[0].tobytes())
            out["c"].append(sums[1].tobytes())
            out["d"].append(sums[2].astype("<u4").tobytes())
        return pa.Table.from_pydict(out, schema=DEALT)

    return told


SCORED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)


def _of_flush(shared, ends: int):
    def told(table: pa.Table) -> pa.Table:
        scores, n, v = shared.value
        columns = {name: table.column(name).to_pylist() for name in DEALT.names}
        order = sorted(range(table.num_rows), key=columns["slice"].__getitem__)  # sums in one order always
        head = order[0]
        ids, none = np.frombuffer(columns["a"][head], "<i8"), np.frombuffer(columns["b"][head], np.uint8)
        sizes = np.frombuffer(columns["c"][head], "<i8")
        base = np.full(len(ids), math.log10((ends + 1) / (n + v + 1)))
        score = np.full(len(ids), scores[""])
        known = np.full(len(ids), int(ends > 0), np.int64)
        common = np.frombuffer(columns["d"][head], "<f8").reshape(-1, 3)
        base, score, known = base + common[:, 0], score + common[:, 1], known + common[:, 2].astype(np.int64)
        for i in order[1:]:
            at = np.frombuffer(columns["a"][i], np.uint16)
            base[at] += np.frombuffer(columns["b"][i], np.float64)
            score[at] += np.frombuffer(columns["c"][i], np.float64)
            known[at] += np.frombuffer(columns["d"][i], "<u4")
        doc_ids = [None if no else i for i, no in zip(ids.tolist(), none.tolist(), strict=True)]
        values = [doc_ids, [held_out(i) for i in doc_ids], sizes + 1, known, np.full(len(ids), n), base, score]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(values, SCORED.types, strict=True)], schema=SCORED)

    return told


def lm_scores(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", texts_in_slice: int = TEXTS_IN_SLICE) -> DataFrame:
    """Scores of all texts by a model of the training ones (crc32 of the id modulo 7 is not 2).

    Returns doc_id, held_out, n_tokens and n_known (words and one end), train_tokens,
    base_score (add-one word unigram) and score (lattice), both log10. NULL texts count
    as empty and have the end alone. A NULL id counts as the empty text in the fold. Rows
    that repeat count as often as they occur. Without training texts the scores are those
    of a model that has seen nothing. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    counts = stored(word_counts(named), "words")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    rows = named.agg(F.count("*").alias("all"), F.count_if(fold != HELD_OUT).alias("ends")).first()
    n, v = total.n + rows.ends, total.v + int(rows.ends > 0)
    scores = piece_scores(counts, vocabulary, rows.ends)
    shared = spark.sparkContext.broadcast((scores, n, v))  # the size of the vocabulary
    slices = max(8, -(-rows["all"] // texts_in_slice))
    sliced = counts.select("word", "c", (F.crc32("word") % slices).alias("slice"))
    lattice = Lattice(scores)
    common = {
        bytes(r.word): (math.log10((r.c + 1) / (n + v + 1)), lattice.word(bytes(r.word).decode("utf-8", "surrogatepass")))
        for r in counts.orderBy(F.desc("c"), "word").limit(COMMON).collect()
    }
    dealt = named.mapInArrow(_deal(slices, spark.sparkContext.broadcast(common)), DEALT_SQL)
    told = dealt.groupBy("slice").cogroup(sliced.groupBy("slice")).applyInArrow(_in_slice(shared), DEALT_SQL)
    return told.groupBy("flush").applyInArrow(
        _of_flush(shared, rows.ends),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
