"""Language of a text by cross-parsing entropy.

For each language a suffix automaton holds all substrings of a bounded sample of labelled
text. A text is parsed against it greedily into the longest phrases that occur there;
c phrases over N characters against a sample of n characters estimate the cross entropy
c * log2(n) / N. The language with the least wins.

Texts are parsed in blocks of ``BLOCK`` characters, which a phrase does not cross, many
blocks in step. Whole texts are parsed, whatever their length.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import MARKS, free_name

CHARS = 40_000  # of sample text for each language, however many there are
TEXTS = 128  # sampled texts for each language
SHORT = 8_000  # characters of a text that the sample prefers
DENSE = 32_000_000  # places in dense tables, for all languages together; which table is used changes no result
BLOCK = 256
AT_ONCE = 2_000_000  # characters parsed in step
UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")
NO_LETTERS = re.compile(r"[\W\d_]+")
# Combining marks are parts of the words of many scripts; most texts have none.
MARK = re.compile(f"[{MARKS}]")
NEITHER = re.compile(rf"(?:(?![{MARKS}])[\W\d_])+")


def plain(text: str) -> str:
    """Letters and their marks in lower case, each run of anything else one space: signs tell no language."""
    low = text.lower()
    return (NEITHER if MARK.search(low) else NO_LETTERS).sub(" ", low)


class Alphabet:
    """Numbers 1.. for all characters of the samples; others are 0."""

    def __init__(self, samples: list[str]):
        known = sorted(set().union(*samples))
        self.size = len(known) + 1
        self.number = np.zeros(0x110000, np.min_scalar_type(self.size))
        self.number[[ord(c) for c in known]] = np.arange(1, self.size)

    def of(self, text: str) -> np.ndarray:
        return self.number[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]


class Dense:
    """(state, symbol) -> state in a table of all pairs."""

    def __init__(self, edges_of: list[dict[int, int]], size: int):
        table = np.full((len(edges_of), size), -1, np.int32)
        for state, edges in enumerate(edges_of):
            if edges:
                table[state, list(edges)] = list(edges.values())
        self.flat, self.size, self.root = table.ravel(), size, np.maximum(table[0], 0)

    def of(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Next states; -1 where there is none."""
        return self.flat[states * self.size + symbols]


class Hashed:
    """The same in a hash table with open places; memory by edges, not by pairs."""

    def __init__(self, edges_of: list[dict[int, int]], size: int):
        self.size = size
        counts = np.array([len(edges) for edges in edges_of], np.int64)
        symbols = np.fromiter((c for edges in edges_of for c in edges), np.int64, int(counts.sum()))
        targets = np.fromiter((t for edges in edges_of for t in edges.values()), np.int32, len(symbols))
        keys = np.repeat(np.arange(len(edges_of)), counts) * size + symbols
        bits = max(1, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.targets = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        places = self._place(keys)
        while len(keys):
            free = self.keys[places] < 0
            self.keys[places[free]] = keys[free]  # of several, one stays
            own = self.keys[places] == keys
            self.targets[places[own]] = targets[own]
            keys, targets, places = keys[~own], targets[~own], (places[~own] + 1) & self.mask
        self.root = np.maximum(self.of(np.zeros(size, np.int64), np.arange(size)), 0)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def of(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Next states; -1 where there is none."""
        keys = states * self.size + symbols
        places = self._place(keys)
        there = self.keys[places]
        out = self.targets[places]
        wrong = np.flatnonzero(there != keys)
        out[wrong] = -1
        # Places that another edge holds: the next one, until the edge or an open place.
        wrong = wrong[there[wrong] >= 0]
        while len(wrong):
            places[wrong] = (places[wrong] + 1) & self.mask
            there = self.keys[places[wrong]]
            right = there == keys[wrong]
            out[wrong[right]] = self.targets[places[wrong[right]]]
            wrong = wrong[~right & (there >= 0)]
        return out


def suffix_automaton(symbols: np.ndarray, size: int, room: int = DENSE) -> Dense | Hashed:
    """Transitions of all substrings that have no symbol 0; in a dense table of at most ``room`` places, else hashed.

    State 0 is the start. Symbol 0 separates texts: what follows it starts anew.
    """
    next_of: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols.tolist():
        if not symbol:
            last = 0
            continue
        known = next_of[last].get(symbol)
        if known is not None:
            # The string is there from an earlier text; at most its state is split.
            if length[known] == length[last] + 1:
                last = known
                continue
            state = _split(next_of, link, length, last, symbol, known)
            last = state
            continue
        state = len(next_of)
        next_of.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and symbol not in next_of[at]:
            next_of[at][symbol] = state
            at = link[at]
        if at != -1:
            other = next_of[at][symbol]
            link[state] = other if length[other] == length[at] + 1 else _split(next_of, link, length, at, symbol, other)
        last = state
    return (Dense if len(next_of) * size <= room else Hashed)(next_of, size)


def _split(next_of, link, length, at, symbol, other) -> int:
    """New state for the strings of ``other`` that end an edge from ``at`` or its links."""
    clone = len(next_of)
    next_of.append(dict(next_of[other]))
    length.append(length[at] + 1)
    link.append(link[other])
    link[other] = clone
    while at != -1 and next_of[at].get(symbol) == other:
        next_of[at][symbol] = clone
        at = link[at]
    return clone


class Parser:
    """Automata of all languages, in the order of their names."""

    def __init__(self, samples: dict[str, list[str]]):
        self.names = sorted(samples)
        texts = {name: [plain(t) for t in samples[name]] for name in self.names}
        self.alphabet = Alphabet([t for name in self.names for t in texts[name]])
        self.tables, self.bits, self.own = [], [], []
        room = DENSE
        for name in self.names:
            joined = np.concatenate([np.append(self.alphabet.of(t), 0) for t in texts[name]] or [np.zeros(1, np.uint8)])
            # A language's automaton has the symbols of its own sample, numbered anew.
            own = np.unique(joined[joined > 0])
            self.own.append(np.zeros(self.alphabet.size, np.min_scalar_type(len(own))))
            self.own[-1][own] = np.arange(1, len(own) + 1)
            self.tables.append(suffix_automaton(self.own[-1][joined], len(own) + 1, room))
            if isinstance(self.tables[-1], Dense):
                room -= len(self.tables[-1].flat)
            self.bits.append(np.log2(max(2, len(joined))))

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """(text, language): numbers of phrases."""
        lengths = np.array([len(t) for t in texts], np.int64)
        joined = np.concatenate([*texts, np.zeros(BLOCK, np.uint8)])
        starts = np.cumsum(lengths) - lengths
        blocks = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        within = (np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * BLOCK
        size = np.minimum(BLOCK, lengths[owner] - within)
        order = np.argsort(-size, kind="stable")
        owner, size, first = owner[order], size[order], (starts[owner] + within)[order]
        active = np.searchsorted(-size, -np.arange(BLOCK), side="left")  # blocks longer than each step
        out = np.zeros((len(texts), len(self.names)), np.int64)
        for k, table in enumerate(self.tables):
            symbols = self.own[k][joined]
            state = np.zeros(len(owner), np.int64)
            count = np.zeros(len(owner), np.int64)
            for step in range(int(size[0]) if len(size) else 0):
                n = active[step]
                symbol = symbols[first[:n] + step]
                then = table.of(state[:n], symbol)
                ended = then < 0
                count[:n] += ended
                state[:n] = np.where(ended, table.root[symbol], then)
            count += state > 0
            out[:, k] = np.bincount(owner, count, len(texts)).astype(np.int64)
        return out

    def entropies(self, texts: list[str]) -> np.ndarray:
        """(text, language): bits for each character."""
        out = np.zeros((len(texts), len(self.names)))
        at = 0
        while at < len(texts):
            group, chars = [], 0
            while at + len(group) < len(texts) and (not group or chars < AT_ONCE):
                group.append(self.alphabet.of(plain(texts[at + len(group)])))
                chars += len(group[-1])
            n = np.maximum(1, [len(g) for g in group])
            out[at : at + len(group)] = self.phrases(group) * np.array(self.bits) / n[:, None]
            at += len(group)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        told = [i for i, t in enumerate(texts) if t is not None and LETTER.search(t)] if self.names else []
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if told:
            bits = self.entropies([texts[i] for i in told])
            best = bits.argmin(1)
            # Evidence grows with the length, up to a few hundred characters.
            n = np.minimum(300, [len(texts[i]) for i in told])
            behind = (bits - bits.min(1, keepdims=True)) * n[:, None] / 8
            sure = 1 / np.exp(-np.minimum(behind, 60)).sum(1)
            for i, b, s in zip(told, best.tolist(), sure.tolist(), strict=True):
                names[i], scores[i] = self.names[b], s
        return names, scores


def sample_texts(
    docs: DataFrame, text_column: str, lang_column: str, texts: int = TEXTS, chars: int = CHARS
) -> dict[str, list[str]]:
    """Labelled texts of each language, at most ``chars`` characters of each.

    Different texts in the order of their hashes, those up to ``SHORT`` characters first.
    Only a language without any text within that bound has one cut to it.
    """
    named = docs.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text")).where(
        "lang IS NOT NULL AND text RLIKE '[^ ]'"
    )
    marked = named.withColumns({"h": F.xxhash64("text"), "long": F.length("text") > SHORT})
    order = Window.partitionBy("lang").orderBy("long", "h")
    # Spark keeps the first rows of each task before it brings a language together.
    first = marked.select("lang", "h", "long").distinct().withColumn("rank", F.row_number().over(order))
    chosen = first.where(F.col("rank") <= texts).select("lang", "h", "rank")
    # ``texts`` rows of two numbers and a name for each language.
    rows = (
        marked.join(F.broadcast(chosen), ["lang", "h"])
        .groupBy("lang", "rank")
        .agg(F.min(F.substring("text", 1, chars + 1)).alias("text"))
        .collect()
    )
    out: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r.lang, r.rank)):
        own = out.setdefault(row.lang, [])
        room = chars - sum(map(len, own))
        if len(row.text) <= room:
            own.append(row.text)
    for row in sorted(rows, key=lambda r: (r.lang, r.rank)):
        if not out[row.lang]:
            out[row.lang].append(row.text[:chars])
    return out


_PARSERS: dict[int, Parser] = {}


def with_language(docs: DataFrame, samples: dict[str, list[str]], text_column: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1) of each whole text.

    NULL texts and texts without a letter are ``und`` with score 0, and so is every text
    if ``samples`` is empty. Languages that tie: the first by name. Every row gives one
    row. Columns of ``docs`` with these two names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(samples)  # at most CHARS characters for each language

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        # Tasks of one worker process share the automata.
        key = hash(tuple((name, *own) for name, own in sorted(shared.value.items())))
        if key not in _PARSERS:
            _PARSERS.clear()
            _PARSERS[key] = Parser(shared.value)
        names, scores = _PARSERS[key].predict([None if t is None else t for t in texts])
        return pd.DataFrame({"lang_pred": names, "score": scores})

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    name = free_name(docs, "told")
    told = docs.select(*kept, predict(F.col(text_column)).alias(name))
    return told.select(*kept, f"{name}.lang_pred", f"{name}.score")
