"""Toxicity by weak supervision.

1. Voters. Words, and beginnings of words of 3 to 8 letters, that labelled toxic texts
   hold more often than clean ones make lexicons: a voter for each kind and each band of
   odds. Fixed lists and patterns are voters, too. A voter fires on a text or abstains.
   The entries are counted over all labelled texts.
2. Label model. All texts are counted by which voters fire together. From these counts
   alone, expectation maximisation estimates how often each voter fires on toxic and on
   clean texts; the labelled sample only gives the start, and the share of toxic texts,
   which voters that never say "clean" cannot tell. Voters that still agree beyond
   what the class explains are correlated, and share one voice between them.
3. Classifier. A logistic regression over the lexicon entries learns the posterior labels
   of a bounded sample, weighted by the true share of each class. Its prior mean is the fixed list, so it is defined without labels.

Which labelled texts are copies is told by joining hashes. Then the distinct words of each
text, packed, move once to their labels; everything learnt from labels is learnt from them.

Texts, votes and counts are Spark's; the driver sees the lexicon, the counts by vote pattern
(at most 2 ** voters) and the sample's entries. Lexicon entries stand in a share of at least
``RARE`` of the toxic texts, so there are at most the entries of a mean toxic text divided
by ``RARE``, however many texts there are.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import LETTERS, fold, free_name, stored, texts_of, tidied

# Plain insults, by language.
SEED_WORDS = (
    "asshole bastard bitch clown disgusting dumb freak garbage idiot idiotic imbecile loser moron pathetic scum "
    "stupid trash vermin worthless "
    "abschaum arschloch dummkopf idiotisch vollidiot widerlich wertlos "
    "abruti connard crétin imbécile salaud ordure minable "
    "basura cabrón estúpido idiota imbécil inútil asqueroso"
).split()
PATTERNS = {
    "shouting": re.compile(r"(?:\b[A-Z]{4,}\b[ !,.]*){3,}"),
    "outcry": re.compile(r"!{3,}"),
    "address": re.compile(r"(?i)\b(?:you|du|tu|eres)\b[^.!?\n]{0,20}\b(?:are|bist|es|un|una|a|an)\b[^.!?\n]{0,20}!"),
}
CAPITALS = re.compile("[A-Z]{4}")
PREFIXES = (3, 4, 5, 6, 7, 8)
BANDS = (0.5, 1.0, 2.0)  # least odds of an entry, and of stronger ones: logarithms, with two standard errors taken off
RARE = 0.0005  # of the toxic texts: least share that an entry stands in
SAMPLE_TOXIC, SAMPLE_CLEAN = 4000, 8000
LABEL_ACCURACY = 0.998
FLUSH_ENTRIES = 200_000
KNOWN_WORDS = 20_000  # looked-up words that a worker holds, for each of its models
WORD = re.compile(LETTERS)

VOTERS = ["seed", *PATTERNS, *[f"{kind}-{i}" for kind in ("word", *PREFIXES) for i in range(len(BANDS))]]


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def entries_of(words: set[str] | list[str]) -> set[str]:
    """Words and beginnings of words; a beginning ends in ``*`` and is shorter than its word."""
    out = set(words)
    for word in words:
        n = len(word)
        if n > 3:
            out.update([word[:k] + "*" for k in range(PREFIXES[0], min(n, PREFIXES[-1] + 1))])
    return out


def entries(text: str) -> set[str]:
    return entries_of(words_of(text))


def pattern_bits(text: str) -> int:
    """Bits of the pattern voters that fire; cheap tests spare most texts the patterns."""
    mask = 0
    if CAPITALS.search(text) and PATTERNS["shouting"].search(text):
        mask |= 2
    if "!" in text:
        mask |= 4 if "!!!" in text else 0
        mask |= 8 if PATTERNS["address"].search(text) else 0
    return mask


def voter_of(entry: str, odds: float) -> int:
    kind = len(entry) - 1 if entry.endswith("*") else "word"
    return VOTERS.index(f"{kind}-{sum(odds >= least for least in BANDS) - 1}")


@dataclass
class Lexicon:
    """Entries and their places; looks up the entries of a text word by word."""

    place: dict[str, int]

    def __post_init__(self):
        self.known: dict[str, tuple[int, ...]] = {}
        self.heads = {entry.rstrip("*")[:3] for entry in self.place}

    def __getstate__(self):
        return {"place": self.place, "heads": self.heads, "known": {}}

    def of_word(self, word: str) -> tuple[int, ...]:
        places = [self.place.get(word)] + [self.place.get(word[:n] + "*") for n in PREFIXES if n < len(word)]
        return tuple(p for p in places if p is not None)

    def of_words(self, words: set[str] | list[str]) -> set[int]:
        found: set[int] = set()
        known, heads = self.known, self.heads
        if len(known) > KNOWN_WORDS:
            known.clear()
        for word in words:
            if word[:3] in heads:
                places = known.get(word)
                if places is None:
                    places = known[word] = self.of_word(word)
                found.update(places)
        return found

    def of(self, text: str) -> list[int]:
        return sorted(self.of_words(words_of(text)))

    @staticmethod
    def votes(patterns: int, found: set[int] | list[int], voters: list[int]) -> int:
        """Bits of the voters that fire."""
        mask = patterns
        for place in found:
            mask |= voters[place]
        return mask


class LabelModel:
    """Two latent classes with voters that fire independently but for groups of them."""

    def __init__(self, n_voters: int, prior: float = 0.05, abstaining: bool = False):
        """``abstaining``: a voter that does not fire says nothing, rather than "clean"."""
        self.prior, self.abstaining = prior, abstaining
        self.toxic, self.clean = np.full(n_voters, 0.3), np.full(n_voters, 0.003)
        self.voice = np.ones(n_voters)
        self.correlation = np.eye(n_voters)

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        yes = np.log(self.toxic / self.clean) * self.voice
        no = np.log((1 - self.toxic) / (1 - self.clean)) * self.voice
        odds = np.log(self.prior / (1 - self.prior)) + fired @ yes
        if not self.abstaining:
            odds = odds + (1 - fired) @ no
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))

    def start(self, fired: np.ndarray, labels: np.ndarray, prior: float) -> None:
        self.prior = min(0.5, max(1e-4, prior))
        self._rates(fired, labels.astype(float), np.ones(len(labels)))

    def _rates(self, fired, p, n) -> None:
        least = 1e-4
        for name, weight in (("toxic", p * n), ("clean", (1 - p) * n)):
            rate = (weight @ fired + (0.05 if name == "toxic" else 1e-3)) / (weight.sum() + 1)
            setattr(self, name, np.clip(rate, least, 1 - least))
        # A voter is one for toxicity; it may be useless, but not a voter against it.
        self.toxic = np.maximum(self.toxic, self.clean)

    def fit(self, fired: np.ndarray, n: np.ndarray, rounds: int = 30) -> None:
        """EM over vote patterns and their numbers of texts; accuracies, then correlations, in turn."""
        if not n.sum():
            return
        for step in range(rounds):
            p = self.posterior(fired)
            if not self.abstaining:
                self.prior = float(np.clip((p @ n) / n.sum(), 1e-4, 0.5))
            self._rates(fired, p, n)
            if step % 5 == 4:
                self._correlate(fired, p, n)

    def _correlate(self, fired, p, n) -> None:
        """Correlation of residuals given the class, and one voice for those that go together."""
        expected = p[:, None] * self.toxic + (1 - p[:, None]) * self.clean
        rest = (fired - expected) * np.sqrt(n)[:, None]
        covariance = rest.T @ rest
        scale = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
        self.correlation = covariance / np.outer(scale, scale)
        np.fill_diagonal(self.correlation, 1)
        self.voice = 1 / np.maximum(1, np.where(self.correlation > 0.1, self.correlation, 0).sum(1))


def fit_linear(
    rows: list[list[int]], target: np.ndarray, weight: np.ndarray, start: np.ndarray, strength: float = 0.5, rounds: int = 400
) -> np.ndarray:
    """Logistic weights, the bias last; drawn towards ``start``."""
    lengths = np.array([len(r) for r in rows], np.int64)
    columns = np.fromiter((c for r in rows for c in r), np.int64, int(lengths.sum()))
    owner = np.repeat(np.arange(len(rows)), lengths)
    w, size = start.copy(), len(start)
    curve = np.bincount(columns, weight[owner] * 0.25, size)
    curve[-1] = 0.25 * weight.sum()
    # Entries of one text move together, so a step is shared by as many as it may have.
    share = max(1, int(lengths.max(initial=0)) + 1)
    rate = 1 / (curve * share**0.5 + strength)
    speed = np.zeros(size)
    for _ in range(rounds):
        z = np.bincount(owner, w[columns], len(rows)) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - target) * weight
        gradient = np.bincount(columns, error[owner], size)
        gradient[-1] = error.sum()
        speed = 0.8 * speed + gradient + strength * (w - start)
        w -= 0.2 * rate * speed
    return w


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    labels: LabelModel

    def scores(self, texts: list[str]) -> np.ndarray:
        weights, bias = self.weights.tolist(), float(self.weights[-1])
        z = np.array([bias + math.fsum([weights[i] for i in self.lexicon.of_words(words_of(text))]) for text in texts], float)
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _one_label(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic): the largest of each id's labels. Those other than 0 and 1 do not count."""
    return labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to their distinct words, compressed, and the patterns that fire."""
    for batch in batches:
        texts = texts_of(batch.column("text"))
        words = [zlib.compress("\n".join(words_of(text)).encode("utf-8", "surrogatepass"), 1) for text in texts]
        kept = [batch.column(name) for name in ("doc_id", "h", "g")]
        patterns = pa.array([pattern_bits(text) for text in texts], pa.int32())
        yield pa.RecordBatch.from_arrays([*kept, pa.array(words, pa.binary()), patterns], ["doc_id", "h", "g", "words", "patterns"])


def _unpack(words: bytes) -> list[str]:
    text = zlib.decompress(words).decode("utf-8", "surrogatepass")
    return text.split("\n") if text else []


def _labelled(docs: DataFrame, one: DataFrame, learnable: Column) -> DataFrame:
    """(h, g, words, patterns, toxic) of each distinct labelled text, stored.

    Repeated texts count once: they are one witness, a toxic one if any of them is. Which
    row stands for a text is found by joining hashes; its words then move once. Both joins
    are by sorting at every size, so that a small table of labels makes no difference.
    """
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"), F.xxhash64(F.lit("second"), "text").alias("g")).where(learnable)
    told = hashed.select("doc_id", "h", "g").hint("merge").join(one.hint("merge"), "doc_id")
    witnesses = told.groupBy("h", "g").agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    packed = hashed.mapInArrow(tidied(_pack), f"doc_id {kind}, h long, g long, words binary, patterns int")
    keys = ["doc_id", "h", "g"]
    joined = packed.hint("merge").join(witnesses.hint("merge"), keys)
    # A row that repeats its id and text has its copies beside it here.
    once = joined.groupBy(*keys).agg(*[F.first(name).alias(name) for name in ("words", "patterns", "toxic")])
    return stored(once.drop("doc_id"), "labelled")


def _sample(labelled: DataFrame, most: tuple[int, int]) -> DataFrame:
    """At most ``most`` clean and toxic texts, those of the smallest hashes."""
    parts = [labelled.where(F.col("toxic") == kind).select("h", "g").orderBy("h", "g").limit(n) for kind, n in enumerate(most)]
    # At most the sum of ``most`` rows of two numbers.
    return labelled.join(F.broadcast(parts[0].unionAll(parts[1])), ["h", "g"])


def _entry_counts(labelled: DataFrame) -> DataFrame:
    """(entry, clean, toxic): texts that hold each entry; the empty entry is in all texts."""
    schema = pa.schema([("entry", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: tuple[Counter, Counter] = (Counter(), Counter())

        def emitted() -> Iterator[pa.RecordBatch]:
            names = list(by[0].keys() | by[1].keys())
            for i in range(0, len(names), 20_000):
                part = names[i : i + 20_000]
                yield pa.RecordBatch.from_pydict(
                    {"entry": part, "clean": [by[0][e] for e in part], "toxic": [by[1][e] for e in part]}, schema=schema
                )
            by[0].clear()
            by[1].clear()

        for batch in batches:
            for words, toxic in zip(batch.column("words").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                by[toxic].update(entries_of(_unpack(words)))
                by[toxic][""] += 1
                if len(by[0]) + len(by[1]) > FLUSH_ENTRIES:
                    yield from emitted()
        yield from emitted()

    counted = labelled.select("words", "toxic").mapInArrow(tidied(count), "entry string, clean long, toxic long")
    return counted.groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _lexicon(labelled: DataFrame) -> tuple[dict[str, float], float]:
    """Odds of the entries that are learnt, and the share of toxic texts."""
    low = F.col("toxic") - 2 * F.sqrt("toxic")
    # Without this bound, entries that no rule below takes would be stored, too.
    counts = stored(_entry_counts(labelled).where((low > 0) | (F.col("entry") == "")), "entries")
    totals = counts.where("entry = ''").first()
    if not totals or not totals.clean or not totals.toxic:
        return {}, float(totals.toxic > 0) if totals else 0.0
    # Cautious rates: a long clean text has many words, and some are rare by chance.
    high = F.col("clean") + 2 * F.sqrt("clean") + 2
    odds = F.log(low / totals.toxic) - F.log(high / totals.clean)
    learnt = counts.where((F.col("entry") != "") & (low > 0) & (F.col("toxic") >= RARE * totals.toxic)).select("entry", odds.alias("odds"))
    found = learnt.where(F.col("odds") >= BANDS[0]).orderBy("entry").collect()
    return {r.entry: r.odds for r in found}, totals.toxic / (totals.toxic + totals.clean)


@dataclass
class _Prepared:
    """What is learnt from labels before votes are counted."""

    labelled: DataFrame
    names: list[str]
    voters: list[int]
    share: float

    def shared(self):
        lexicon = Lexicon({name: i for i, name in enumerate(self.names)})
        return self.labelled.sparkSession.sparkContext.broadcast((lexicon, self.voters))  # bounded by RARE


def _prepare(named: DataFrame, labels: DataFrame, learnable: Column | None) -> _Prepared:
    one = _one_label(labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")))
    labelled = _labelled(named, one, F.lit(True) if learnable is None else learnable)
    odds, share = _lexicon(labelled)
    names = [*SEED_WORDS, *[entry for entry in odds if entry not in SEED_WORDS]]
    voters = [1 if i < len(SEED_WORDS) else 1 << voter_of(e, odds[e]) for i, e in enumerate(names)]
    return _Prepared(labelled, names, voters, share)


def _fit(prepared: _Prepared, patterns: dict[int, int], most: tuple[int, int]) -> Model:
    """Label model from numbers of texts by votes, classifier from its posterior labels of the sample."""
    shared, names, n_seed, n_voters = prepared.shared(), prepared.names, len(SEED_WORDS), len(VOTERS)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, voters = shared.value
        schema = pa.schema([("entries", pa.list_(pa.int32())), ("votes", pa.int64()), ("toxic", pa.int32())])
        for batch in batches:
            own = [sorted(lexicon.of_words(_unpack(words))) for words in batch.column("words").to_pylist()]
            votes = [lexicon.votes(p, o, voters) for p, o in zip(batch.column("patterns").to_pylist(), own, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.int32())), pa.array(votes, pa.int64()), batch.column("toxic")], schema=schema)

    sample = _sample(prepared.labelled, most).select("words", "patterns", "toxic", "h", "g")
    rows = sample.orderBy("h", "g").mapInArrow(tidied(found), "entries array<int>, votes long, toxic int").collect()
    bits = lambda masks: (np.array(masks, np.int64)[:, None] >> np.arange(n_voters)) & 1
    model = LabelModel(n_voters, abstaining=True)
    start = np.zeros(len(names) + 1)
    start[:n_seed], start[-1] = 6.0, -4.0
    weights = start
    if rows:
        fired, gold = bits([r.votes for r in rows]), np.array([r.toxic for r in rows])
        model.start(fired, gold, prepared.share)
        model.fit(bits(list(patterns)), np.array(list(patterns.values()), float))
        # A label is one more voter, and a good one.
        odds_of_label = np.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY)) * np.where(gold == 1, 1, -1)
        p = model.posterior(fired)
        p = 1 / (1 + (1 - p) / np.maximum(p, 1e-12) * np.exp(-odds_of_label))
        # Each class weighs as in all labels, whatever its part of the sample.
        part, share = gold.mean(), prepared.share
        weight = np.where(gold == 1, share / max(part, 1e-12), (1 - share) / max(1 - part, 1e-12))
        weights = fit_linear([r.entries for r in rows], p, weight, start)
    return Model(Lexicon({name: i for i, name in enumerate(names)}), weights, model)


def train(
    docs: DataFrame,
    labels: DataFrame,
    text_column: str = "text",
    id_column: str = "doc_id",
    most_toxic: int = SAMPLE_TOXIC,
    most_clean: int = SAMPLE_CLEAN,
    learnable: Column | None = None,
) -> Model:
    """Model from ``labels`` (doc_id, toxic) and all texts of ``docs``.

    The caller leaves out labels that must not be learnt from; ``learnable``, a condition on
    ``doc_id``, spares texts that no label is for the way to the labels. Rows of ``labels``
    without an id or with a label other than 0 and 1 do not count; of several labels of an
    id, and of equal texts, the largest does. Without toxic or without clean labelled texts
    the fixed lists alone decide. ``most_toxic`` and ``most_clean`` bound the texts that the
    classifier is fitted to; entries and votes are counted over all.
    """
    named = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    prepared = _prepare(named, labels, learnable)
    votes = named.select(_found(prepared.shared(), "text").alias("found")).groupBy("found.votes").agg(F.count("*").alias("n"))
    return _fit(prepared, {r.votes: r.n for r in votes.collect()}, (most_clean, most_toxic))


def _found(shared, text_column: str) -> Column:
    """Lexicon entries and votes of each text."""

    @F.pandas_udf("entries array<int>, votes long")
    def found(texts: pd.Series) -> pd.DataFrame:
        lexicon, voters = shared.value
        own = [lexicon.of_words(words_of(text)) for text in texts]
        votes = [lexicon.votes(pattern_bits(text), o, voters) for text, o in zip(texts, own, strict=True)]
        return pd.DataFrame({"entries": [sorted(o) for o in own], "votes": np.array(votes, np.int64)})

    return found(F.coalesce(F.col(text_column), F.lit("")))


def train_and_score(
    docs: DataFrame,
    labels: DataFrame,
    column: str,
    keep: list[str],
    learnable: Column | None = None,
    text_column: str = "text",
    id_column: str = "doc_id",
) -> DataFrame:
    """Columns ``keep`` of ``docs`` and the score of each text, by a model as of ``train``.

    Texts are read for their votes and their scores once: what the lexicon finds in them is
    stored with the kept columns.
    """
    named = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    prepared = _prepare(named, labels, learnable)
    mark = free_name(docs, "found")
    marked = stored(docs.withColumn(mark, _found(prepared.shared(), text_column)).select(*keep, mark), "found")
    votes = marked.groupBy(F.col(mark)["votes"].alias("votes")).agg(F.count("*").alias("n")).collect()
    model = _fit(prepared, {r.votes: r.n for r in votes}, (SAMPLE_CLEAN, SAMPLE_TOXIC))
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)  # one number for each entry

    @F.pandas_udf("double")
    def score(entries: pd.Series) -> pd.Series:
        own = weights.value
        z = np.array([own[-1] + math.fsum(own[np.asarray(e, np.int64)].tolist()) for e in entries], float)
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -60, 60))), index=entries.index)

    return marked.select(*keep, score(F.col(mark)["entries"]).alias(column))


def with_score(docs: DataFrame, model: Model, column: str, text_column: str = "text") -> DataFrame:
    """``docs`` with the score of each text, 0 to 1, in a new column. NULL counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast((model.lexicon, model.weights))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(Model(*shared.value, None).scores([text or "" for text in texts]), index=texts.index)

    return docs.withColumn(column, score(F.coalesce(F.col(text_column), F.lit(""))))


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels outside the held-out fold: crc32 of the id modulo 5 is not 0."""
    return labels.where(learnable())


def learnable(doc_id: str = "doc_id") -> Column:
    """Condition on ids that labels may be learnt for."""
    return fold(doc_id, 5) != 0


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the texts that score 0.5 or more, all columns as they were.

    Any column names are allowed.
    """
    score = free_name(docs, "toxic_score")
    scored = train_and_score(docs, training_labels(labels), score, docs.columns, learnable())
    return scored.where(F.col(score) < 0.5).select(*docs.columns)
