import math
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest

from evenkeel.llm import lattice as op
from evenkeel.llm.common import documents
from evenkeel.llm.q_lattice import op5_lattice_scores

DATA = "/root/testdata"
PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, score string, word int, c int"


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def brute(rows):
    counts = Counter(t for i, text in rows if not fold(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        out.append((i, fold(i), len(own), sum(counts[t] > 0 for t in own), n, base))
    return out


def same(got, expected):
    key = lambda r: (str(r[0]), r[2], r[5])
    got, expected = sorted(got, key=key), sorted(expected, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert all(math.isclose(a[5], b[5], rel_tol=1e-9) for a, b in zip(got, expected, strict=True))


def test_all_segmentations():
    scores = {"▁": -1.0, "▁a": -0.5, "a": -0.7, "ab": -0.9, "b": -1.1, "bc": -0.3, "c": -2.0, **{f"<0x{i:02X}>": -3.0 for i in range(256)}}

    def total(text):
        if not text:
            return 1.0
        out = sum(10 ** scores[text[:n]] * total(text[n:]) for n in range(1, len(text) + 1) if text[:n] in scores)
        if text[0] not in scores:
            out += 10 ** (-3.0 * len(text[0].encode())) * total(text[1:])
        return out

    lattice = op.Lattice(scores)
    for word in ("a", "abc", "abcabc", "xé", "cab🙂c", "b" * 40):
        assert math.isclose(lattice.word(word), math.log10(total("▁" + word)), rel_tol=1e-9)
    assert -1e6 < lattice.word("abc" * 3000) < -1000
    for word in ("abc", "xé", "🙂ab"):
        used = {}
        lattice.expected(word, 5, used)
        chars = sum(n * len(piece) for piece, n in used.items() if not piece.startswith("<0x"))
        fallback = sum(n for piece, n in used.items() if piece.startswith("<0x"))
        known = [c for c in "▁" + word if c in scores]
        assert math.isclose(chars, 5 * len(known)) and math.isclose(fallback, 5 * sum(len(c.encode()) for c in word if c not in scores), abs_tol=1e-9)


@pytest.mark.parametrize("word", ["🙂" * 29, "🙂" * 5 + "a" + "漢" * 3, "漢" * 9 + "🙂", "🙂" * 7, "a🙂b" * 5])
def test_words_of_unknown_characters(word):
    # Bytes seen once among 1e10 pieces: 28 of them are less than the smallest number.
    scores = {"▁": -1.0, "▁a": -0.5, "a": -0.7, "b": -1.1, "": -2.0, **{f"<0x{i:02X}>": -10.0 - i / 1000 for i in range(256)}}
    used, expected = {}, {}
    lattice = op.Lattice(scores)
    op.Lattices(lattice).expected([word], [3], used)
    lattice.expected(word, 3, expected)
    assert used.keys() == expected.keys()
    assert all(math.isclose(used[k], expected[k], rel_tol=1e-9, abs_tol=1e-12) for k in used)
    fallback = sum(n for piece, n in used.items() if piece.startswith("<0x"))
    assert math.isclose(fallback, 3 * sum(len(c.encode()) for c in word if c not in scores), rel_tol=1e-9)


def test_byte_pieces_are_no_text():
    scores = {c: -4.0 for c in "▁<0x41>"} | {f"<0x{i:02X}>": -1.0 for i in range(256)} | {"": -0.5}
    lattice = op.Lattice(scores)
    assert math.isclose(lattice.word("<0x41>"), -28.0) and math.isclose(op.Lattices(lattice).words(["<0x41>"])[0], -28.0)
    assert math.isclose(lattice.word("A"), -5.0)
    used = {}
    op.Lattices(lattice).expected(["<0x41>"], [2], used)
    assert used == pytest.approx({c: 2.0 * "▁<0x41>".count(c) for c in "▁<0x41>"})


def test_many_words_at_once_equal_one_by_one():
    rng = random.Random(3)
    letters = "abcdeé漢🙂"
    pieces = {"".join(rng.choice("▁abcd漢") for _ in range(rng.randrange(1, 6))) for _ in range(400)} | set("▁abc漢")
    scores = {p: -rng.random() * 6 - 0.5 for p in sorted(pieces)} | {f"<0x{i:02X}>": -7.0 - i / 500 for i in range(256)} | {"": -1.0}
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 45))) for _ in range(600)] + ["", "a", "🙂" * 20]
    times = [rng.randrange(1, 9) for _ in words]
    lattice = op.Lattice(scores)
    assert all(math.isclose(a, lattice.word(w), rel_tol=1e-9) for a, w in zip(op.Lattices(lattice).words(words), words, strict=True))
    together, single = {}, {}
    op.Lattices(lattice).expected(words, times, together)
    for word, n in zip(words, times, strict=True):
        lattice.expected(word, n, single)
    for piece in single.keys() | together.keys():
        assert math.isclose(single.get(piece, 0), together.get(piece, 0), rel_tol=1e-8, abs_tol=1e-9)


@pytest.mark.parametrize("flush", [3, op.FLUSH_TEXTS])
def test_rows_of_all_kinds(spark, monkeypatch, flush):
    monkeypatch.setattr(op, "FLUSH_TEXTS", flush)
    texts = [None, "", " \t\n", "One one ONE", "Éa éa a\x85b", "long word " * 100_000, "x" * 20_000, "漢字 🙂"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "One one ONE")] * 2 + [(None, "no id"), (None, None)]
    rows += [(100 + i, f"word{i % 13} and {'and ' * (i % 5)} other{i}") for i in range(200)]
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in op.lm_scores(docs, PATH, texts_in_slice=20).collect()]
    same(got, brute(rows))
    assert all(r[6] < 0 and math.isfinite(r[6]) for r in got)
    assert op.lm_scores(docs.limit(0), PATH).count() == 0


def test_query_and_held_out_likelihood(spark):
    sf = f"{DATA}/sf0.001"
    rows = [(r.doc_id, r.text) for r in documents(spark, sf).collect()]
    got = [tuple(r) for r in op5_lattice_scores(spark, sf).collect()]
    same(got, brute(rows))
    # Better than the same vocabulary without what was learnt of the texts.
    pieces = op.piece_scores(spark.createDataFrame([], "word binary, c long"), PATH, 0)
    plain = op.Lattice(pieces)
    texts = dict(rows)
    held = [r for r in got if r[1]]
    unlearnt = sum(plain.word(t) for r in held for t in tokens(texts[r[0]])[:-1])
    assert 0.7 * unlearnt < sum(r[6] for r in held)
    by_rounds = [_total(spark, sf, n) for n in (0, 1, 2)]
    assert by_rounds == sorted(by_rounds)


def _total(spark, sf, rounds):
    """Log likelihood of the training words."""
    counts = op.word_counts(documents(spark, sf).select("doc_id", "text"))
    lattice = op.Lattice(op.piece_scores(counts, PATH, 100, rounds))
    return sum(r.c * lattice.word(bytes(r.word).decode()) for r in counts.collect())
