import random
import re
from collections import defaultdict

import pytest

from evenkeel.llm import ngram_join as op
from evenkeel.llm.common import documents
from evenkeel.llm.components import components
from evenkeel.llm.q_ngram_join import op1_ngram_join
from evenkeel.llm.shingles import shingle_sets

DATA = "/root/testdata"
SCHEMA = "doc_id long, text string, component_id string, digest int, n int"


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(texts):
    """{doc_id: (n_shingles, component_id, number of linked sets)} by comparing all sets that share a shingle."""
    sets = {i: shingles(t) for i, t in texts.items()}
    of = defaultdict(list)
    for i, s in sets.items():
        if s:
            of[s].append(i)
    index = defaultdict(list)
    for s in of:
        for token in s:
            index[token].append(s)
    root = {s: s for s in of}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    linked = defaultdict(int)
    for s in of:
        shared = defaultdict(int)
        for token in s:
            for other in index[token]:
                shared[other] += 1
        for other, n in shared.items():
            if other is not s and 100 * n >= 75 * (len(s) + len(other) - n):
                root[find(s)] = find(other)
                linked[s] += 1
    least = {}
    for s, ids in of.items():
        r = find(s)
        least[r] = min(least.get(r, ids[0]), *ids)
    return {i: (len(s), least[find(s)] if s else i, linked[s]) for i, s in sets.items()}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in df.collect()}


def test_sets_are_those_of_the_words():
    texts = [None, "", " \n", "One", "one TWO three four", "a b c d e", "A B c d E f", "é\x85x \x1f y z w", "k a b\ta  b a b a b", "x" * 3_000_000 + " b c d e f"]
    sets = shingle_sets(texts)
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert set(sets[5]) < set(sets[6]) and len(set(sets[3]) & set(shingle_sets(["one"])[0])) == 1
    assert shingle_sets(texts[4:7])[1].tolist() == sets[5].tolist()


def varied(seed):
    """Texts with copies, chains of near copies, a hot cluster and passages that many share."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnop") + str(rng.randrange(60))
    passages = [[word() for _ in range(30)] for _ in range(3)]
    texts, base = [], [word() for _ in range(80)]
    for i in range(160):
        base = list(base) if i % 8 else [word() for _ in range(rng.choice((4, 12, 40, 90)))]
        for _ in range(rng.randrange(0, 3)):
            base[rng.randrange(len(base))] = word()
        text = list(base)
        if i % 3 == 0:
            text[rng.randrange(len(text)) :] += rng.choice(passages)
        texts.append(" ".join(text))
    hot = [word() for _ in range(60)]
    for i in range(120):
        own = list(hot)
        own[rng.randrange(60)] = word()
        texts.append(" ".join(own))
    texts += [texts[3]] * 40 + [" ".join(passages[0])] * 3 + [None, "", "  ", "two words", "Two  WORDS"]
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("seed", range(3))
def test_same_as_brute_force(spark, monkeypatch, seed):
    if seed:
        monkeypatch.setattr(op, "GROUP_SETS", 7)
        monkeypatch.setattr(op, "FLUSH_SETS", 11)
    texts = varied(seed)
    docs = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in texts.items()], SCHEMA).repartition(3)
    assert got(op.ngram_join(docs, docs_in_slice=20)) == brute(texts)


def test_edges_of_75_percent(spark):
    words = [f"w{i}" for i in range(410)]
    rows, texts = [], {}
    for i, (a, b) in enumerate([(75, 25), (74, 25), (300, 100), (299, 100)]):
        # Sets of a and a + b shingles, the first within the second.
        own = [f"{i}{w}" for w in words[: a + b + 4]]
        texts[2 * i], texts[2 * i + 1] = " ".join(own[: a + 4]), " ".join(own)
    rows = [(i, t, "", 1, 1) for i, t in texts.items()]
    result = got(op.ngram_join(spark.createDataFrame(rows, SCHEMA)))
    assert result == brute(texts)
    assert [result[2 * i + 1][1] == 2 * i for i in range(4)] == [True, False, True, False]


def test_rows_of_all_kinds(spark):
    rows = [(5, "a b c d e f g", None, None, None), (5, "a b c d e f g", "x", 1, 1), (None, "a b c d e f g", "x", 1, 1), (7, None, "", 0, 0), (None, None, "", 0, 0), (3, "long " * 200_000 + "text", "", 0, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    result = op.ngram_join(docs)
    assert sorted(((r.doc_id, r.component_id) for r in result.collect()), key=str) == sorted([(5, 5), (5, 5), (None, 5), (7, 7), (None, None), (3, 3)], key=str)
    kept = op.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert op.ngram_join(docs.limit(0)).count() == 0


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100 + i, 200) for i in range(30)] + [(300, 301), (301, 300), (7, 7)]
    rng = random.Random(2)
    rng.shuffle(edges)
    roots = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert roots == {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(30)}, 200: 100, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_against_brute_force(spark):
    sf = f"{DATA}/sf0.001"
    texts = {r.doc_id: r.text for r in documents(spark, sf).collect()}
    assert got(op1_ngram_join(spark, sf)) == brute(texts)
