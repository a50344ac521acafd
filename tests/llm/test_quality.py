import re
from collections import Counter

import pytest

from evenkeel.llm.q_quality import COLUMNS, ORACLE, op6_quality
from evenkeel.llm.quality import PARENT_TEXTS, SLACK, SPREADS, _measures, measured, quality, sketches, thresholds
from oracle import assert_same, duck

DATA = "/root/testdata"
SCHEMA = "doc_id long, text string, lang string, source string, kept string, n long, words int"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {p for i, w in enumerate(windows) if often[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed)


TEXTS = [
    None, "", " \n\t\x0b ", "a a a a a", "one two three one two three one", "x y", "a\n\na\n a\na\r\n", "é\x85è | <b> #1 & 100%",
    "The same line.\n" * 60, " ".join(f"w{i % 50}" for i in range(120)), "word " * 100_000, "ñ🙂 " * 55,
    " ".join(f"w{i}" for i in range(200)),
]


def test_rows_of_all_kinds(spark):
    rows = [(i, t, [None, "en"][i % 2], ["s", None, "t"][i % 3], "clash", 1, 2) for i, t in enumerate(TEXTS)]
    rows += [rows[3], (None, "null id", None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = quality(docs).collect()
    counts = sorted(((r.doc_id, *[r[c] for c in COLUMNS[:-1]]) for r in got), key=str)
    assert counts == sorted(((r[0], *brute(r[1])) for r in rows), key=str)
    assert all(not r.kept for r in got if r.base_failed)
    assert next(r.kept for r in got if r.doc_id == 12)
    assert quality(docs.limit(0)).count() == 0


def test_thresholds_follow_their_group(spark):
    tidy = [(i, " ".join(f"w{(i * 31 + j) % 997}x{j}" for j in range(60)), "en", "prose", "", 1, 1) for i in range((4 * PARENT_TEXTS))]
    tables = [(1000 + i, " | ".join(f"c{i}x{j}" for j in range(60)), "en", "tables", "", 1, 1) for i in range((4 * PARENT_TEXTS))]
    odd = [(5000, " | ".join(f"c{j}" for j in range(60)), "en", "prose", "", 1, 1)]
    got = {r.doc_id: r for r in quality(spark.createDataFrame(tidy + tables + odd, SCHEMA)).collect()}
    assert got[5000].failed_rules [:1] == ["symbol_share_high"] and not got[5000].kept
    assert all(got[r[0]].kept for r in tidy + tables)


def test_a_pair_leaves_its_parent_by_and_by(spark):
    """The limits of a pair, from none of its weight to most of it, against plain weighting of the values."""
    few = 16000
    seen = []
    for n in (0, 1, 10, 60, 99, 100, 101, 300, 2000):
        rows = [("en", "a", "mean_word", 8000, 900)] + ([("en", "b", "mean_word", few, n)] if n else [])
        got = {r.source: r for r in thresholds(spark.createDataFrame(rows, "lang string, source string, measure string, bucket long, n long")).collect()}
        up_all = 900 / (900 + n)  # share of all texts, and of the language, at 8000
        up = {"a": (900 + PARENT_TEXTS * up_all) / (900 + PARENT_TEXTS), "b": PARENT_TEXTS * up_all / (n + PARENT_TEXTS)}
        for source in got:
            q1, q3 = (8000 if up[source] * 4 >= k else few for k in (1, 3))
            assert got[source].mean_word_high == q3 + SPREADS * (q3 - q1) + SLACK["mean_word"]
            assert got[source].mean_word_low == q1 - SPREADS * (q3 - q1) - SLACK["mean_word"]
        seen += [got["b"].mean_word_low] if n else []
    assert seen[0] == 8000 - SLACK["mean_word"] and seen[-1] == few - SLACK["mean_word"]


def test_sketches_merge(spark):
    docs = spark.createDataFrame([(i, f"a{'b' * (i % 40)} " * 60, "en", f"s{i % 4}", "", 1, 1) for i in range(200)], SCHEMA)
    of = lambda df: {tuple(r)[:4]: r.n for r in sketches(_measures(measured(df))).collect()}
    both = Counter(of(docs.where("doc_id < 77"))) + Counter(of(docs.where("doc_id >= 77")))
    assert both == Counter(of(docs))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_same_as_sql(spark, sf):
    assert_same(op6_quality(spark, f"{DATA}/{sf}"), duck(f"{DATA}/{sf}"), ORACLE)
