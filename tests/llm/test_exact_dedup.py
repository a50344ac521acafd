import hashlib
from collections import defaultdict

import pytest

from evenkeel.llm.exact_dedup import exact_dedup, keep_first_copies

SCHEMA = "doc_id long, text string, lang string, keep_id string, `bucket` long"


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    expected = []
    for doc_id, text, *_ in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256((text or "").encode()).hexdigest()
        expected.append((doc_id, keep, len(ids), doc_id == keep, sha))
    return sorted(expected, key=str)


ROWS = [
    (1, "a", "en", "x", 1),
    (2, "a", None, None, None),
    (2, "a", None, None, None),
    (3, None, "en", "x", 1),
    (4, "", "en", "x", 1),
    (5, "A", "en", "x", 1),
    (6, "a ", "en", "x", 1),
    (None, "a", "en", "x", 1),
    (None, "lonely", "en", "x", 1),
    (7, "long " * 200_000, "en", "x", 1),
    (8, "long " * 200_000, "en", "x", 1),
    *[(100 + i, f"copy {i % 37}", "de", "y", 2) for i in range(300)],
]


@pytest.mark.parametrize(("page_keys", "key_bits"), [(4096, 64), (4, 64), (2, 3), (1, 1)])
def test_same_as_brute_force(spark, page_keys, key_bits):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = exact_dedup(docs, page_keys=page_keys, key_bits=key_bits)
    rows = [tuple(r)[:5] for r in got.collect()]
    assert sorted(rows, key=str) == brute(ROWS)
    if key_bits < 5:
        assert got.agg({"chain_length": "max"}).first()[0] > 1


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_stage_keeps_one_row_of_each_text(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    kept = keep_first_copies(docs)
    assert kept.columns == docs.columns
    rows = [tuple(r) for r in kept.collect()]
    assert len(rows) == len({(r[1] or "") for r in ROWS})
    assert (2, "a", None, None, None) in rows
