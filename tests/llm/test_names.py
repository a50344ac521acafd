"""Tables may have columns of any name, also those that the operators use for themselves."""

import pytest
from pyspark.sql import functions as F

from evenkeel.llm.exact_dedup import keep_first_copies
from evenkeel.llm.language import with_language
from evenkeel.llm.mixing import mix
from evenkeel.llm.ngram_join import keep_one_of_each
from evenkeel.llm.toxicity import drop_toxic

HELPERS = [
    "_kept_id", "kept_id", "_kept_sha", "_row_id", "row_id", "_row_sha", "row_null", "_toxic_score", "toxic_score", "_told", "told",
    "_plan_rest", "_plan_whole", "_mix_tokens", "_mix_epoch", "_mix_place", "_mix_row", "_mix_lang", "_slice", "_within", "before", "end", "h", "g",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"some words that are of text {i // 2} alone and no other", "en" if i % 3 else None) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return df.select("*", *[F.concat(F.lit(f"{name} "), F.col("doc_id").cast("string")).alias(name) for name in HELPERS])


def check(got, docs):
    assert got.columns == docs.columns
    rows = got.collect()
    for row in rows:
        assert all(row[name] == f"{name} {row.doc_id}" for name in HELPERS)
    return sorted(r.doc_id for r in rows)


def test_helper_columns_of_the_stages(spark, docs):
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert check(keep_first_copies(docs), docs) == [1, 3, 5, 7, 9, 11]
    assert check(keep_one_of_each(docs), docs) == [0, 2, 4, 6, 8, 10]
    assert check(drop_toxic(docs, labels), docs) == list(range(12))
    taken = mix(docs, {"lang": F.col("lang")}, {("en",): 1.0}, 1.0, marks=False)
    assert check(taken, docs) == list(range(12))
    marked = mix(docs, {"lang": F.col("lang")}, {("en",): 1.0}, 1.0)
    assert len(set(marked.columns)) == len(marked.columns) and marked.where("_mix_tokens = 11").count() == 12


def test_helper_columns_of_the_language(docs):
    got = with_language(docs, {"a": ["some words"], "b": ["xyz"]})
    assert got.columns == [*docs.columns, "lang_pred", "score"]
    assert {r._told for r in got.collect()} == {f"_told {i}" for i in range(12)}
