"""Each stage against a brute-force version on what the stage before it kept."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from evenkeel.llm import mixing
from evenkeel.llm.common import documents, stored
from test_mixing import brute as mixed_by_brute_force
from test_ngram_join import brute as linked_by_brute_force

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage returns."""
    docs, out = documents(spark, SF), [documents(spark, SF)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name.replace(" ", "_"))
        out.append(docs)
    return out


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_columns_stay_to_the_last_stage(kept):
    assert [df.columns for df in kept[:-1]] == [kept[0].columns] * 5
    assert [set(rows(a)) >= set(rows(b)) for a, b in zip(kept, kept[1:-1])] == [True] * 4  # noqa: B905


def test_toxicity_drops_labelled_toxic_and_no_clean_text(spark, kept):
    left = {r.doc_id for r in kept[1].collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in kept[0].collect()}
    assert all(i in left for i, toxic in labels.items() if not toxic)
    insults = ("idiot", "moron", "stupid", "scum")
    assert not any(word in texts[i].lower().split() for i in left for word in insults)


def test_exact_dedup_keeps_the_largest_id(kept):
    largest = defaultdict(int)
    for r in kept[1].collect():
        largest[r.text] = max(largest[r.text], r.doc_id)
    assert {r.doc_id for r in kept[2].collect()} == set(largest.values())


def test_join_keeps_the_smallest_id_of_each_component(kept):
    told = linked_by_brute_force({r.doc_id: r.text for r in kept[2].collect()})
    assert {r.doc_id for r in kept[3].collect()} == {component for _, component, _ in told.values()}


def test_mixing_takes_what_sorting_each_leaf_takes(kept):
    levels = mixing.document_levels()
    place = F.xxhash64(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), F.lit(corpus_pipeline.MIX_SEED))
    marked = kept[3].withColumns({"domain": levels["domain"], "place": place}).collect()
    leaves = [((r.domain, r.lang, r.source), len((r.text or "").split())) for r in marked]
    copies = mixed_by_brute_force(leaves, None, None, mixing.WEIGHTS, corpus_pipeline.MIX_BUDGET, 1, lambda i, e: marked[i].place)
    assert rows(kept[4].select("doc_id")) == sorted((r.doc_id,) for r, n in zip(marked, copies, strict=True) if n)


def test_packing_holds_each_id_once(kept):
    encode = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY)).encode
    pieces = defaultdict(list)
    for p in kept[5].collect():
        pieces[p.doc_id].append(p)
    texts = {r.doc_id: r.text for r in kept[4].collect()}
    assert pieces.keys() == texts.keys()
    for doc_id, text in texts.items():
        own = sorted(pieces[doc_id], key=lambda p: p.start)
        joined = np.concatenate([np.frombuffer(bytes(p.ids), "<u4") for p in own]).tolist()
        assert joined == encode(text or "", add_special_tokens=False).ids + [0]
        assert all(zlib.crc32(bytes(p.ids)) == p.ids_crc32 for p in own)


def test_registered(spark):
    assert __spark_entry__.queries()["pipeline"].__wrapped__ is corpus_pipeline.run
    assert "pipeline" not in __spark_entry__.oracle_sql()
    assert [f"op{n}_" for n in range(1, 14)] == sorted({q.split("_")[0] + "_" for q in __spark_entry__.queries() if q.startswith("op")}, key=lambda q: int(q[2:-1]))


def test_stages_on_nothing_and_on_nulls(spark):
    schema = documents(spark, SF).schema
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, None, None, 0), (2, "", "en", None, 0), (3, "a b", None, "x", 3), (3, "a b", None, "x", 3)], schema)
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF), name.replace(" ", "_"))
        docs.collect()
