"""Documents to packed training sequences, stage by stage.

Each stage takes what the one before it kept. Its result is written to the shared folder
and read again, so a lost executor costs no more than the stage at hand.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from evenkeel.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from evenkeel.llm.common import documents, stored

VOCABULARY = "byte_bpe_50k.json"
MIX_BUDGET, MIX_SEED = 0.8, 17


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.5."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact_dedup.keep_first_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that links connect the one with the smallest doc_id."""
    return ngram_join.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Most of the words, by domain, language and source; no document twice."""
    return mixing.mix(docs, mixing.document_levels(), mixing.WEIGHTS, MIX_BUDGET, epochs=1, seed=MIX_SEED, marks=False)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with their token ids and these ids' checksums."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY)).selectExpr("*", "crc32(ids) AS ids_crc32")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

# The classifier and the tokenizer have no equal in SQL; tests/llm/test_pipeline.py checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
