"""Query of packing."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from evenkeel.llm.common import documents
from evenkeel.llm.packing import digested, pack

VOCABULARY = "byte_bpe_50k.json"


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(pack(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY)))
