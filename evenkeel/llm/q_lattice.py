"""Query of the language-model scores."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from evenkeel.llm.common import documents
from evenkeel.llm.lattice import lm_scores


def op5_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
