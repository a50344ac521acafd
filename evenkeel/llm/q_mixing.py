"""Query of mixing."""

from pyspark.sql import DataFrame, SparkSession

from evenkeel.llm.common import documents
from evenkeel.llm.mixing import WEIGHTS, document_levels, mix


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mix(documents(spark, sf_dir), document_levels(), WEIGHTS, budget=0.6, epochs=2, seed=17)
    return taken.selectExpr("doc_id", "_mix_domain AS domain", "lang", "source", "_mix_tokens AS n_words", "CAST(_mix_epoch AS INT) AS epoch")
