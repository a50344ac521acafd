"""Query of language identification."""

from pyspark.sql import DataFrame, SparkSession

from evenkeel.llm.common import documents, fold
from evenkeel.llm.language import sample_texts, with_language


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    samples = sample_texts(docs.where(fold("doc_id", 5) != 0), "text", "lang")
    told = with_language(docs.select("doc_id", "text"), samples)
    return told.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
