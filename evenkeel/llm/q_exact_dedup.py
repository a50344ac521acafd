"""Query and SQL of exact deduplication."""

from pyspark.sql import DataFrame, SparkSession

from evenkeel.llm.common import documents
from evenkeel.llm.exact_dedup import exact_dedup


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).drop("chain_length")


ORACLE = """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
