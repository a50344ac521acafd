"""Query of the token-id output."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from evenkeel.llm.common import documents
from evenkeel.llm.records import digests, read_records, write_records
from evenkeel.session import scratch_path


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "records")
    write_records(documents(spark, sf_dir), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return digests(read_records(spark, folder))
