"""Query of the toxicity scores."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm.common import documents, fold
from evenkeel.llm.toxicity import learnable, train_and_score, training_labels


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = training_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return train_and_score(docs, labels, "score", ["doc_id"], learnable()).select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
