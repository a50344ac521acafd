"""Query of the conversation repair."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm.conversations import repair_report


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given another role, by the checksum of id and turn."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    rows = conversations.select(
        "conv_id", "turn", text("role").alias("role"), text("text").alias("text"),
        (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20).alias("harm"),
    )
    harm = F.col("harm")
    return rows.where(harm != 0).select(
        "conv_id",
        "turn",
        F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(harm == 3, 2).otherwise(1))).alias("copy"),
    )


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair_report(damaged(rows), rows.select("conv_id"))
