"""Query of the whitened embeddings."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm.whitening import fit, whiten


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    model = fit(rows)
    shares = F.array(*[F.lit(share) for share in model.explained]).cast("array<double>")
    return (
        whiten(rows, model)
        .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        .select(
            "vec_id",
            (F.col("at") + 1).cast("int").alias("component"),
            F.lit(model.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(shares, F.col("at")).alias("explained"),
            F.lit(model.identity_error).alias("identity_error"),
        )
    )
