"""Tables that grow by named batches, each of which counts once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.sources.store import path_exists


def committed_batches(spark: SparkSession, path: str) -> DataFrame:
    """Names of the batches that count (``batch``)."""
    if not path_exists(spark, f"{path}/commits"):
        return spark.createDataFrame([], "batch string")
    return spark.read.schema("batch string").parquet(f"{path}/commits")


def append_batch(df: DataFrame, path: str, batch: str) -> bool:
    """Add a batch of rows to the table; False, and nothing done, if a batch of that name counts already.

    The rows go to a folder of their own and replace what a failed attempt left there; a one-row file then makes them
    count. One writer for a batch at a time.
    """
    if not batch or "/" in batch:
        raise ValueError("a batch needs a name without a slash")
    spark = df.sparkSession
    if not committed_batches(spark, path).where(F.col("batch") == batch).isEmpty():
        return False
    df.write.mode("overwrite").parquet(f"{path}/data/batch={batch}")
    spark.createDataFrame([(batch,)], "batch string").coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return True


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all batches that count, with the name of each in ``batch``; an error without any."""
    names = committed_batches(spark, path).distinct()
    if names.isEmpty():
        raise ValueError(f"no committed batch in {path}")
    rows = spark.read.option("basePath", f"{path}/data").parquet(f"{path}/data")
    return rows.withColumn("batch", F.col("batch").cast("string")).join(F.broadcast(names), "batch", "left_semi")
