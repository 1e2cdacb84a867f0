"""Saving and loading tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed precedence when loading by bare name.
LOAD_ORDER = ("csv", "json")


def save_table(df: DataFrame, base: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> str:
    """Default sink: Parquet, optionally partitioned for pruning."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{base}.parquet")
    return f"{base}.parquet"


def save_csv(df: DataFrame, base: str, mode: str = "overwrite") -> str:
    """Flat table -> ``<base>.csv`` with a header. Nested columns are written as JSON text."""
    flat = [
        F.to_json(f.name).alias(f.name)
        if isinstance(f.dataType, (T.StructType, T.MapType, T.ArrayType))
        else F.col(f.name)
        for f in df.schema
    ]
    df.select(*flat).write.mode(mode).option("header", True).csv(f"{base}.csv")
    return f"{base}.csv"


def save_json(df: DataFrame, base: str, mode: str = "overwrite") -> str:
    """Nested records -> ``<base>.json`` lines; times and dates become text."""
    df.write.mode(mode).option("ignoreNullFields", False).json(f"{base}.json")
    return f"{base}.json"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def load_saved(spark: SparkSession, base: str, schema: T.StructType | str) -> DataFrame:
    """``<base>.csv`` if it exists, else ``<base>.json``, else FileNotFoundError."""
    for form in LOAD_ORDER:
        path = f"{base}.{form}"
        if path_exists(spark, path):
            reader = spark.read.schema(schema)
            return reader.csv(path, header=True) if form == "csv" else reader.json(path)
    raise FileNotFoundError(f"no saved data for {base}")
