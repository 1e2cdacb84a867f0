"""Queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``(spark, folder) -> DataFrame`` under ``name``, with its DuckDB SQL where SQL can express it."""

    def add(func):
        LLM_QUERIES[name] = func
        if oracle is not None:
            LLM_ORACLES[name] = oracle
        return func

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
