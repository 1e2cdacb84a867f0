"""Per-day news aggregates and their join to the bars."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.operators.clean import fill_news_zeros


def with_day(df: DataFrame, column: str = "date") -> DataFrame:
    return df.withColumn(column, F.to_date(column))


def aggregate_news(news: DataFrame) -> DataFrame:
    """Article count and sentiment statistics per symbol and day."""
    return news.groupBy("date", "symbol").agg(
        F.count("title").alias("news_count"),
        F.avg("sentiment").alias("sentiment_mean"),
        F.stddev_samp("sentiment").alias("sentiment_std"),
        F.count("sentiment").alias("sentiment_count"),
    )


def join_news(bars: DataFrame, daily: DataFrame) -> DataFrame:
    """Keep every bar. ``daily`` is unique per (date, symbol), so no bar is repeated."""
    return bars.join(daily, ["date", "symbol"], "left")


def news_features(news: DataFrame, bars: DataFrame) -> DataFrame:
    """News statistics per bar; counts and moments are 0 on days without news."""
    joined = join_news(with_day(bars), aggregate_news(with_day(news)))
    added = ["news_count", "sentiment_mean", "sentiment_std", "sentiment_count"]
    return fill_news_zeros(joined).select(*bars.columns, *added)


def concat_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
