"""Price, news and fundamentals sources, and OHLCV resampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("High", T.DoubleType()),
        T.StructField("Low", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Volume", T.LongType()),
    ]
)
NEWS_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("title", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("sentiment", T.DoubleType()),
    ]
)
# Provider key, our column, type.
FUNDAMENTAL_KEYS = (
    ("marketCap", "market_cap", "double"),
    ("trailingPE", "pe_ratio", "double"),
    ("priceToBook", "pb_ratio", "double"),
    ("debtToEquity", "debt_to_equity", "double"),
    ("returnOnEquity", "roe", "double"),
    ("revenueGrowth", "revenue_growth", "double"),
    ("earningsGrowth", "earnings_growth", "double"),
    ("sector", "sector", "string"),
    ("industry", "industry", "string"),
)
INTERVALS = {"1d": "1 day", "1h": "1 hour", "5m": "5 minutes", "1m": "1 minute"}
SENTIMENT_WORDS = {"positive": 1.0, "neutral": 0.0, "negative": -1.0}


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing values are NULL everywhere; pandas-style NaN is normalised on the way in."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in floats}) if floats else df


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet, CSV or JSON by suffix; text formats need an explicit schema, never inferred."""
    bare = path.rstrip("/")
    for suffix, form in ((".csv", "csv"), (".json", "json")):
        if bare.endswith(suffix):
            if schema is None:
                raise ValueError(f"{form} needs an explicit schema")
            reader = spark.read.schema(schema)
            return reader.csv(path, header=True) if form == "csv" else reader.json(path)
    return spark.read.parquet(path)


def in_range(df: DataFrame, symbols: Sequence[str] | None, start, end, time: str = "date") -> DataFrame:
    """Rows of the symbols in the half-open range [start, end); pushed down to the scan."""
    if symbols is not None:
        df = df.where(F.col("symbol").isin(list(symbols)))
    kind = df.schema[time].dataType
    if start is not None:
        df = df.where(F.col(time) >= F.lit(start).cast(kind))
    if end is not None:
        df = df.where(F.col(time) < F.lit(end).cast(kind))
    return df


def load_price_data(bars: DataFrame, symbols=None, start=None, end=None, time: str = "date") -> DataFrame:
    """Bars of the symbols in the range. Symbols without data simply contribute no rows."""
    return nan_to_null(in_range(bars, symbols, start, end, time))


def missing_symbols(bars: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """The requested symbols that have no bars at all."""
    wanted = bars.sparkSession.createDataFrame([(s,) for s in symbols], "symbol string")
    return wanted.join(bars.select("symbol").distinct(), "symbol", "left_anti")


def load_news_data(news: DataFrame, symbols=None, start=None, end=None) -> DataFrame:
    return in_range(news, symbols, start, end)


def numeric_sentiment(df: DataFrame, column: str = "sentiment") -> DataFrame:
    """Map the words positive / neutral / negative to 1 / 0 / -1; numbers in text form are kept."""
    word = F.lower(F.col(column).cast("string"))
    value = word.try_cast("double")
    for name, score in SENTIMENT_WORDS.items():
        value = F.when(word == name, score).otherwise(value)
    return df.withColumn(column, value)


def load_fundamental_data(info: DataFrame, symbols=None, column: str = "info") -> DataFrame:
    """One row per symbol from a raw ``map<string,string>`` of provider keys; absent key -> null."""
    if symbols is not None:
        info = info.where(F.col("symbol").isin(list(symbols)))
    return info.select(
        "symbol",
        *[F.try_element_at(column, F.lit(key)).try_cast(kind).alias(name) for key, name, kind in FUNDAMENTAL_KEYS],
    )


def fundamentals_wide(long: DataFrame, names: Sequence[str]) -> DataFrame:
    """(symbol, key, value) -> one row per symbol, one column per key."""
    return long.groupBy("symbol").pivot("key", list(names)).agg(F.first("value", ignorenulls=True))


def fundamentals_long(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    """Inverse of :func:`fundamentals_wide`; values as strings."""
    texts = wide.select("symbol", *[F.col(n).cast("string").alias(n) for n in names])
    return texts.unpivot("symbol", list(names), "key", "value")


def parse_payload(df: DataFrame, column: str, schema: str | T.StructType) -> DataFrame:
    """JSON text column -> typed columns."""
    return df.withColumn("_payload", F.from_json(column, schema)).select(*df.columns, "_payload.*")


def _position(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def resample_ohlcv(
    ticks: DataFrame,
    interval: str = "1d",
    ts: str = "ts",
    price: str = "price",
    volume: str | None = None,
    order: Sequence[str] | None = None,
    by: Sequence[str] = ("symbol",),
    out: str = "date",
) -> DataFrame:
    """Ticks to OHLCV bars. ``order`` (default: ``ts``) decides the first and the last tick of a bar.

    One aggregation with map-side combine, so a hot symbol shuffles only its bars. A single
    fixed-width ``order`` column keeps it a hash aggregation. Daily bars carry a DATE.
    """
    spec = INTERVALS.get(interval, interval)
    position = _position(list(order) if order else [ts])
    if isinstance(ticks.schema[ts].dataType, T.DateType):
        if spec != "1 day":
            raise ValueError("dates can only be resampled to daily bars")
        start = F.col(ts)
    elif spec == "1 day":
        start = F.to_date(ts)
    else:
        start = F.window(ts, spec)["start"]
    size = F.count(F.lit(1)) if volume is None else F.sum(volume).cast("bigint")
    return (
        ticks.withColumn(out, start)
        .groupBy(*by, out)
        .agg(
            F.min_by(price, position).alias("Open"),
            F.max(price).alias("High"),
            F.min(price).alias("Low"),
            F.max_by(price, position).alias("Close"),
            size.alias("Volume"),
        )
    )
