"""Registered queries: sources, sinks and connectors."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from barflow.operators.news import aggregate_news, join_news
from barflow.plans import inputs as I
from barflow.plans.inputs import sql, table
from barflow.plans.registry import query
from barflow.session import shared_dir
from barflow.sources import market, store

_OHLCV = "symbol, date, Open, High, Low, Close, Volume"


@query(
    "a01_load_price_data",
    sql(
        f"SELECT {_OHLCV} FROM bars_1d WHERE symbol IN ('click', 'purchase', 'view') "
        "AND date >= DATE '2024-01-05' AND date < DATE '2024-01-25'",
        "bars_1d",
    ),
)
def load_price_data(spark, folder):
    return market.load_price_data(I.bars_1d(spark, folder), ["click", "purchase", "view"], "2024-01-05", "2024-01-25")


@query("a02_resample_1d", sql(f"SELECT {_OHLCV} FROM bars_1d", "bars_1d"))
def resample_1d(spark, folder):
    return I.bars_1d(spark, folder)


@query("a02_resample_1h", sql(f"SELECT {_OHLCV} FROM bars_1h", "bars_1h"))
def resample_1h(spark, folder):
    return I.bars_1h(spark, folder)


@query(
    "a02_resample_5m",
    I._resampled(
        "events", "time_bucket(INTERVAL '5 minutes', ts)", "value", "ts", "count(*)", "event_type"
    ),
)
def resample_5m(spark, folder):
    return market.resample_ohlcv(I.ticks(spark, folder), "5m", order=["ts", "id"])


@query("a02_resample_trades", sql("SELECT symbol, date, round(Open, 6) AS Open, round(High, 6) AS High, "
       "round(Low, 6) AS Low, round(Close, 6) AS Close, Volume FROM bars", "bars"))  # fmt: skip
def resample_trades(spark, folder):
    return I.bars(spark, folder).withColumns({c: F.round(c, 6) for c in ("Open", "High", "Low", "Close")})


@query(
    "a03_load_news_data",
    sql(
        "SELECT symbol, date, title, content, source, sentiment FROM news "
        "WHERE symbol IN ('error', 'signup') AND date >= DATE '2024-01-03' AND date < DATE '2024-01-28'",
        "news",
    ),
)
def load_news_data(spark, folder):
    found = market.load_news_data(I.news(spark, folder), ["error", "signup"], "2024-01-03", "2024-01-28")
    return found.select("symbol", "date", "title", "content", "source", "sentiment")


_NULLS = ", ".join(
    f"CAST(NULL AS DOUBLE) AS {c}" for c in ("pb_ratio", "debt_to_equity", "roe", "revenue_growth", "earnings_growth")
)


@query(
    "a04_load_fundamental_data",
    sql(f"SELECT symbol, market_cap, pe_ratio, {_NULLS}, sector, industry FROM fundamentals", "fundamentals"),
)
def load_fundamental_data(spark, folder):
    return market.load_fundamental_data(I.raw_info(spark, folder))


@query(
    "a05_fundamentals_wide",
    sql("SELECT symbol, sector, industry, CAST(round(market_cap) AS BIGINT) AS market_cap FROM fundamentals", "fundamentals"),
)
def fundamentals_wide(spark, folder):
    names = ["sector", "industry", "market_cap"]
    wide = I.fundamentals(spark, folder).withColumn("market_cap", F.round("market_cap").cast("bigint"))
    back = market.fundamentals_wide(market.fundamentals_long(wide, names), names)
    return back.withColumn("market_cap", F.col("market_cap").cast("bigint"))


@query(
    "a05_fundamentals_long",
    sql("SELECT symbol, 'sector' AS key, sector AS value FROM fundamentals "
        "UNION ALL SELECT symbol, 'industry', industry FROM fundamentals", "fundamentals"),  # fmt: skip
)
def fundamentals_long(spark, folder):
    return market.fundamentals_long(I.fundamentals(spark, folder), ["sector", "industry"])


def _scratch(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("a06_save_csv", sql(f"SELECT {_OHLCV} FROM bars_1d", "bars_1d"))
def save_csv(spark, folder):
    b = I.bars_1d(spark, folder)
    base = _scratch(spark, "bars")
    store.save_csv(b, base)
    return store.load_saved(spark, base, b.schema)


@query(
    "a07_save_json",
    sql("SELECT symbol, sector, industry, market_cap, pe_ratio, revenue_growth FROM fundamentals", "fundamentals"),
)
def save_json(spark, folder):
    f = I.fundamentals(spark, folder)
    base = _scratch(spark, "fundamentals")
    store.save_json(f.select("symbol", F.struct(*[c for c in f.columns if c != "symbol"]).alias("data")), base)
    schema = "symbol string, data struct<sector:string,industry:string,market_cap:double,pe_ratio:double,revenue_growth:double>"
    return store.load_saved(spark, base, schema).select("symbol", "data.*")


@query("a08_load_saved_csv_first", sql("SELECT symbol, date, Close FROM bars_1d", "bars_1d"))
def load_saved(spark, folder):
    b = I.bars_1d(spark, folder).select("symbol", "date", "Close")
    base = _scratch(spark, "both")
    store.save_csv(b, base)
    store.save_json(b.where("Close IS NULL"), base)
    return store.load_saved(spark, base, b.schema)


@query("a08_partitioned_table", sql(f"SELECT {_OHLCV} FROM bars_1d WHERE symbol = 'view'", "bars_1d"))
def partitioned_table(spark, folder):
    path = store.save_table(I.bars_1d(spark, folder), _scratch(spark, "bars"), ("symbol",))
    return market.load_price_data(spark.read.parquet(path), ["view"]).select(
        "symbol", "date", "Open", "High", "Low", "Close", "Volume"
    )


@query(
    "a09_json_payload",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def json_payload(spark, folder):
    e = table(spark, folder, "events").select("event_id", "props")
    return market.parse_payload(e, "props", "k bigint").drop("props")


_NEWS_AGG = """SELECT date, symbol, count(title) AS news_count, avg(sentiment) AS sentiment_mean,
    stddev_samp(sentiment) AS sentiment_std, count(sentiment) AS sentiment_count FROM news GROUP BY 1, 2"""


@query(
    "a11_news_of_all_symbols",
    sql("SELECT b.symbol, b.date, n.news_count FROM bars_1d b LEFT JOIN agg n USING (symbol, date)",
        "bars_1d", "news", extra={"agg": _NEWS_AGG}),
)
def news_of_all_symbols(spark, folder):
    daily = aggregate_news(I.news(spark, folder))
    return join_news(I.bars_1d(spark, folder), daily).select("symbol", "date", "news_count")
