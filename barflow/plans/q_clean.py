"""Registered queries: cleaning, predicates and null handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from barflow.operators import clean, news
from barflow.operators.indicators import technical_indicators
from barflow.operators.targets import target_variables
from barflow.plans import inputs as I
from barflow.plans.inputs import sql
from barflow.plans.registry import query

_COLS = ("Open", "High", "Low", "Close", "Volume")
_PICK = ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in _COLS)


def _rounded(df, digits=6, columns=_COLS):
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


@query("b01_forward_fill", sql(f"SELECT symbol, date, {_PICK} FROM filled", "filled"))
def forward_fill(spark, folder):
    return _rounded(clean.forward_fill(I.bars_gaps(spark, folder), _COLS))


@query("b01_forward_fill_small_blocks", sql(f"SELECT symbol, date, {_PICK} FROM filled", "filled"))
def forward_fill_small_blocks(spark, folder):
    return _rounded(clean.forward_fill(I.bars_gaps(spark, folder), _COLS, block_rows=64))


_ANY = " OR ".join(f"{c} IS NOT NULL" for c in _COLS)


@query("b02_drop_empty_rows", sql(f"SELECT symbol, date, {_PICK} FROM filled WHERE {_ANY}", "filled"))
def drop_empty_rows(spark, folder):
    return _rounded(clean.drop_empty_rows(clean.forward_fill(I.bars_gaps(spark, folder), _COLS), _COLS))


_BOUNDS = "SELECT symbol, " + ", ".join(
    f"{q1} - 1.5 * ({q3} - {q1}) AS {c}_lo, {q3} + 1.5 * ({q3} - {q1}) AS {c}_hi"
    for c in _COLS
    for q1, q3 in [(f"quantile_cont(CAST({c} AS DOUBLE), 0.25)", f"quantile_cont(CAST({c} AS DOUBLE), 0.75)")]
)
_BOUNDS_ROUNDED = "SELECT symbol, " + ", ".join(f"round({c}_{s}, 6) AS {c}_{s}" for c in _COLS for s in ("lo", "hi"))


@query(
    "b03_iqr_bounds",
    sql(f"{_BOUNDS_ROUNDED} FROM bounds", "bars_gaps", extra={"bounds": f"{_BOUNDS} FROM bars_gaps GROUP BY symbol"}),
)
def iqr_bounds(spark, folder):
    found = clean.iqr_bounds(I.bars_gaps(spark, folder), _COLS)
    return _rounded(found, columns=[c for c in found.columns if c != "symbol"])


@query(
    "b03_iqr_bounds_by_selection",
    sql(f"{_BOUNDS_ROUNDED} FROM bounds", "bars_gaps", extra={"bounds": f"{_BOUNDS} FROM bars_gaps GROUP BY symbol"}),
)
def iqr_bounds_by_selection(spark, folder):
    found = clean.iqr_bounds(I.bars_gaps(spark, folder), _COLS)
    return _rounded(found, columns=[c for c in found.columns if c != "symbol"])


def _capped(source: str) -> str:
    parts = ", ".join(
        f"round(CASE WHEN {c} < {c}_lo THEN {c}_lo WHEN {c} > {c}_hi THEN {c}_hi ELSE {c} END, 6) AS {c}" for c in _COLS
    )
    return f"SELECT symbol, date, {parts} FROM {source} LEFT JOIN bounds USING (symbol)"


@query(
    "b04_cap_outliers",
    sql(_capped("bars_gaps"), "bars_gaps", extra={"bounds": f"{_BOUNDS} FROM bars_gaps GROUP BY symbol"}),
)
def cap_outliers(spark, folder):
    b = I.bars_gaps(spark, folder)
    return _rounded(clean.cap_outliers(b, clean.iqr_bounds(b, _COLS), _COLS))


_CLEAN = {
    "kept": f"SELECT * FROM filled WHERE {_ANY}",
    "bounds": f"{_BOUNDS} FROM filled GROUP BY symbol",
}


@query("b05_clean_price_data", sql(_capped("kept"), "filled", extra=_CLEAN))
def clean_price_data(spark, folder):
    return _rounded(clean.clean_price_data(I.bars_gaps(spark, folder)))


@query(
    "b06_drop_missing_targets",
    sql("SELECT symbol, date, round(t, 6) AS price_change_1d FROM (SELECT symbol, date, "
        "lead(Close) OVER (PARTITION BY symbol ORDER BY date) / Close - 1 AS t FROM bars) WHERE t IS NOT NULL", "bars"),
)
def drop_missing_targets(spark, folder):
    t = target_variables(I.bars(spark, folder).select("symbol", "date", "Close"), [1])
    kept = clean.drop_missing_targets(t, "price_change_1d")
    return kept.select("symbol", "date", F.round("price_change_1d", 6).alias("price_change_1d"))


_AGG = """SELECT date, symbol, count(title) AS news_count, avg(sentiment) AS sentiment_mean,
    stddev_samp(sentiment) AS sentiment_std, count(sentiment) AS sentiment_count
    FROM news GROUP BY 1, 2"""
_FILLED = """SELECT b.symbol, b.date, coalesce(news_count, 0) AS news_count,
    round(coalesce(sentiment_mean, 0), 6) AS sentiment_mean, round(coalesce(sentiment_std, 0), 6) AS sentiment_std,
    sentiment_count FROM {bars} b LEFT JOIN agg USING (symbol, date)"""
_STATS = ("news_count", "sentiment_mean", "sentiment_std", "sentiment_count")


def _stats(df):
    return df.select(
        "symbol", "date", "news_count", F.round("sentiment_mean", 6).alias("sentiment_mean"),
        F.round("sentiment_std", 6).alias("sentiment_std"), "sentiment_count",
    )


@query("b07_fill_news_zeros", sql(_FILLED.format(bars="bars_1d"), "bars_1d", "news", extra={"agg": _AGG}))
def fill_news_zeros(spark, folder):
    daily = news.aggregate_news(I.news(spark, folder))
    return _stats(clean.fill_news_zeros(news.join_news(I.bars_1d(spark, folder), daily)))


@query("b08_no_news_defaults", sql(_FILLED.format(bars="bars"), "bars", "news", extra={"agg": _AGG}))
def no_news_defaults(spark, folder):
    """None of these symbols has news, so all get the defaults."""
    daily = news.aggregate_news(I.news(spark, folder))
    return _stats(clean.fill_news_zeros(news.join_news(I.bars(spark, folder), daily)))


@query(
    "b09_validate_samples",
    sql("SELECT count(*) AS samples, count(*) FILTER (WHERE Close IS NULL) AS missing_targets FROM bars_gaps", "bars_gaps"),
)
def validate_samples(spark, folder):
    return clean.validate_samples(I.bars_gaps(spark, folder), "Close")


@query(
    "b10_feature_columns",
    sql("SELECT round(Open, 6) AS Open, round(High, 6) AS High, round(Low, 6) AS Low, round(Close, 6) AS Close, "
        "CAST(Volume AS DOUBLE) AS Volume, round(Close / lag(Close) OVER (PARTITION BY symbol ORDER BY date) - 1, 6) "
        "AS Price_change FROM bars", "bars"),
)
def feature_columns(spark, folder):
    full = target_variables(technical_indicators(I.bars(spark, folder), ["Price_change"]), [1, 5])
    kept = clean.feature_columns(full)
    return _rounded(full.select(*kept), columns=kept)


@query(
    "b11_flattened_names",
    sql("SELECT date, symbol, count(title) AS news_count, round(avg(sentiment), 6) AS sentiment_mean, "
        "round(stddev_samp(sentiment), 6) AS sentiment_std, count(sentiment) AS sentiment_count "
        "FROM news GROUP BY 1, 2", "news"),
)
def flattened_names(spark, folder):
    return _stats(news.aggregate_news(I.news(spark, folder)))


@query("b12_date_truncation", "SELECT event_id, CAST(ts AS DATE) AS ts FROM events")
def date_truncation(spark, folder):
    return news.with_day(I.table(spark, folder, "events").select("event_id", "ts"), "ts")
