"""Registered queries: exploration, metric history and experiments."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from barflow.operators import explore, runs
from barflow.operators.indicators import return_volatility, technical_indicators
from barflow.plans import inputs as I
from barflow.plans.inputs import sql
from barflow.plans.q_series import _recursion, _W
from barflow.plans.registry import query
from barflow.session import shared_dir

_COLS = ("Open", "High", "Low", "Close", "Volume")


@query("k01_rows_per_symbol", sql("SELECT symbol, count(*) AS rows FROM bars GROUP BY symbol", "bars"))
def rows_per_symbol(spark, folder):
    return explore.rows_per_symbol(I.bars(spark, folder))


@query(
    "k02_profile",
    sql("SELECT count(*) AS n_rows, 7::BIGINT AS n_columns, min(date) AS first_date, max(date) AS last_date FROM bars", "bars"),
)
def profile(spark, folder):
    return explore.profile(I.bars(spark, folder))


@query("k03_head", sql("SELECT symbol, date, Close FROM bars ORDER BY symbol, date LIMIT 5", "bars"))
def head(spark, folder):
    return explore.head(I.bars(spark, folder).select("symbol", "date", "Close"), 5, ["symbol", "date"])


def _describe(cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
        f"CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS p25, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS p50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS p75, "
        f"CAST(max({c}) AS DOUBLE) AS max FROM bars"
        for c in cols
    )


def _round_stats(df):
    return df.withColumns({c: F.round(c, 4) for c in ("mean", "std", "p25", "p50", "p75")})


@query("k04_describe", sql(_describe(_COLS), "bars"))
def describe(spark, folder):
    return _round_stats(explore.describe(I.bars(spark, folder), _COLS))


@query("k04_describe_by_selection", sql(_describe(("Close", "Volume")), "bars"))
def describe_by_selection(spark, folder):
    return _round_stats(explore.describe(I.bars(spark, folder), ("Close", "Volume")))


@query(
    "k05_column_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column, count({c}) AS non_null, count(DISTINCT {c}) AS distinct FROM d" for c in ("source", "lang", "quality")
    ).replace("FROM d", "FROM (SELECT source, lang, quality FROM documents LEFT JOIN labels USING (doc_id))"),
)
def column_counts(spark, folder):
    docs = I.documents(spark, folder).join(I.table(spark, folder, "labels"), "doc_id", "left")
    return explore.column_counts(docs, ["source", "lang", "quality"])


@query(
    "k06_value_counts",
    "SELECT event_type, count(*) AS count, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS percent "
    "FROM events GROUP BY 1",
)
def value_counts(spark, folder):
    out = explore.value_counts(I.table(spark, folder, "events"), "event_type")
    return out.withColumn("percent", F.round("percent", 6))


@query(
    "k07_percentage_breakdown",
    "SELECT quality, count(*) AS count, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS percent "
    "FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY 1",
)
def percentage_breakdown(spark, folder):
    docs = I.documents(spark, folder).join(I.table(spark, folder, "labels"), "doc_id", "left")
    return explore.value_counts(docs, "quality").withColumn("percent", F.round("percent", 6))


@query(
    "k08_histogram",
    "WITH s AS (SELECT min(value) AS lo, (max(value) - min(value)) / 50 AS w FROM events), "
    "c AS (SELECT least(floor((value - lo) / w), 49)::INT AS bin, count(*) AS count FROM events, s GROUP BY 1) "
    "SELECT b.bin::INT AS bin, round(lo + w * b.bin, 6) AS lower, round(lo + w * (b.bin + 1), 6) AS upper, "
    "coalesce(count, 0) AS count FROM range(50) b(bin), s LEFT JOIN c ON c.bin = b.bin",
)
def histogram(spark, folder):
    out = explore.histogram(I.table(spark, folder, "events"), "value")
    return out.withColumns({"lower": F.round("lower", 6), "upper": F.round("upper", 6)})


_FEATURES = ("Close", "Volume", "SMA_20", "SMA_50", "BB_upper", "BB_lower", "Price_change", "Price_change_5d")


def _pairs(keep) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM features"
        for i, a in enumerate(_FEATURES)
        for j, b in enumerate(_FEATURES)
        if keep(i, j)
    )


@query("k09_correlations", sql(_pairs(lambda i, j: True), "features"))
def correlations(spark, folder):
    out = explore.correlations(I.features(spark, folder), _FEATURES)
    return out.withColumn("corr", F.round("corr", 6))


@query("k11_lower_triangle", sql(_pairs(lambda i, j: i > j), "features"))
def lower_triangle(spark, folder):
    out = explore.correlations(I.features(spark, folder), _FEATURES, lower_only=True)
    return out.withColumn("corr", F.round("corr", 6))


@query(
    "k10_top_correlated",
    sql("SELECT feature, round(c, 6) AS corr FROM ("
        + " UNION ALL ".join(f"SELECT '{f}' AS feature, corr({f}, Close) AS c FROM features" for f in _FEATURES[1:])
        + ") ORDER BY abs(c) DESC, feature LIMIT 5", "features"),
)
def top_correlated(spark, folder):
    out = explore.top_correlated(I.features(spark, folder), _FEATURES, "Close", 5)
    return out.withColumn("corr", F.round("corr", 6))


@query(
    "k12_volatility_summary",
    sql(
        "SELECT round(avg(daily_return), 6) AS mean_return, round(stddev_samp(daily_return), 6) AS return_std, "
        "round(avg(v), 6) AS mean_volatility, round(max(v), 6) AS max_volatility, round(min(RSI), 4) AS min_rsi, "
        "round(max(RSI), 4) AS max_rsi FROM d JOIN r USING (symbol, date)",
        "bars", recursive=True,
        extra={
            **_recursion("bars"),
            "x": f"SELECT symbol, date, Close / lag(Close) {_W} - 1 AS daily_return FROM bars",
            "d": "SELECT *, CASE WHEN count(daily_return) OVER w = 20 THEN stddev_samp(daily_return) OVER w END AS v FROM x "
            "WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)",
        },
    ),
)
def volatility_summary(spark, folder):
    full = return_volatility(technical_indicators(I.bars(spark, folder), ["RSI"]))
    out = explore.volatility_summary(full)
    return out.select(*[F.round(c, 4 if c.endswith("rsi") else 6).alias(c) for c in out.columns])


# --- metric history and experiments --------------------------------------------------------------

_NAMES = I.EVENT_SYMBOLS


@query("l01_log_metrics", sql("SELECT name, count(*) AS entries, round(sum(value), 2) AS total FROM runs GROUP BY name", "runs"))
def log_metrics(spark, folder):
    """Two batches, one of them sent twice."""
    path = f"{shared_dir(spark)}/metrics-{uuid.uuid4().hex}"
    log = I.runs(spark, folder)
    for batch, part in (("free", "step IS NULL"), ("stepped", "step IS NOT NULL"), ("free", "step IS NULL")):
        runs.log_metrics(log.where(part), path, batch)
    back = runs.metric_history(spark, path)
    return back.groupBy("name").agg(F.count(F.lit(1)).alias("entries"), F.round(F.sum("value"), 2).alias("total"))


@query(
    "l02_metrics_summary",
    sql("SELECT step, ts, " + ", ".join(f"max(value) FILTER (WHERE name = '{n}') AS {n}" for n in _NAMES)
        + " FROM runs GROUP BY step, ts", "runs"),
)
def metrics_summary(spark, folder):
    return runs.metrics_summary(I.runs(spark, folder), _NAMES)


_FINAL = """SELECT experiment, name, arg_max(value, seq) AS value FROM (
    SELECT *, max(step) OVER (PARTITION BY experiment) AS top FROM runs)
    WHERE step IS NULL OR step = top GROUP BY experiment, name"""
_STATUS = """SELECT experiment, start_time, CASE WHEN status <> 'running' THEN end_time END AS end_time, status FROM (
    SELECT experiment, min(ts) FILTER (WHERE status = 'running') AS start_time,
    max(ts) FILTER (WHERE status <> 'running') AS end_time, arg_max(status, ts) AS status FROM run_events GROUP BY 1)"""


@query("l03_final_metrics", sql(_FINAL, "runs"))
def final_metrics(spark, folder):
    return runs.final_metrics(I.runs(spark, folder))


@query(
    "l03_experiment_summary",
    sql(
        "SELECT s.experiment, start_time, end_time, status, round(epoch(coalesce(end_time, TIMESTAMP '2024-02-01') - start_time), 3) "
        "AS duration, coalesce(num_metrics, 0) AS num_metrics, 0::BIGINT AS num_artifacts, "
        + ", ".join(f"f.{n}" for n in _NAMES) + " FROM st s LEFT JOIN m USING (experiment) LEFT JOIN f USING (experiment)",
        "runs", "run_events",
        extra={
            "st": _STATUS,
            "m": "SELECT experiment, count(*) AS num_metrics FROM runs GROUP BY 1",
            "f": "SELECT experiment, " + ", ".join(f"max(value) FILTER (WHERE name = '{n}') AS {n}" for n in _NAMES)
            + f" FROM ({_FINAL}) GROUP BY 1",
        },
    ),
)
def experiment_summary(spark, folder):
    out = runs.experiment_summary(
        I.run_events(spark, folder), I.runs(spark, folder), _NAMES, now="2024-02-01 00:00:00"
    )
    return out.withColumn("duration", F.round("duration", 3))


@query("l04_latest_status", sql(_STATUS, "run_events"))
def latest_status(spark, folder):
    return runs.latest_status(I.run_events(spark, folder))
