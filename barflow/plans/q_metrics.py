"""Registered queries: evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from barflow.functions.prompts import parse_direction
from barflow.operators import metrics
from barflow.plans import inputs as I
from barflow.plans.inputs import sql
from barflow.plans.registry import query

BY = ["symbol"]


def _r(df, digits, columns=None):
    """Round the double columns."""
    picked = columns or [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in picked})


_DIRECTION = """SELECT {key} round(ok / n, 6) AS direction_accuracy, round(coalesce(tp / nullif(up, 0), 0), 6) AS precision,
    round(coalesce(tp / nullif(pos, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(up + pos, 0), 0), 6) AS f1_score,
    round(coalesce(tp / nullif(up, 0), 0), 6) AS up_accuracy, round(coalesce(tn / nullif(down, 0), 0), 6) AS down_accuracy,
    n AS total_predictions, up AS up_predictions, down AS down_predictions FROM (SELECT {key} count(*) AS n,
    count(*) FILTER (WHERE y_true = y_pred) AS ok, count(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS tp,
    count(*) FILTER (WHERE y_true = 0 AND y_pred = 0) AS tn, count(*) FILTER (WHERE y_pred = 1) AS up,
    count(*) FILTER (WHERE y_pred = 0) AS down, count(*) FILTER (WHERE y_true = 1) AS pos FROM {src} {group})"""


@query("i01_direction_accuracy", sql(_DIRECTION.format(key="", src="labels_conf", group=""), "labels_conf"))
def direction_accuracy(spark, folder):
    return _r(metrics.direction_accuracy(I.labels_conf(spark, folder)), 6)


@query(
    "i20_direction_accuracy_by_symbol",
    sql(_DIRECTION.format(key="symbol,", src="labels_conf", group="GROUP BY symbol"), "labels_conf"),
)
def direction_accuracy_by_symbol(spark, folder):
    return _r(metrics.direction_accuracy(I.labels_conf(spark, folder), by=BY), 6)


_ROLLED = "(SELECT *, confidence >= 0.5 AS sure FROM labels_conf)"


@query(
    "i20_metrics_rollup",
    sql(_DIRECTION.format(key="symbol, sure, 2 - bit_count(g) AS level,", src=_ROLLED, group="").replace(
        "FROM (SELECT symbol, sure, 2 - bit_count(g) AS level,", "FROM (SELECT symbol, sure, grouping(symbol, sure) AS g,"
    )[:-1] + " GROUP BY GROUPING SETS ((symbol, sure), (symbol), ()))", "labels_conf"),
)
def metrics_rollup(spark, folder):
    """Direction metrics by symbol and sureness, by symbol, and in all."""
    sure = I.labels_conf(spark, folder).withColumn("sure", F.col("confidence") >= 0.5)
    return _r(metrics.direction_rollup(sure, ["symbol", "sure"]), 6)


_E = "(y_true - y_pred)"
_R2 = f"1 - sum({_E} * {_E}) / (var_pop(y_true) * count(*))"
_REGRESSION = {
    "mse": f"round(avg({_E} * {_E}), 0)",
    "rmse": f"round(sqrt(avg({_E} * {_E})), 4)",
    "mae": f"round(avg(abs({_E})), 4)",
    "r2_score": f"round({_R2}, 6)",
    "mape": f"round(avg(abs({_E} / y_true)) * 100, 6)",
    "smape": f"round(avg(2 * abs({_E}) / (abs(y_true) + abs(y_pred))) * 100, 6)",
}
_DIGITS = {"mse": 0, "rmse": 4, "mae": 4}


def _pick(names) -> str:
    return ", ".join(f"{_REGRESSION[n]} AS {n}" for n in names)


def _rounded(df, names, key=()):
    return df.select(*key, *[F.round(c, _DIGITS.get(c, 6)).alias(c) for c in names])


_BASIC = ("mse", "rmse", "mae", "r2_score")


@query("i02_error_metrics", sql(f"SELECT {_pick(_BASIC)} FROM price_pairs", "price_pairs"))
def error_metrics(spark, folder):
    return _rounded(metrics.regression_metrics(I.price_pairs(spark, folder)), _BASIC)


@query("i03_mape", sql(f"SELECT symbol, {_pick(['mape'])} FROM price_pairs GROUP BY symbol", "price_pairs"))
def mape(spark, folder):
    return _rounded(metrics.regression_metrics(I.price_pairs(spark, folder), by=BY), ["mape"], BY)


@query("i04_smape", sql(f"SELECT symbol, {_pick(['smape'])} FROM price_pairs GROUP BY symbol", "price_pairs"))
def smape(spark, folder):
    return _rounded(metrics.regression_metrics(I.price_pairs(spark, folder), by=BY), ["smape"], BY)


_MOVES = (
    "SELECT symbol, CAST((y_true > lag(y_true) OVER w) = (y_pred > lag(y_pred) OVER w) AS INT) AS same "
    "FROM price_pairs WINDOW w AS (PARTITION BY symbol ORDER BY date)"
)


@query(
    "i05_price_direction_accuracy",
    sql("SELECT symbol, round(avg(same), 6) AS price_direction_accuracy FROM moves GROUP BY symbol", "price_pairs",
        extra={"moves": _MOVES}),
)
def price_direction_accuracy(spark, folder):
    out = metrics.price_direction_accuracy(I.price_pairs(spark, folder), "date", by=BY, block_rows=100)
    return _r(out, 6)


@query(
    "i05_tick_direction_accuracy",
    "SELECT round(avg(CAST((value > pv) = (user_id > pu) AS INT)), 6) AS price_direction_accuracy FROM (SELECT *, "
    "lag(value) OVER (ORDER BY event_id) AS pv, lag(user_id) OVER (ORDER BY event_id) AS pu FROM events) WHERE pv IS NOT NULL",
)
def tick_direction_accuracy(spark, folder):
    """One series over all events, cut into blocks by the integer order key."""
    e = I.table(spark, folder, "events").select(
        "event_id", F.col("value").alias("y_true"), F.col("user_id").alias("y_pred")
    )
    blocks = metrics.cut_blocks(e, [], "event_id", 1, 0, 1024, "event_id div 512")
    w = blocks.window
    same = (F.col("y_true") > F.lag("y_true").over(w)) == (F.col("y_pred") > F.lag("y_pred").over(w))
    moves = blocks.with_columns({"same": same}).result(keep=[metrics.ROW]).where(F.col(metrics.ROW) > 0)
    return moves.agg(F.round(F.avg(F.col("same").cast("double")), 6).alias("price_direction_accuracy"))


@query(
    "i02_price_metrics",
    sql(f"SELECT symbol, {_pick(_REGRESSION)}, price_direction_accuracy FROM price_pairs JOIN (SELECT symbol, "
        "round(avg(same), 6) AS price_direction_accuracy FROM moves GROUP BY symbol) USING (symbol) "
        "GROUP BY symbol, price_direction_accuracy", "price_pairs", extra={"moves": _MOVES}),
)
def price_metrics(spark, folder):
    out = metrics.price_metrics(I.price_pairs(spark, folder), "date", by=BY)
    return _rounded(out, [*_REGRESSION, "price_direction_accuracy"], BY)


def _levels(group: str) -> dict[str, str]:
    over = f"OVER (PARTITION BY {group})" if group else "OVER ()"

    def level(c):
        return (
            f"CASE WHEN {c} > quantile_cont({c}, 0.67) {over} THEN 2 WHEN {c} > quantile_cont({c}, 0.33) {over} "
            f"THEN 1 ELSE 0 END AS {c}_level"
        )

    return {"lv": f"SELECT *, {level('y_true')}, {level('y_pred')} FROM price_pairs"}


@query(
    "i06_volatility_metrics",
    sql(f"SELECT symbol, {_pick(_BASIC)}, round(avg(CAST(y_true_level = y_pred_level AS INT)), 6) "
        "AS volatility_direction_accuracy FROM lv GROUP BY symbol", "price_pairs", extra=_levels("symbol")),
)
def volatility_metrics(spark, folder):
    out = metrics.volatility_metrics(I.price_pairs(spark, folder), by=BY)
    return _rounded(out, [*_BASIC, "volatility_direction_accuracy"], BY)


@query("i07_volatility_levels", sql("SELECT symbol, date, y_true_level, y_pred_level FROM lv", "price_pairs", extra=_levels("")))
def volatility_levels(spark, folder):
    out = metrics.volatility_levels(I.price_pairs(spark, folder), ("y_true", "y_pred"))
    return out.select("symbol", "date", "y_true_level", "y_pred_level")


@query(
    "i07_volatility_levels_by_selection",
    sql("SELECT symbol, date, y_true_level, y_pred_level FROM lv", "price_pairs", extra=_levels("")),
)
def volatility_levels_by_selection(spark, folder):
    out = metrics.volatility_levels(I.price_pairs(spark, folder), ("y_true", "y_pred"))
    return out.select("symbol", "date", "y_true_level", "y_pred_level")


_SHARPE = "round(avg(ret - 0.02::DOUBLE / 252) / stddev_pop(ret) * sqrt(252), 6) AS sharpe_ratio"


@query("i08_sharpe_ratio", sql(f"SELECT symbol, {_SHARPE} FROM returns GROUP BY symbol", "returns"))
def sharpe_ratio(spark, folder):
    return _r(metrics.sharpe_ratio(I.returns(spark, folder), by=BY), 6)


_DRAWDOWN = {
    "c": "SELECT symbol, date, ret, row_number() OVER w - 1 AS idx, product(1 + ret) OVER w AS cumulative FROM returns "
    "WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING)",
    "p": "SELECT *, max(cumulative) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) AS peak FROM c",
    "w": "SELECT symbol, min((cumulative - peak) / peak) AS max_drawdown, avg(ret) AS m, "
    "arg_min(idx, ((cumulative - peak) / peak, idx)) AS max_drawdown_idx, "
    "arg_min(peak, ((cumulative - peak) / peak, idx)) AS top FROM p GROUP BY symbol",
    "x": "SELECT symbol, any_value(max_drawdown) AS max_drawdown, any_value(max_drawdown_idx) AS max_drawdown_idx, "
    "min(idx) FILTER (WHERE idx >= max_drawdown_idx AND cumulative >= top) AS recovery_idx FROM c JOIN w USING (symbol) GROUP BY symbol",
}
_DRAWDOWN_SQL = sql(
    "SELECT symbol, round(max_drawdown, 6) AS max_drawdown, max_drawdown_idx, recovery_idx, "
    "CASE WHEN recovery_idx > 0 THEN recovery_idx - max_drawdown_idx END AS drawdown_duration FROM x",
    "returns",
    extra=_DRAWDOWN,
)


@query("i09_max_drawdown", _DRAWDOWN_SQL)
def max_drawdown(spark, folder):
    return _r(metrics.max_drawdown(I.returns(spark, folder), "date", by=BY), 6)


@query("i09_max_drawdown_small_blocks", _DRAWDOWN_SQL)
def max_drawdown_small_blocks(spark, folder):
    return _r(metrics.max_drawdown(I.returns(spark, folder), "date", by=BY, block_rows=90), 6)


@query(
    "i09_cumulative_returns",
    sql("SELECT symbol, date, idx, round(ln(cumulative), 6) AS log_cumulative, round((cumulative - peak) / peak, 6) AS drawdown FROM p",
        "returns", extra=_DRAWDOWN),
)
def cumulative_returns(spark, folder):
    out = metrics.cumulative_returns(I.returns(spark, folder), "date", by=BY, block_rows=90)
    return out.select(
        "symbol", "date", "idx", F.round(F.log("cumulative"), 6).alias("log_cumulative"), F.round("drawdown", 6).alias("drawdown")
    )


@query(
    "i10_calmar_ratio",
    sql("SELECT symbol, round(m * 252 / abs(max_drawdown), 6) AS calmar_ratio FROM w", "returns", extra=_DRAWDOWN),
)
def calmar_ratio(spark, folder):
    return _r(metrics.calmar_ratio(I.returns(spark, folder), "date", by=BY), 6)


@query(
    "i11_information_ratio",
    sql("SELECT symbol, round(avg(ret - bench) / stddev_pop(ret - bench) * sqrt(252), 6) AS information_ratio "
        "FROM returns JOIN b USING (date) GROUP BY symbol", "returns",
        extra={"b": "SELECT date, avg(ret) AS bench FROM returns GROUP BY date"}),
)
def information_ratio(spark, folder):
    r = I.returns(spark, folder)
    pairs = metrics.paired_returns(r, r.groupBy("date").agg(F.avg("ret").alias("bench")), ["date"])
    return _r(metrics.information_ratio(pairs, by=BY), 6)


@query(
    "i12_hit_rate",
    sql("SELECT symbol, round(avg(CAST(abs(y_true - y_pred) <= 250 AS INT)), 6) AS hit_rate FROM price_pairs GROUP BY symbol",
        "price_pairs"),
)
def hit_rate(spark, folder):
    return _r(metrics.hit_rate(I.price_pairs(spark, folder), threshold=250.0, by=BY), 6)


_EDGES = "(VALUES " + ", ".join(
    f"({i}, {metrics.BIN_EDGES[i]!r}::DOUBLE, {metrics.BIN_EDGES[i + 1]!r}::DOUBLE)" for i in range(10)
) + ") e(bin, lo, hi)"
_LEFT_BINS = {
    "bins": "SELECT bin, count(*) AS n, avg(CAST(y_true = y_pred AS INT)) AS accuracy, avg(confidence) AS confidence "
    f"FROM labels_conf JOIN {_EDGES} ON confidence >= lo AND confidence < hi GROUP BY bin"
}


@query(
    "i13_confidence_metrics",
    sql("SELECT round((SELECT avg(abs(accuracy - confidence)) FROM bins), 6) AS ece_unweighted, "
        "round(avg(confidence), 6) AS average_confidence, round(stddev_pop(confidence), 6) AS confidence_std, "
        "max(confidence) - min(confidence) AS confidence_range FROM labels_conf", "labels_conf", extra=_LEFT_BINS),
)
def confidence_metrics(spark, folder):
    out = metrics.confidence_metrics(I.labels_conf(spark, folder))
    return _r(out, 6, ["ece_unweighted", "average_confidence", "confidence_std"])


@query(
    "i13_reliability_table",
    sql("SELECT bin, n, round(accuracy, 6) AS accuracy, round(confidence, 6) AS confidence FROM bins", "labels_conf", extra=_LEFT_BINS),
)
def reliability_table(spark, folder):
    return _r(metrics.reliability_table(I.labels_conf(spark, folder)), 6)


@query("i14_comprehensive_direction", sql(_DIRECTION.format(key="", src="labels_conf", group=""), "labels_conf"))
def comprehensive_direction(spark, folder):
    return _r(metrics.comprehensive_metrics(I.labels_conf(spark, folder), "direction"), 6)


@query(
    "i14_comprehensive_price",
    sql(f"SELECT symbol, {_pick(_REGRESSION)}, price_direction_accuracy FROM price_pairs JOIN (SELECT symbol, "
        "round(avg(same), 6) AS price_direction_accuracy FROM moves GROUP BY symbol) USING (symbol) "
        "GROUP BY symbol, price_direction_accuracy", "price_pairs", extra={"moves": _MOVES}),
)
def comprehensive_price(spark, folder):
    out = metrics.comprehensive_metrics(I.price_pairs(spark, folder), "price", "date", by=BY)
    return _rounded(out, [*_REGRESSION, "price_direction_accuracy"], BY)


@query(
    "i14_comprehensive_volatility",
    sql(f"SELECT symbol, {_pick(_BASIC)}, round(avg(CAST(y_true_level = y_pred_level AS INT)), 6) "
        "AS volatility_direction_accuracy FROM lv GROUP BY symbol", "price_pairs", extra=_levels("symbol")),
)
def comprehensive_volatility(spark, folder):
    out = metrics.comprehensive_metrics(I.price_pairs(spark, folder), "volatility", by=BY)
    return _rounded(out, [*_BASIC, "volatility_direction_accuracy"], BY)


_MASKED = """SELECT {key} round(correct / total, 6) AS accuracy, correct AS correct_predictions, total AS total_predictions
    FROM (SELECT {key} count(*) FILTER (WHERE CAST(s1 > s0 AS INT) = label) AS correct, count(*) AS total
    FROM class_scores WHERE label <> -100 {group})"""


@query("i15_masked_accuracy", sql(_MASKED.format(key="", group=""), "class_scores"))
def masked_accuracy(spark, folder):
    return _r(metrics.masked_accuracy(I.class_scores(spark, folder)), 6)


@query("i16_masked_accuracy_by_symbol", sql(_MASKED.format(key="symbol,", group="GROUP BY symbol"), "class_scores"))
def masked_accuracy_by_symbol(spark, folder):
    return _r(metrics.masked_accuracy(I.class_scores(spark, folder), by=BY), 6)


_CONF = "1 / (exp(s0 - greatest(s0, s1)) + exp(s1 - greatest(s0, s1)))"
_RIGHT_BINS = {
    "scored": f"SELECT {_CONF} AS confidence, CAST(CAST(s1 > s0 AS INT) = label AS INT) AS ok FROM class_scores WHERE label <> -100",
    "bins": "SELECT bin, count(*) AS n, avg(ok) AS accuracy, avg(confidence) AS confidence "
    f"FROM scored JOIN {_EDGES} ON confidence > lo AND confidence <= hi GROUP BY bin",
}


@query(
    "i17_score_calibration",
    sql("SELECT round((SELECT sum(abs(accuracy - confidence) * n) / sum(n) FROM bins), 6) AS ece_weighted, "
        "round(avg(confidence), 6) AS average_confidence, round(avg(ok), 6) AS average_accuracy FROM scored",
        "class_scores", extra=_RIGHT_BINS),
)
def score_calibration(spark, folder):
    return _r(metrics.score_calibration(I.class_scores(spark, folder)), 6)


@query(
    "i18_softmax_confidence",
    sql(f"SELECT symbol, round(sum({_CONF}), 4) AS confidence FROM class_scores GROUP BY symbol", "class_scores"),
)
def softmax_confidence(spark, folder):
    scores = I.class_scores(spark, folder)
    return scores.groupBy("symbol").agg(F.round(F.sum(metrics.softmax_max("scores")), 4).alias("confidence"))


@query(
    "i19_label_agreement",
    sql(
        "SELECT round(avg(CAST((d = 'UP') = (y_true = 1) AS INT)), 6) AS unknown_as_down, "
        "round(avg(CAST((d = 'UP' AND y_true = 1) OR (d = 'DOWN' AND y_true = 0) AS INT)), 6) AS unknown_as_wrong "
        "FROM (SELECT y_true, CASE WHEN upper(response) LIKE '%UP%' OR upper(response) LIKE '%RISE%' THEN 'UP' "
        "WHEN upper(response) LIKE '%DOWN%' THEN 'DOWN' ELSE 'UNKNOWN' END AS d FROM responses)",
        "responses",
    ),
)
def label_agreement(spark, folder):
    parsed = I.responses(spark, folder).withColumn("direction", parse_direction("response"))
    return _r(metrics.label_agreement(parsed), 6)
