"""Registered queries: technical indicators and targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from barflow.operators import indicators as ind
from barflow.operators.targets import direction_text, target_columns, target_variables
from barflow.plans import inputs as I
from barflow.plans.inputs import sql
from barflow.plans.registry import query

# Small blocks make the cut visible on test data; results must not depend on it.
SMALL = 128


def _frame(rows: int) -> str:
    return f"(PARTITION BY symbol ORDER BY date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


def _full(agg: str, column: str, rows: int) -> str:
    f = _frame(rows)
    return f"CASE WHEN count({column}) OVER {f} = {rows} THEN {agg}({column}) OVER {f} END"


_W = "OVER (PARTITION BY symbol ORDER BY date)"
_MID, _STD = _full("avg", "Close", 20), _full("stddev_pop", "Close", 20)
_VOL = _full("avg", "Volume", 20)
_FRAMED = {
    "c01": ("SMA_20", _MID, 6),
    "c02": ("SMA_50", _full("avg", "Close", 50), 6),
    "c09": ("BB_middle", _MID, 6),
    "c10": ("BB_upper", f"{_MID} + 2 * {_STD}", 4),
    "c11": ("BB_lower", f"{_MID} - 2 * {_STD}", 4),
    "c12": ("BB_width", f"4 * {_STD} / nullif({_MID}, 0) * 100", 6),
    "c13": ("BB_percent", f"(Close - ({_MID} - 2 * {_STD})) / nullif(4 * {_STD}, 0)", 6),
    "c14": ("Volume_SMA", _VOL, 6),
    "c15": ("Volume_ratio", f"Volume / nullif({_VOL}, 0)", 6),
    "c16": ("Volatility", _full("stddev_samp", "Close", 20), 4),
    "c17": ("Price_change", f"Close / lag(Close) {_W} - 1", 6),
    "c18": ("Price_change_5d", f"Close / lag(Close, 5) {_W} - 1", 6),
    "c19": ("Price_change_20d", f"Close / lag(Close, 20) {_W} - 1", 6),
}


def _indicator(name: str, digits: int, block_rows: int = ind.BLOCK_ROWS):
    def run(spark, folder):
        out = ind.technical_indicators(I.bars(spark, folder), [name], block_rows=block_rows)
        return out.select("symbol", "date", F.round(name, digits).alias(name))

    return run


for _id, (_name, _expr, _digits) in _FRAMED.items():
    query(
        f"{_id}_{_name.lower()}", sql(f"SELECT symbol, date, round({_expr}, {_digits}) AS {_name} FROM bars", "bars")
    )(_indicator(_name, _digits))
query(
    "c02_sma_50_small_blocks", sql(f"SELECT symbol, date, round({_FRAMED['c02'][1]}, 6) AS SMA_50 FROM bars", "bars")
)(_indicator("SMA_50", 6, SMALL))


def _recursion(source: str) -> dict[str, str]:
    """Row-by-row definition of the recursive indicators over ``source`` (symbol, date, Close)."""
    return {
        "n": f"SELECT symbol, date, Close, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn FROM {source}",
        "e": """SELECT symbol, date, rn, Close, Close AS e12, Close AS e26, CAST(0 AS DOUBLE) AS up, CAST(0 AS DOUBLE) AS dn
            FROM n WHERE rn = 1 UNION ALL SELECT n.symbol, n.date, n.rn, n.Close,
            e12 * (11.0::DOUBLE / 13) + n.Close * (2.0::DOUBLE / 13), e26 * (25.0::DOUBLE / 27) + n.Close * (2.0::DOUBLE / 27),
            up * (13.0::DOUBLE / 14) + greatest(n.Close - e.Close, 0) / 14, dn * (13.0::DOUBLE / 14) + greatest(e.Close - n.Close, 0) / 14
            FROM e JOIN n ON n.symbol = e.symbol AND n.rn = e.rn + 1""",
        "s": """SELECT symbol, rn, e12 - e26 AS sig FROM e WHERE rn = 26 UNION ALL
            SELECT e.symbol, e.rn, s.sig * 0.8::DOUBLE + (e.e12 - e.e26) * 0.2::DOUBLE FROM s
            JOIN e ON e.symbol = s.symbol AND e.rn = s.rn + 1""",
        "r": """SELECT e.symbol, e.date, CASE WHEN e.rn >= 12 THEN e12 END AS EMA_12,
            CASE WHEN e.rn >= 26 THEN e26 END AS EMA_26, CASE WHEN e.rn >= 26 THEN e12 - e26 END AS MACD,
            CASE WHEN e.rn >= 34 THEN sig END AS MACD_signal, CASE WHEN e.rn >= 34 THEN e12 - e26 - sig END AS MACD_histogram,
            CASE WHEN e.rn >= 14 THEN CASE WHEN dn = 0 THEN 100 ELSE 100 - 100 / (1 + up / dn) END END AS RSI
            FROM e LEFT JOIN s ON e.symbol = s.symbol AND e.rn = s.rn""",
    }


def _recursive_sql(body: str, source: str = "bars") -> str:
    return sql(body, source, recursive=True, extra=_recursion(source))


_RECURSIVE = {
    "c03": "EMA_12",
    "c04": "EMA_26",
    "c05": "MACD",
    "c06": "MACD_signal",
    "c07": "MACD_histogram",
    "c08": "RSI",
}
for _id, _name in _RECURSIVE.items():
    query(f"{_id}_{_name.lower()}", _recursive_sql(f"SELECT symbol, date, round({_name}, 4) AS {_name} FROM r"))(
        _indicator(_name, 4)
    )

_ALL = ", ".join(f"round({c}, 4) AS {c}" for c in _RECURSIVE.values())


@query("c03_recursive_hourly_small_blocks", _recursive_sql(f"SELECT symbol, date, {_ALL} FROM r", "bars_1h"))
def recursive_hourly(spark, folder):
    names = list(_RECURSIVE.values())
    out = ind.technical_indicators(I.bars_1h(spark, folder), names, block_rows=SMALL)
    return out.select("symbol", "date", *[F.round(c, 4).alias(c) for c in names])


_ALL_FRAMED = ", ".join(f"round({e}, 4) AS {n}" for n, e, _ in _FRAMED.values())


@query(
    "c00_all_indicators",
    sql(
        f"SELECT f.*, {_ALL} FROM f JOIN r USING (symbol, date)", "bars", recursive=True,
        extra={**_recursion("bars"), "f": f"SELECT symbol, date, {_ALL_FRAMED} FROM bars"},
    ),
)
def all_indicators(spark, folder):
    out = ind.technical_indicators(I.bars(spark, folder))
    return out.select("symbol", "date", *[F.round(c, 4).alias(c) for c in ind.INDICATORS])


@query(
    "c03_ema_any_span",
    sql(
        "SELECT symbol, date, round(CASE WHEN rn >= 100 THEN v END, 4) AS EMA_100 FROM x", "bars", recursive=True,
        extra={
            "n": _recursion("bars")["n"],
            "x": "SELECT symbol, date, rn, Close AS v FROM n WHERE rn = 1 UNION ALL SELECT n.symbol, n.date, n.rn, "
            "v * (99.0::DOUBLE / 101) + n.Close * (2.0::DOUBLE / 101) FROM x JOIN n ON n.symbol = x.symbol AND n.rn = x.rn + 1",
        },
    ),
)
def ema_any_span(spark, folder):
    out = ind.ema(I.bars(spark, folder), "Close", 100, "EMA_100")
    return out.select("symbol", "date", F.round("EMA_100", 4).alias("EMA_100"))


@query(
    "c20_return_volatility",
    sql(
        "SELECT symbol, date, round(daily_return, 6) AS daily_return, "
        f"round({_full('stddev_samp', 'daily_return', 20)}, 6) AS return_volatility_20d FROM d",
        "bars", extra={"d": f"SELECT symbol, date, Close / lag(Close) {_W} - 1 AS daily_return FROM bars"},
    ),
)
def return_volatility(spark, folder):
    out = ind.return_volatility(I.bars(spark, folder).select("symbol", "date", "Close"))
    names = ("daily_return", "return_volatility_20d")
    return out.select("symbol", "date", *[F.round(c, 6).alias(c) for c in names])


@query(
    "c21_rsi_zone",
    _recursive_sql(
        "SELECT symbol, date, CASE WHEN RSI >= 70 THEN 'overbought' WHEN RSI <= 30 THEN 'oversold' "
        "WHEN RSI IS NOT NULL THEN 'neutral' END AS zone FROM r"
    ),
)
def rsi_zone(spark, folder):
    out = ind.technical_indicators(I.bars(spark, folder), ["RSI"])
    return out.select("symbol", "date", ind.rsi_zone(F.col("RSI")).alias("zone"))


def _targets(h: int) -> str:
    f = f"(PARTITION BY symbol ORDER BY date ROWS BETWEEN 1 FOLLOWING AND {h} FOLLOWING)"
    return (
        f"CAST(coalesce(lead(Close, {h}) {_W} > Close, false) AS INT) AS price_direction_{h}d, "
        f"round(lead(Close, {h}) {_W} / Close - 1, 6) AS price_change_{h}d, "
        f"round(CASE WHEN count(Close) OVER {f} = {h} THEN stddev_samp(Close) OVER {f} END, 4) AS volatility_{h}d"
    )


_HORIZONS = (1, 5, 20)
_TARGET_SQL = "SELECT symbol, date, " + ", ".join(_targets(h) for h in _HORIZONS) + " FROM bars"


def _rounded_targets(df, horizons):
    digits = {"price_direction": None, "price_change": 6, "volatility": 4}
    picks = []
    for c in target_columns(horizons):
        d = digits[c.rsplit("_", 1)[0]]
        picks.append(F.col(c) if d is None else F.round(c, d).alias(c))
    return df.select("symbol", "date", *picks)


@query("d03_targets", sql(_TARGET_SQL, "bars"))
def targets(spark, folder):
    return _rounded_targets(target_variables(I.bars(spark, folder)), _HORIZONS)


@query("d03_targets_small_blocks", sql(_TARGET_SQL, "bars"))
def targets_small_blocks(spark, folder):
    return _rounded_targets(target_variables(I.bars(spark, folder), block_rows=SMALL), _HORIZONS)


def _one_target(kind: str, digits: int | None):
    def run(spark, folder):
        out = target_variables(I.bars(spark, folder), [5])
        name = f"{kind}_5d"
        return out.select("symbol", "date", F.col(name) if digits is None else F.round(name, digits).alias(name))

    return run


for _id, _kind, _digits in (
    ("d03a", "price_direction", None),
    ("d03b", "price_change", 6),
    ("d03c", "volatility", 4),
):
    query(
        f"{_id}_{_kind}",
        sql(f"SELECT symbol, date, {_kind}_5d FROM t", "bars", extra={"t": f"SELECT symbol, date, {_targets(5)} FROM bars"}),
    )(_one_target(_kind, _digits))


@query(
    "d03a_direction_null_tail",
    sql(f"SELECT symbol, date, CAST(lead(Close) {_W} > Close AS INT) AS price_direction_1d FROM bars", "bars"),
)
def direction_null_tail(spark, folder):
    out = target_variables(I.bars(spark, folder), [1], tail="null")
    return out.select("symbol", "date", "price_direction_1d")


@query(
    "d04_direction_text",
    sql(
        f"SELECT symbol, date, CASE WHEN coalesce(lead(Close) {_W} > Close, false) THEN 'True' ELSE 'False' END "
        "AS price_direction_1d FROM bars",
        "bars",
    ),
)
def direction_as_text(spark, folder):
    out = target_variables(I.bars(spark, folder), [1])
    return out.select("symbol", "date", direction_text(F.col("price_direction_1d")).alias("price_direction_1d"))
