"""Technical indicators, all from one cut of the series."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.operators.scan import Average, Difference, averages
from barflow.operators.series import BLOCK_ROWS, Blocks, cut_blocks

SMA_WINDOWS = (20, 50)
FAST, SLOW, SIGNAL = 12, 26, 9
RSI_WINDOW = 14
BAND_WINDOW, BAND_WIDTH = 20, 2.0
CHANGE_LAGS = {"Price_change": 1, "Price_change_5d": 5, "Price_change_20d": 20}
INDICATORS = (
    "SMA_20 SMA_50 EMA_12 EMA_26 MACD MACD_signal MACD_histogram RSI BB_upper BB_middle BB_lower "
    "BB_width BB_percent Volume_SMA Volume_ratio Volatility Price_change Price_change_5d Price_change_20d"
).split()
_MACD = {"MACD", "MACD_signal", "MACD_histogram"}
_RECURSIVE = {"EMA_12", "EMA_26", "RSI"} | _MACD


def span_alpha(span: int) -> float:
    return 2.0 / (span + 1)


def framed(blocks: Blocks, func, column: str, rows: int) -> Column:
    """Aggregate of the last ``rows`` rows, null unless all of them are non-null."""
    frame = blocks.rows(-(rows - 1), 0)
    return F.when(F.count(column).over(frame) == rows, func(column).over(frame))


def pct_change(blocks: Blocks, column: str, rows: int) -> Column:
    return F.try_divide(F.col(column), F.lag(column, rows).over(blocks.window)) - 1


def lookback_for(columns: Iterable[str]) -> int:
    wanted = set(columns)
    rows = 0
    for name, n in (("SMA_20", 20), ("SMA_50", 50)):
        rows = max(rows, n - 1 if name in wanted else 0)
    if wanted & {"Volatility", "Volume_SMA", "Volume_ratio"} or any(c.startswith("BB_") for c in wanted):
        rows = max(rows, BAND_WINDOW - 1)
    rows = max([rows, *[n for c, n in CHANGE_LAGS.items() if c in wanted]])
    return max(rows, 1 if "RSI" in wanted else 0)


def add_indicators(blocks: Blocks, columns: Sequence[str], close: str = "Close", volume: str = "Volume") -> Blocks:
    """Add the named indicators to an already cut series (halo at least ``lookback_for(columns)``)."""
    wanted = set(columns)
    unknown = wanted - set(INDICATORS)
    if unknown:
        raise ValueError(f"unknown indicators: {sorted(unknown)}")
    price = F.col(close)
    new: dict[str, Column] = {}
    helpers: list[str] = []

    def need(name: str, column: Column) -> None:
        new[name] = column
        if name not in wanted:
            helpers.append(name)

    bands = {c for c in wanted if c.startswith("BB_")}
    if bands:
        need("BB_middle", framed(blocks, F.avg, close, BAND_WINDOW))
        if bands - {"BB_middle"}:
            need("_band_std", framed(blocks, F.stddev_pop, close, BAND_WINDOW))
    if "SMA_20" in wanted:
        new["SMA_20"] = framed(blocks, F.avg, close, SMA_WINDOWS[0])
    if "SMA_50" in wanted:
        new["SMA_50"] = framed(blocks, F.avg, close, SMA_WINDOWS[1])
    if wanted & {"Volume_SMA", "Volume_ratio"}:
        need("Volume_SMA", framed(blocks, F.avg, volume, 20))
    if "Volatility" in wanted:
        new["Volatility"] = framed(blocks, F.stddev_samp, close, 20)
    for name, lag in CHANGE_LAGS.items():
        if name in wanted:
            new[name] = pct_change(blocks, close, lag)
    if "RSI" in wanted:
        need("_delta", F.coalesce(price - F.lag(close, 1).over(blocks.window), F.when(price.isNotNull(), 0.0)))
    blocks = blocks.with_columns(new)

    derived: dict[str, Column] = {}
    if bands - {"BB_middle"}:
        upper = F.col("BB_middle") + BAND_WIDTH * F.col("_band_std")
        lower = F.col("BB_middle") - BAND_WIDTH * F.col("_band_std")
        ready = {
            "BB_upper": upper,
            "BB_lower": lower,
            "BB_width": F.try_divide(upper - lower, F.col("BB_middle")) * 100,
            "BB_percent": F.try_divide(price - lower, upper - lower),
        }
        derived |= {c: v for c, v in ready.items() if c in wanted}
    if "Volume_ratio" in wanted:
        derived["Volume_ratio"] = F.try_divide(F.col(volume), F.col("Volume_SMA"))
    blocks = blocks.with_columns(derived).temporaries(*helpers)
    return _add_recursive(blocks, wanted, close) if wanted & _RECURSIVE else blocks


def _add_recursive(blocks: Blocks, wanted: set[str], close: str) -> Blocks:
    price = F.col(close)
    fast = Average("EMA_12", price, span_alpha(FAST), FAST)
    slow = Average("EMA_26", price, span_alpha(SLOW), SLOW)
    parts: list[Average] = []
    if wanted & ({"EMA_12"} | _MACD):
        parts.append(fast)
    if wanted & ({"EMA_26"} | _MACD):
        parts.append(slow)
    if "RSI" in wanted:
        for name, move in (("_gain", F.col("_delta")), ("_loss", -F.col("_delta"))):
            up_only = F.when(move > 0, move).otherwise(F.when(move.isNotNull(), 0.0))
            parts.append(Average(name, up_only, 1.0 / RSI_WINDOW, RSI_WINDOW, from_zero=True))
    signal = Difference("MACD_signal", fast, slow, span_alpha(SIGNAL), SIGNAL) if wanted & {"MACD_signal", "MACD_histogram"} else None
    blocks = averages(blocks, close, parts, signal)
    new: dict[str, Column] = {}
    if "RSI" in wanted:
        strength = F.try_divide(F.col("_gain"), F.col("_loss"))
        rsi = F.when(F.col("_loss") == 0, 100.0).otherwise(100.0 - 100.0 / (1.0 + strength))
        new["RSI"] = F.when(F.col("_loss").isNotNull(), rsi)
    macd = F.col("EMA_12") - F.col("EMA_26")
    if "MACD" in wanted:
        new["MACD"] = macd
    if "MACD_histogram" in wanted:
        new["MACD_histogram"] = macd - F.col("MACD_signal")
    made = [a.out for a in parts] + ([signal.out] if signal else [])
    return blocks.with_columns(new).temporaries(*[c for c in made if c not in wanted])


def technical_indicators(
    df: DataFrame,
    columns: Sequence[str] = tuple(INDICATORS),
    by: Sequence[str] = ("symbol",),
    order: str = "date",
    close: str = "Close",
    volume: str = "Volume",
    block_rows: int = BLOCK_ROWS,
    bucket: Column | str | None = None,
) -> DataFrame:
    """Append technical indicators. Exponential averages skip rows without a price, however many; other indicators are
    null where their frame has one."""
    blocks = cut_blocks(df, by, order, lookback_for(columns), 0, block_rows, bucket)
    out = add_indicators(blocks, columns, close, volume).result()
    return out.select(*df.columns, *columns)


def ema(
    df: DataFrame,
    column: str,
    span: int,
    out: str,
    by: Sequence[str] = ("symbol",),
    order: str = "date",
    block_rows: int = BLOCK_ROWS,
    bucket: Column | str | None = None,
) -> DataFrame:
    """Exponential moving average of any span over the non-null rows."""
    blocks = cut_blocks(df, by, order, 0, 0, block_rows, bucket)
    blocks = averages(blocks, column, [Average(out, F.col(column), span_alpha(span), span)])
    return blocks.result().select(*df.columns, out)


def return_volatility(
    df: DataFrame,
    rows: int = 20,
    by: Sequence[str] = ("symbol",),
    order: str = "date",
    close: str = "Close",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``daily_return`` and the sample deviation of the last ``rows`` returns."""
    blocks = cut_blocks(df, by, order, rows, 0, block_rows)
    blocks = blocks.with_columns({"daily_return": pct_change(blocks, close, 1)})
    name = f"return_volatility_{rows}d"
    blocks = blocks.with_columns({name: framed(blocks, F.stddev_samp, "daily_return", rows)})
    return blocks.result().select(*df.columns, "daily_return", name)


def rsi_zone(rsi: Column, high: float = 70.0, low: float = 30.0) -> Column:
    return F.when(rsi >= high, "overbought").when(rsi <= low, "oversold").when(rsi.isNotNull(), "neutral")
