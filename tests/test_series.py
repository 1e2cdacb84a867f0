"""Cutting series into blocks: results must not depend on the cut."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barflow.operators import scan, series
from barflow.operators.clean import forward_fill
from barflow.operators.indicators import INDICATORS, ema, lookback_for, technical_indicators
from barflow.operators.targets import target_variables

BUCKET = "id div 40"


def _sorted(df, order="id"):
    return df.toPandas().sort_values(["symbol", order]).reset_index(drop=True)


def test_rows_are_numbered_once_and_blocks_are_bounded(tick_series):
    blocks = series.cut_blocks(tick_series, ["symbol"], "id", 5, 3, 64, BUCKET)
    pdf = blocks.df.toPandas()
    sizes = pdf.groupby(["symbol", "_blk"]).size()
    assert sizes.max() <= 64 + 5 + 3
    assert pdf["_blk"].max() > 1
    core = pdf[pdf["_core"]]
    for symbol, part in core.groupby("symbol"):
        assert sorted(part["_rn"]) == list(range(len(part)))
        assert part.sort_values("_rn")["id"].is_monotonic_increasing


def test_halo_has_the_rows_around_the_block(tick_series):
    pdf = series.cut_blocks(tick_series, ["symbol"], "id", 5, 3, 64, BUCKET).df.toPandas()
    total = pdf[pdf["_core"]].groupby("symbol").size()
    for (symbol, blk), part in pdf.groupby(["symbol", "_blk"]):
        lo, hi = max(0, blk * 64 - 5), min(total[symbol], (blk + 1) * 64 + 3)
        assert sorted(part["_rn"]) == list(range(lo, hi))


def test_one_bucket_larger_than_a_block_stays_whole(tick_series):
    blocks = series.cut_blocks(tick_series, ["symbol"], "id", 2, 2, 16, "0")
    assert blocks.df.where(series.CORE).count() == tick_series.count()


def test_series_without_key_and_null_key(spark):
    df = spark.createDataFrame([(None, i, float(i)) for i in range(50)] + [("a", 1, 1.0)], "symbol string, id int, x double")
    keyed = series.cut_blocks(df, ["symbol"], "id", 0, 0, 8, "id div 4").result(keep=["_rn"])
    assert keyed.where("symbol IS NULL").agg(F.max("_rn")).first()[0] == 49
    whole = series.cut_blocks(df.where("symbol IS NULL").drop("symbol"), [], "id", 0, 0, 8, "id div 4")
    assert [r["_rn"] for r in whole.result(keep=["_rn"]).orderBy("id").collect()] == list(range(50))


@pytest.mark.parametrize("block_rows", [100_000, 60])
def test_indicators_equal_pandas(tick_series, block_rows):
    names = ["SMA_20", "EMA_12", "EMA_26", "MACD", "MACD_signal", "RSI", "BB_upper", "Volatility", "Price_change_5d"]
    got = _sorted(technical_indicators(tick_series, names, order="id", block_rows=block_rows, bucket=BUCKET))
    for _, part in got.groupby("symbol"):
        s = part["Close"].reset_index(drop=True)
        e12 = s.ewm(span=12, adjust=False, min_periods=12).mean()
        e26 = s.ewm(span=26, adjust=False, min_periods=26).mean()
        macd = e12 - e26
        delta = s.diff()
        up = delta.where(delta > 0, 0.0).ewm(alpha=1 / 14, adjust=False, min_periods=14).mean()
        down = (-delta).where(delta < 0, 0.0).ewm(alpha=1 / 14, adjust=False, min_periods=14).mean()
        want = {
            "SMA_20": s.rolling(20).mean(),
            "EMA_12": e12,
            "EMA_26": e26,
            "MACD": macd,
            "MACD_signal": macd.ewm(span=9, adjust=False, min_periods=9).mean(),
            "RSI": 100 - 100 / (1 + up / down),
            "BB_upper": s.rolling(20).mean() + 2 * s.rolling(20).std(ddof=0),
            "Volatility": s.rolling(20).std(),
            "Price_change_5d": s.pct_change(5),
        }
        for name, ref in want.items():
            np.testing.assert_allclose(part[name].to_numpy(), ref.to_numpy(), rtol=1e-9, atol=1e-9, err_msg=name)


def test_long_recurrence_over_many_blocks_equals_pandas(spark):
    """Blocks shorter and longer than the halo of an exponential average, on one hot series."""
    rng = np.random.default_rng(7)
    x = np.abs(rng.normal(size=6000).cumsum()) + 1
    df = spark.createDataFrame(pd.DataFrame({"symbol": "hot", "id": np.arange(6000), "Close": x}))
    for span, block in ((12, 500), (200, 700)):
        got = ema(df, "Close", span, "e", order="id", block_rows=block, bucket="id div 50")
        got = got.orderBy("id").toPandas()["e"].to_numpy()
        want = pd.Series(x).ewm(span=span, adjust=False, min_periods=span).mean().to_numpy()
        np.testing.assert_allclose(got, want, rtol=1e-12)


def test_leading_nulls_start_the_recurrence_late(spark):
    x = [None] * 5 + [float(i % 7) + 1 for i in range(60)]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(x)], "symbol string, id int, Close double")
    got = ema(df, "Close", 12, "e", order="id").orderBy("id").toPandas()["e"].astype(float).to_numpy()
    want = pd.Series(x, dtype=float).ewm(span=12, adjust=False, min_periods=12).mean().to_numpy()
    np.testing.assert_allclose(got, want, rtol=1e-12)


@pytest.mark.parametrize("block_rows", [100_000, 256, 64])
def test_a_gap_longer_than_the_halo_changes_nothing(spark, block_rows):
    """1,200 rows without a price inside 3,000; the recurrence goes on from the last price before them."""
    rng = np.random.default_rng(11)
    x = pd.Series(np.abs(rng.normal(size=3000).cumsum()) + 5)
    x[700:1900] = np.nan
    x[2500:2520] = np.nan
    rows = [("a", i, None if np.isnan(v) else float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "symbol string, id int, Close double").withColumn("Volume", F.lit(1))
    got = ema(df, "Close", 12, "e", order="id", block_rows=block_rows, bucket=BUCKET).orderBy("id").toPandas()["e"]
    want = x.dropna().ewm(span=12, adjust=False, min_periods=12).mean().reindex(x.index)
    np.testing.assert_allclose(got.astype(float).to_numpy(), want.to_numpy(), rtol=1e-12)
    names = ["EMA_26", "MACD_signal", "RSI", "SMA_20"]
    whole = technical_indicators(df, names, order="id", bucket=BUCKET).orderBy("id").toPandas()
    cut = technical_indicators(df, names, order="id", block_rows=block_rows, bucket=BUCKET).orderBy("id").toPandas()
    for c in names:
        np.testing.assert_allclose(cut[c].astype(float), whole[c].astype(float), rtol=1e-9, err_msg=c)
        assert cut[c].notna().sum() > 500


def test_too_different_smoothing_factors_are_refused(tick_series):
    blocks = series.cut_blocks(tick_series, ["symbol"], "id", 10)
    with pytest.raises(ValueError):
        scan.averages(blocks, "Close", [scan.Average("a", F.col("Close"), 0.9, 1), scan.Average("b", F.col("Close"), 0.001, 1)])


@pytest.mark.parametrize("block_rows", [7, 10, 40])
def test_blocks_shorter_than_the_signal_waits(spark, block_rows):
    """Blocks of fewer rows than an average needs, some without any price; two series, one with a null key."""
    rng = np.random.default_rng(5)
    x = pd.Series(np.abs(rng.normal(size=400).cumsum()) + 5)
    x[rng.random(400) < 0.3] = np.nan
    x[100:160] = np.nan
    rows = [(k, i, None if np.isnan(v) else float(v) * m, 1) for k, m in ((None, 1.0), ("", 3.0)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "symbol string, id int, Close double, Volume int")
    got = technical_indicators(df, ["MACD_signal", "RSI", "EMA_26"], order="id", block_rows=block_rows, bucket="id div 5").toPandas()
    p = x.dropna()
    e12, e26 = p.ewm(span=12, adjust=False).mean(), p.ewm(span=26, adjust=False).mean()
    signal = (e12 - e26).iloc[25:].ewm(span=9, adjust=False, min_periods=9).mean().reindex(x.index)
    for key, part in got.groupby("symbol", dropna=False):
        part = part.sort_values("id")
        m = 3.0 if key == "" else 1.0
        assert part["MACD_signal"].notna().sum() == signal.notna().sum() > 100
        np.testing.assert_allclose(part["MACD_signal"].astype(float), signal * m, rtol=1e-9, atol=1e-12)
        np.testing.assert_allclose(part["EMA_26"].astype(float), (e26.where(np.arange(len(p)) >= 25) * m).reindex(x.index), rtol=1e-12)


def test_recurrences_need_no_neighbour_rows(tick_series):
    assert lookback_for(["EMA_12", "EMA_26", "MACD", "MACD_signal", "MACD_histogram"]) == 0
    assert lookback_for(["RSI"]) == 1 and lookback_for(INDICATORS) == 49


def test_equal_factors_in_a_signal(spark):
    """Fast average and signal with one factor: the coefficient's limit."""
    df = spark.createDataFrame([("a", i, float(i % 11) + 1) for i in range(300)], "symbol string, id int, Close double")
    fast, slow = scan.Average("f", F.col("Close"), 0.2, 1), scan.Average("s", F.col("Close"), 0.1, 5)
    found = []
    for rows in (1000, 20):
        blocks = series.cut_blocks(df, ["symbol"], "id", 0, 0, rows, "id div 10")
        blocks = scan.averages(blocks, "Close", [fast, slow], scan.Difference("z", fast, slow, 0.2, 3))
        found.append(blocks.result(keep=["z"]).orderBy("id").toPandas()["z"].astype(float))
    p = pd.Series([float(i % 11) + 1 for i in range(300)])
    gap = p.ewm(alpha=0.2, adjust=False).mean() - p.ewm(alpha=0.1, adjust=False).mean()
    want = gap.iloc[4:].ewm(alpha=0.2, adjust=False, min_periods=3).mean().reindex(p.index)
    for f in found:
        np.testing.assert_allclose(f, want, rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("block_rows", [100_000, 50])
def test_targets_equal_pandas(tick_series, block_rows):
    got = _sorted(target_variables(tick_series, [1, 5], order="id", block_rows=block_rows))
    for _, part in got.groupby("symbol"):
        s = part["Close"].reset_index(drop=True)
        np.testing.assert_array_equal(part["price_direction_5d"], (s.shift(-5) > s).astype(int))
        np.testing.assert_allclose(part["volatility_5d"], s.rolling(5).std().shift(-5), rtol=1e-7)
        assert part["volatility_1d"].isna().all()


def test_target_tail(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0)], "symbol string, date int, Close double")
    zero = target_variables(df, [1]).orderBy("date").toPandas()["price_direction_1d"].tolist()
    null = target_variables(df, [1], tail="null").orderBy("date").toPandas()["price_direction_1d"]
    assert zero == [1, 0] and null.isna().tolist() == [False, True]
    with pytest.raises(ValueError):
        target_variables(df, [1], tail="x")


@pytest.mark.parametrize("block_rows", [100_000, 16])
def test_forward_fill_bridges_any_gap(spark, block_rows):
    rows = [("a", i, float(i) if i in (3, 4, 200) else None) for i in range(300)]
    df = spark.createDataFrame(rows, "symbol string, id int, x double")
    got = forward_fill(df, ["x"], order="id", block_rows=block_rows, bucket="id div 10").orderBy("id").toPandas()
    want = pd.Series([r[2] for r in rows], dtype=float).ffill()
    np.testing.assert_array_equal(got["x"].to_numpy(), want.to_numpy())


def test_flat_and_rising_prices(spark):
    flat = [("flat", i, 5.0, 10) for i in range(40)]
    rising = [("up", i, float(i), 10) for i in range(1, 41)]
    df = spark.createDataFrame(flat + rising, "symbol string, date int, Close double, Volume int")
    got = technical_indicators(df).toPandas()
    last = got.sort_values("date").groupby("symbol").last()
    assert np.isnan(last.loc["flat", "BB_percent"]) and last.loc["flat", "BB_width"] == 0
    assert last.loc["up", "RSI"] == 100 and last.loc["flat", "RSI"] == 100
    assert last.loc["up", "Volume_ratio"] == 1
    ok = got.dropna(subset=["BB_lower"])
    assert ((ok.BB_lower <= ok.BB_middle) & (ok.BB_middle <= ok.BB_upper)).all()
    assert list(got.columns) == ["symbol", "date", "Close", "Volume", *INDICATORS]


def test_unknown_indicator_is_refused(tick_series):
    with pytest.raises(ValueError):
        technical_indicators(tick_series, ["SMA_21"], order="id")


def test_zero_price_gives_null_change(spark):
    df = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 2.0)], "symbol string, date int, Close double")
    got = technical_indicators(df, ["Price_change"]).where("date = 2").first()
    assert got["Price_change"] is None


@pytest.mark.parametrize("block_rows", [10, 1000])
def test_a_task_sorts_a_bounded_number_of_rows(spark, monkeypatch, block_rows):
    """With more rows than the session's partitions should sort there are more partitions, not larger ones."""
    from barflow.operators import series

    df = spark.range(400).select((F.col("id") % 40).cast("string").alias("symbol"), "id", F.col("id").cast("double").alias("Close"))

    def tasks_and_rows():
        out = series.cut_blocks(df, ["symbol"], "id", 1, 0, block_rows, "id div 5")
        out = out.with_columns({"before": F.lag("Close", 1).over(out.window)}).result()
        plan = out._jdf.queryExecution().executedPlan().toString()
        return "REPARTITION_BY_NUM" in plan, sorted(map(tuple, out.select("symbol", "id", "before").collect()), key=str)

    few = tasks_and_rows()
    monkeypatch.setattr(series, "SORTED_ROWS", 20)
    monkeypatch.setattr(series, "SENT_ROUTES", 0)
    many = tasks_and_rows()
    assert (few[0], many[0]) == (False, True) and few[1] == many[1] and len(few[1]) == 400


def test_short_series_count_no_buckets(spark, monkeypatch):
    from barflow.operators import series

    df = spark.createDataFrame([("a", i) for i in range(10)], "symbol string, i int")
    stored = []
    real = series.materialize
    monkeypatch.setattr(series, "materialize", lambda d: stored.append(d) or real(d))
    assert not series.cut_blocks(df, ["symbol"], "i", block_rows=10).is_cut and not stored
    assert series.cut_blocks(df, ["symbol"], "i", block_rows=4, bucket="i div 2").is_cut and stored
