import math

import numpy as np
import pandas as pd
import pytest

from barflow.operators import metrics as M


def _labels(spark, pairs):
    return spark.createDataFrame(pairs, "y_true int, y_pred int")


def test_direction_accuracy_without_positive_predictions(spark):
    row = M.direction_accuracy(_labels(spark, [(1, 0), (0, 0)])).first()
    assert row["precision"] == row["recall"] == row["f1_score"] == row["up_accuracy"] == 0.0
    assert row["direction_accuracy"] == row["down_accuracy"] == 0.5
    assert (row["total_predictions"], row["up_predictions"], row["down_predictions"]) == (2, 0, 2)


def _pairs(spark, y, p):
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, p))], "i int, y_true double, y_pred double")


def test_regression_metrics_equal_numpy(spark):
    rng = np.random.default_rng(3)
    y, p = rng.normal(10, 2, 200), rng.normal(10, 2, 200)
    row = M.price_metrics(_pairs(spark, y, p), "i").first()
    assert math.isclose(row["mse"], ((y - p) ** 2).mean())
    assert math.isclose(row["r2_score"], 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert math.isclose(row["mape"], np.mean(np.abs((y - p) / y)) * 100)
    assert math.isclose(row["smape"], np.mean(2 * np.abs(y - p) / (np.abs(y) + np.abs(p))) * 100)
    assert math.isclose(row["price_direction_accuracy"], ((np.diff(y) > 0) == (np.diff(p) > 0)).mean())


def test_zero_truth_and_constant_truth(spark):
    row = M.regression_metrics(_pairs(spark, [0, 1], [1, 1])).first()
    assert math.isinf(row["mape"])
    assert math.isnan(M.regression_metrics(_pairs(spark, [0, 1], [0, 1])).first()["smape"])
    assert M.regression_metrics(_pairs(spark, [2, 2], [2, 2])).first()["r2_score"] == 1.0
    assert M.regression_metrics(_pairs(spark, [2, 2], [2, 3])).first()["r2_score"] == 0.0


def test_volatility_levels(spark):
    y = np.arange(100.0)
    out = M.volatility_levels(_pairs(spark, y, y[::-1]), ("y_true", "y_pred")).toPandas()
    lo, hi = np.percentile(y, [33, 67])
    want = np.where(out.y_true > hi, 2, np.where(out.y_true > lo, 1, 0))
    np.testing.assert_array_equal(out.y_true_level, want)


def _returns(spark, r, symbol="a"):
    return spark.createDataFrame([(symbol, i, float(x)) for i, x in enumerate(r)], "symbol string, i int, ret double")


def _drawdown(r):
    c = np.cumprod(1 + np.asarray(r))
    m = np.maximum.accumulate(c)
    d = (c - m) / m
    at = int(d.argmin())
    later = [i for i in range(at, len(c)) if c[i] >= m[at]]
    back = later[0] if later else None
    return d.min(), at, back, (back - at) if back else None


@pytest.mark.parametrize("block_rows", [10_000, 7])
def test_drawdown_equals_a_scan(spark, block_rows):
    rng = np.random.default_rng(5)
    series = {
        "walk": rng.normal(0.001, 0.02, 400),
        "rise": np.full(60, 0.01),
        "fall": np.full(60, -0.01),
        "dip": np.concatenate([np.full(10, 0.02), [-0.5], np.full(80, 0.02)]),
        "below": rng.normal(-0.01, 0.05, 150),
    }
    df = None
    for k, r in series.items():
        part = _returns(spark, r, k)
        df = part if df is None else df.union(part)
    from pyspark.sql import functions as F

    kw = {"by": ["symbol"], "block_rows": block_rows}
    small = df.withColumn("i", F.col("i") * 9000)  # spread the order key over many buckets
    got = {r["symbol"]: r for r in M.max_drawdown(small, "i", **kw).collect()}
    for k, r in series.items():
        depth, at, back, duration = _drawdown(r)
        assert math.isclose(got[k]["max_drawdown"], depth, rel_tol=1e-9, abs_tol=1e-12), k
        assert got[k]["max_drawdown_idx"] == at, k
        assert got[k]["recovery_idx"] == back, k
        assert got[k]["drawdown_duration"] == duration, k
    ratio = {r["symbol"]: r["calmar_ratio"] for r in M.calmar_ratio(small, "i", **kw).collect()}
    assert math.isinf(ratio["rise"])
    assert math.isclose(ratio["walk"], np.mean(series["walk"]) * 252 / abs(_drawdown(series["walk"])[0]), rel_tol=1e-9)


def test_flat_series_has_recovery_zero_and_no_duration(spark):
    row = M.max_drawdown(_returns(spark, [0.0, 0.0]), "i", by=["symbol"]).first()
    assert (row["max_drawdown"], row["max_drawdown_idx"], row["recovery_idx"], row["drawdown_duration"]) == (0, 0, 0, None)


def test_ratios_of_constant_and_empty_returns(spark):
    assert M.sharpe_ratio(_returns(spark, [0.01, 0.01])).first()["sharpe_ratio"] == 0.0
    empty = _returns(spark, [0.1]).where("i > 5")
    assert M.sharpe_ratio(empty).first()["sharpe_ratio"] == 0.0
    assert M.hit_rate(_pairs(spark, [1], [1]).where("i > 5")).first()["hit_rate"] == 0.0


def test_unpaired_returns_raise(spark):
    a, b = _returns(spark, [0.1, 0.2]).drop("symbol"), _returns(spark, [0.1]).drop("symbol").withColumnRenamed("ret", "bench")
    with pytest.raises(Exception, match="same rows"):
        M.paired_returns(a, b, ["i"]).collect()


def test_confidence_bins_at_the_edges(spark):
    values = [0.0, 0.1, 0.3, 0.6, 0.7, 0.30000000000000004, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "c double")
    rows = df.select("c", M.confidence_bin(df.c).alias("l"), M.confidence_bin(df.c, "right").alias("r")).toPandas()
    edges = np.linspace(0, 1, 11)
    for _, row in rows.iterrows():
        left = [i for i in range(10) if edges[i] <= row.c < edges[i + 1]]
        right = [i for i in range(10) if edges[i] < row.c <= edges[i + 1]]
        assert (None if pd.isna(row.l) else int(row.l)) == (left[0] if left else None)
        assert (None if pd.isna(row.r) else int(row.r)) == (right[0] if right else None)
    np.testing.assert_array_equal(edges, M.BIN_EDGES)


def test_calibration_errors(spark):
    rng = np.random.default_rng(9)
    conf, ok = rng.random(500), rng.random(500) < 0.6
    df = spark.createDataFrame([(float(c), 1, int(o)) for c, o in zip(conf, ok)], "confidence double, y_true int, y_pred int")
    edges = np.linspace(0, 1, 11)
    gaps, weights = [], []
    for lo, hi in zip(edges[:-1], edges[1:]):
        m = (conf >= lo) & (conf < hi)
        gaps.append(abs(ok[m].mean() - conf[m].mean()))
        weights.append(m.mean())
    row = M.confidence_metrics(df).first()
    assert math.isclose(row["ece_unweighted"], np.mean(gaps))
    assert math.isclose(row["confidence_std"], conf.std())
    weighted = M.calibration(df, df.y_true == df.y_pred).first()
    assert math.isclose(weighted["ece_weighted"], np.dot(gaps, weights))


def test_masked_accuracy_and_softmax(spark):
    df = spark.createDataFrame([([0.0, 1.0], 1), ([2.0, 1.0], 1), ([5.0, 0.0], -100), (None, 0)], "scores array<double>, label int")
    row = M.masked_accuracy(df).first()
    assert (row["correct_predictions"], row["total_predictions"]) == (1, 3)
    conf = [r[0] for r in df.select(M.softmax_max("scores")).collect()]
    assert math.isclose(conf[0], math.e / (1 + math.e)) and conf[3] == 0.5


def test_unknown_task_raises(spark):
    with pytest.raises(ValueError):
        M.comprehensive_metrics(_labels(spark, [(1, 1)]), "sentiment")
    with pytest.raises(ValueError):
        M.comprehensive_metrics(_labels(spark, [(1, 1)]), "price")


def test_ratio_of_an_empty_series(spark):
    empty = spark.createDataFrame([], "symbol string, i int, ret double")
    assert [r["calmar_ratio"] for r in M.calmar_ratio(empty, "i").collect()] == [0.0]
    assert M.calmar_ratio(empty, "i", by=["symbol"]).count() == 0
