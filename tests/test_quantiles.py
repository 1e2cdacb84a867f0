import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from barflow.operators.clean import cap_outliers, clean_price_data, iqr_bounds
from barflow.operators.quantiles import exact_quantiles

PROBS = (0.0, 0.25, 0.33, 0.5, 0.67, 0.75, 1.0)


def test_quantiles_equal_numpy_with_ties_nulls_and_a_hot_group(spark):
    rng = np.random.default_rng(1)
    hot = np.concatenate([np.full(900, 3.0), rng.normal(size=1500), rng.integers(0, 4, 600)])
    frames = [
        pd.DataFrame({"symbol": "hot", "x": hot, "y": hot[::-1] ** 2}),
        pd.DataFrame({"symbol": "two", "x": [1.0, 2.0], "y": [5.0, np.nan]}),
        pd.DataFrame({"symbol": "one", "x": [7.5], "y": [-1.0]}),
        pd.DataFrame({"symbol": "none", "x": [1.0, 2.0], "y": [np.nan, np.nan]}),
    ]
    pdf = pd.concat(frames)
    df = spark.createDataFrame(pdf).withColumn("y", F.nanvl("y", F.lit(None)))
    got = exact_quantiles(df, ["x", "y"], PROBS, ["symbol"]).toPandas().set_index("symbol")
    for symbol, part in pdf.groupby("symbol"):
        for c in ("x", "y"):
            want = part[c].quantile(list(PROBS)).to_numpy()
            names = [f"{c}_p{p * 100:g}" for p in PROBS]
            np.testing.assert_allclose(got.loc[symbol, names].astype(float).to_numpy(), want, rtol=1e-12)


def test_quantiles_of_the_whole_table(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    row = exact_quantiles(df, ["x"], (0.25, 0.5), ()).first()
    assert (row["x_p25"], row["x_p50"]) == (250.0, 500.0)


def test_caps_keep_nulls_and_other_symbols(spark):
    rows = [("a", i, float(i)) for i in range(20)] + [("a", 99, 1000.0), ("a", 100, None), ("b", 1, 1000.0)]
    df = spark.createDataFrame(rows, "symbol string, date int, Close double")
    capped = cap_outliers(df, iqr_bounds(df, ["Close"]), ["Close"]).toPandas()
    a = capped[capped.symbol == "a"].set_index("date")["Close"]
    assert a[99] == 15 + 1.5 * 10 and np.isnan(a[100]) and a[5] == 5
    assert capped[capped.symbol == "b"]["Close"].tolist() == [1000.0]


def test_cleaning_fills_drops_and_caps(spark):
    rows = [("a", 0, None, None), ("a", 1, 1.0, 5), ("a", 2, None, 6), ("a", 3, 3.0, None)]
    df = spark.createDataFrame(rows, "symbol string, date int, Close double, Volume int")
    got = clean_price_data(df).orderBy("date").toPandas()
    assert got["date"].tolist() == [1, 2, 3]
    assert got["Close"].tolist() == [1.0, 1.0, 3.0] and got["Volume"].tolist() == [5.0, 6.0, 6.0]


def test_empty_tables_and_null_groups(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None)], "symbol string, x double")
    got = {r["symbol"]: r["x_p50"] for r in exact_quantiles(df, ["x"], (0.5,), ["symbol"]).collect()}
    assert got == {None: 2.0, "a": None}
    assert exact_quantiles(df.limit(0), ["x"], (0.5,), ["symbol"]).count() == 0
    assert exact_quantiles(df.limit(0), ["x"], (0.5,)).first()["x_p50"] is None


def test_sortable_integers_keep_the_order_of_doubles(spark):
    import struct

    from barflow.operators.quantiles import add_sortable

    rng = np.random.default_rng(3)
    bits = rng.integers(0, 1 << 63, 4000, np.uint64) | (rng.integers(0, 2, 4000).astype(np.uint64) << np.uint64(63))
    xs = [struct.unpack("<d", struct.pack("<Q", int(b)))[0] for b in bits]
    xs = [x for x in xs if x == x] + [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.7976931348623157e308, float("inf"), -float("inf")]
    xs += [s * 2.0**e * f for e in range(-1020, 1023, 7) for s in (1, -1) for f in (1.0, np.nextafter(1, 0), np.nextafter(1, 2))]
    got = spark.createDataFrame([(float(x),) for x in xs], "x double").transform(lambda d: add_sortable(d, "x", "k")).collect()
    got.sort(key=lambda r: r["x"])
    for a, b in zip(got, got[1:]):
        assert (a["k"] < b["k"]) == (a["x"] < b["x"]) and (a["k"] == b["k"]) == (a["x"] == b["x"]), (a, b)
    nan, null = (r["key"] for r in add_sortable(spark.createDataFrame([(float("nan"),), (None,)], "x double")).collect())
    assert null is None and nan > max(r["k"] for r in got)


def test_near_equal_values_are_told_apart(spark):
    """Values that share their first forty bits, and many ties."""
    x = np.concatenate([1.0 + np.arange(500) * 2.0**-50, np.full(300, 1.0 + 250 * 2.0**-50), -1.0 - np.arange(200) * 2.0**-52])
    df = spark.createDataFrame(pd.DataFrame({"x": np.random.default_rng(1).permutation(x)}))
    row = exact_quantiles(df, ["x"], PROBS).first()
    want = pd.Series(x).quantile(list(PROBS)).to_numpy()
    np.testing.assert_array_equal([row[f"x_p{p * 100:g}"] for p in PROBS], want)


def test_bounds_are_broadcast_or_joined(spark, monkeypatch):
    from barflow.operators import groups

    rows = [(k, i, float(i * i % 37)) for k in ("a", None, "") for i in range(30)]
    df = spark.createDataFrame(rows, "symbol string, date int, Close double")
    bounds = iqr_bounds(df, ["Close"], factor=0.2)
    found = [sorted(map(tuple, cap_outliers(df, bounds, ["Close"]).collect()), key=str)]
    monkeypatch.setattr(groups, "BROADCAST_GROUPS", 0)
    found.append(sorted(map(tuple, cap_outliers(df, bounds, ["Close"]).collect()), key=str))
    assert found[0] == found[1] and len(found[0]) == 90 and max(r[2] for r in found[0]) < 36


def test_keys_come_from_the_bits_and_histograms_are_hashed(spark):
    """Arithmetic per value and a carried text per group made the first pass costly."""
    from barflow.operators import quantiles

    df = spark.createDataFrame([("a", 1.0), (None, 2.0)], "symbol string, x double")
    assert "LOG2" not in quantiles.add_sortable(df)._jdf.queryExecution().executedPlan().toString().upper()
    seen = []
    real = quantiles.materialize
    quantiles.materialize = lambda d: seen.append(d._jdf.queryExecution().executedPlan().toString()) or real(d)
    try:
        assert exact_quantiles(df, ["x"], (0.5,), ["symbol"]).count() == 2
    finally:
        quantiles.materialize = real
    histogram = next(p for p in seen if "posexplode" in p)
    assert "SortAggregate" not in histogram and "HashAggregate" in histogram


def test_sorted_groups_equal_selected_ones(spark, monkeypatch):
    """Groups of both kinds in one table, with nulls, NaN, both zeros and ties; small ones alone store nothing but the values."""
    from barflow.operators import quantiles

    rng = np.random.default_rng(5)
    rows = [(k, float(x)) for k, n in (("a", 30), ("b", 9), (None, 8), ("", 1)) for x in rng.integers(-3, 4, n)]
    rows += [("b", None), ("b", -0.0), ("nan", float("nan")), ("nan", 1.0), ("none", None), ("a", float("inf")), ("a", -float("inf"))]
    df = spark.createDataFrame(rows, "symbol string, x double")
    want = sorted(map(str, exact_quantiles(df, ["x"], PROBS, ["symbol"]).collect()))
    for most in (0, 9, 100):
        monkeypatch.setattr(quantiles, "SORTED_GROUP_ROWS", most)
        assert sorted(map(str, quantiles.group_quantiles(df, ["x"], PROBS, ["symbol"]).collect())) == want
        whole = quantiles.group_quantiles(df.where("NOT isnan(x)"), ["x"], PROBS)
        assert str(whole.first()) == str(exact_quantiles(df.where("NOT isnan(x)"), ["x"], PROBS).first())
    stored = []
    real = quantiles.materialize
    monkeypatch.setattr(quantiles, "materialize", lambda d: stored.append(d) or real(d))
    iqr_bounds(df, ["x"])
    assert len(stored) == 1
