import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barflow.operators import assemble as A
from barflow.operators import clean, explore, news, runs
from barflow.operators.targets import target_variables
from barflow.sources import market, store


def _bars(spark, n=50, symbols=("a", "b", "c")):
    rows = [(s, dt.date(2024, 1, 1) + dt.timedelta(days=i), float(i + j), 100 + i) for j, s in enumerate(symbols) for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, date date, Close double, Volume int")


@pytest.mark.parametrize("mode", ["global_time", "position", "per_symbol_time"])
def test_splits_partition_the_rows_in_order(spark, mode):
    df = _bars(spark)
    out = A.three_way_split(df, mode=mode, block_rows=16) if mode != "global_time" else A.three_way_split(df)
    pdf = out.toPandas()
    assert len(pdf) == 150 and set(pdf.split) == {"train", "val", "test"}
    if mode == "position":
        pdf = pdf.sort_values(["symbol", "date"])
        assert pdf.split.tolist() == ["train"] * 105 + ["val"] * 22 + ["test"] * 23
    elif mode == "global_time":
        assert pdf.groupby("date").split.nunique().max() == 1
        assert pdf[pdf.split == "train"].date.max() < pdf[pdf.split == "test"].date.min()
    else:
        assert (pdf[pdf.split == "train"].groupby("symbol").size() == 35).all()


def test_split_errors(spark):
    with pytest.raises(ValueError):
        A.split_dataset(_bars(spark), mode="random")
    with pytest.raises(ValueError):
        A.split_dataset(_bars(spark), (0.5,), ("a",))
    with pytest.raises(ValueError):
        A.first_sample(_bars(spark).withColumn("split", F.lit("train")), "val")
    with pytest.raises(ValueError):
        A.first_sample(_bars(spark).withColumn("split", F.lit("train")), "dev")


@pytest.mark.parametrize("block_rows", [1000, 12])
def test_sequences(spark, block_rows):
    out = A.create_sequences(_bars(spark, 20, ("a",)), 5, block_rows=block_rows).orderBy("date").collect()
    assert len(out) == 15 and out[0]["X"] == [0, 1, 2, 3, 4] and out[0]["y"] == 5
    gaps = _bars(spark, 20, ("a",)).withColumn("Close", F.when(F.col("Close") != 3, F.col("Close")))
    assert A.create_sequences(gaps, 5).orderBy("date").first()["X"][3] is None


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (3.0, 5.0, 2.0)], "a double, b double, c double")
    std = A.scale_features(df, ["a", "b", "c"]).orderBy("a").collect()
    assert [tuple(r) for r in std] == [(-1.0, 0.0, None), (1.0, 0.0, 0.0)]
    assert [tuple(r) for r in A.scale_features(df, ["a", "b"], "minmax").orderBy("a").select("a", "b").collect()] == [(0, 0), (1, 0)]
    with pytest.raises(ValueError):
        A.fit_scaler(df, ["a"], "robust")


def test_feature_scores_rank_ties_and_constants(spark):
    rng = np.random.default_rng(2)
    rows = [(float(x), float(x + e), float(x + e), 1.0) for x, e in zip(rng.normal(size=50), rng.normal(size=50))]
    df = spark.createDataFrame(rows, "y double, a double, b double, flat double")
    scores = {r["feature"]: r for r in A.feature_scores(df, ["a", "b", "flat"], "y", 1).collect()}
    assert scores["b"]["selected"] and not scores["a"]["selected"] and scores["flat"]["score"] == 0
    r = np.corrcoef([x[0] for x in rows], [x[1] for x in rows])[0, 1]
    assert np.isclose(scores["a"]["score"], r * r / (1 - r * r) * 48)
    assert A.select_features(df, ["a", "b", "flat"], "y", 2).columns == ["y", "a", "b"]


def test_batches_number_every_row_once(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    for seed in (None, 3):
        out = A.mini_batches(df, "k", 7, seed).toPandas()
        assert sorted(zip(out.batch_id, out.batch_pos)) == [(i // 7, i % 7) for i in range(1000)]
    one = A.mini_batches(df, "k", 7, 3).orderBy("batch_id", "batch_pos").toPandas().k.tolist()
    assert one == A.mini_batches(df.repartition(3), "k", 7, 3).orderBy("batch_id", "batch_pos").toPandas().k.tolist()
    assert one != sorted(one)


def test_news_join_keeps_every_bar(spark):
    articles = spark.createDataFrame(
        [("a", "2024-01-01 10:00:00", "x", 1.0), ("a", "2024-01-01 11:00:00", "y", None), ("zz", "2024-01-01 00:00:00", "z", 1.0)],
        "symbol string, date string, title string, sentiment double",
    ).withColumn("date", F.col("date").cast("timestamp_ntz"))
    out = news.news_features(articles, _bars(spark)).toPandas().set_index(["symbol", "date"])
    hit = out.loc[("a", dt.date(2024, 1, 1))]
    assert len(out) == 150 and hit.news_count == 2 and hit.sentiment_mean == 1 and hit.sentiment_std == 0 and hit.sentiment_count == 1
    miss = out.loc[("b", dt.date(2024, 1, 1))]
    assert miss.news_count == 0 and np.isnan(miss.sentiment_count)


def test_validation_and_feature_columns(spark):
    df = _bars(spark).withColumn("t", F.when(F.col("Close") > 3, 1))
    row = clean.validate_samples(df, "t").first()
    assert (row["samples"], row["missing_targets"]) == (150, 9)
    for bad in (lambda: clean.validate_samples(df, "zz"), lambda: clean.validate_samples(df.drop("symbol"), "t")):
        with pytest.raises(ValueError):
            bad()
    wide = df.withColumns({c: F.lit(1) for c in ("price_direction_1d", "next_price_change_5d", "price_change_20d", "volatility_20d", "Price_change_5d")})
    assert clean.feature_columns(wide) == ["Close", "Volume", "t", "Price_change_5d"]
    assert "volatility_20d" in clean.feature_columns(wide, reference_compat=True)


def test_explore(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a"), (2.0, None, "b"), (3.0, 6.0, "a"), (4.0, 9.0, None)], "x double, y double, s string")
    d = {r["column"]: r for r in explore.describe(df, ["x", "y"]).collect()}
    assert (d["x"]["p25"], d["x"]["count"], d["y"]["count"]) == (1.75, 4, 3)
    v = [tuple(r) for r in explore.value_counts(df, "s").collect()]
    assert v[0][:2] == ("a", 2) and np.isclose(v[0][2], 200 / 3)
    h = explore.histogram(df, "x", 3).orderBy("bin").collect()
    assert [r["count"] for r in h] == [1, 1, 2] and h[-1]["upper"] == 4
    flat = explore.histogram(df.withColumn("x", F.lit(1.0)), "x", 2).orderBy("bin").collect()
    assert [r["count"] for r in flat] == [4, 0]
    c = {(r["a"], r["b"]): r["corr"] for r in explore.correlations(df, ["x", "y"]).collect()}
    assert len(c) == 4 and np.isclose(c["x", "y"], np.corrcoef([1, 3, 4], [2, 6, 9])[0, 1])
    assert explore.correlations(df, ["x", "y"], lower_only=True).count() == 1
    assert explore.top_correlated(df, ["x", "y"], "x", 5).first()["feature"] == "y"


def test_experiments(spark):
    log = spark.createDataFrame(
        [("e", 1, 1, "loss", 9.0), ("e", 2, 2, "loss", 5.0), ("e", 3, 1, "acc", 0.1), ("e", 4, None, "f1", 0.3), ("e", 5, None, "loss", 4.0)],
        "experiment string, seq bigint, step bigint, name string, value double",
    ).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    final = {r["name"]: r["value"] for r in runs.final_metrics(log).collect()}
    assert final == {"loss": 4.0, "f1": 0.3}
    events = spark.createDataFrame(
        [("e", "2024-01-01 00:00:00", "running"), ("e", "2024-01-01 01:00:00", "completed"), ("r", "2024-01-01 00:00:00", "running")],
        "experiment string, ts string, status string",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = {r["experiment"]: r for r in runs.experiment_summary(events, log, ["loss", "acc"], now="2024-01-01 00:00:10").collect()}
    assert out["e"]["duration"] == 3600 and out["e"]["status"] == "completed" and out["e"]["loss"] == 4.0 and out["e"]["acc"] is None
    assert out["r"]["duration"] == 10 and out["r"]["end_time"] is None and out["r"]["num_metrics"] == 0


def test_metric_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    for step in (1, 2):
        m = spark.createDataFrame([(0.5 * step, step)], "acc double, n int")
        rows = runs.metric_rows(m, "e", step, step, "2024-01-01 00:00:00")
        assert runs.log_metrics(rows, path, f"step {step}") and not runs.log_metrics(rows, path, f"step {step}")
    wide = runs.metrics_summary(runs.metric_history(spark, path), ["acc", "n"]).orderBy("step").collect()
    assert [(r["step"], r["acc"], r["n"]) for r in wide] == [(1, 0.5, 1.0), (2, 1.0, 2.0)]


def test_store_precedence_and_missing(spark, tmp_path):
    base = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        store.load_saved(spark, base, "a int")
    store.save_json(spark.createDataFrame([(1,)], "a int"), base)
    assert store.load_saved(spark, base, "a int").first()["a"] == 1
    store.save_csv(spark.createDataFrame([(2, [1])], "a int, b array<int>"), base)
    assert store.load_saved(spark, base, "a int, b string").first()["b"] == "[1]"
    assert market.read_table(spark, f"{base}.csv", "a int, b string").count() == 1
    with pytest.raises(ValueError):
        market.read_table(spark, f"{base}.csv")


def test_sources(spark):
    bars = _bars(spark).withColumn("Close", F.when(F.col("Close") == 2, float("nan")).otherwise(F.col("Close")))
    got = market.load_price_data(bars, ["a", "zz"], "2024-01-02", "2024-01-04")
    assert sorted(r["date"].day for r in got.collect()) == [2, 3] and got.where("Close IS NULL").count() == 1
    assert [r[0] for r in market.missing_symbols(bars, ["a", "zz"]).collect()] == ["zz"]
    words = spark.createDataFrame([("Positive",), ("negative",), ("0.25",), ("?",)], "sentiment string")
    assert [r[0] for r in market.numeric_sentiment(words).collect()] == [1.0, -1.0, 0.25, None]
    info = spark.createDataFrame([("a", {"marketCap": "10", "trailingPE": "x", "sector": "s"})], "symbol string, info map<string,string>")
    row = market.load_fundamental_data(info).first()
    assert (row["market_cap"], row["pe_ratio"], row["sector"], row["roe"]) == (10.0, None, "s", None)


def test_resampling_breaks_ties_by_the_order_key(spark):
    t = spark.createDataFrame([("a", "2024-01-01 00:00:01", 2, 5.0), ("a", "2024-01-01 00:00:01", 1, 7.0), ("a", "2024-01-01 00:59:00", 3, 6.0)],
                              "symbol string, ts string, id int, price double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    row = market.resample_ohlcv(t, "1h", order=["ts", "id"]).first()
    assert (row["Open"], row["High"], row["Low"], row["Close"], row["Volume"]) == (7.0, 7.0, 5.0, 6.0, 3)
    with pytest.raises(ValueError):
        market.resample_ohlcv(t.withColumn("ts", F.to_date("ts")), "1h")


def test_feature_table_has_indicators_and_targets_side_by_side(spark):
    table = A.feature_table(_bars(spark, 60), clean=False)
    assert {"Price_change_5d", "next_price_change_5d", "MACD_signal", "volatility_20d"} <= set(table.columns)
    row = table.where("symbol = 'a' AND date = '2024-01-11'").first()
    assert np.isclose(row["Price_change_5d"], 10 / 5 - 1) and np.isclose(row["next_price_change_5d"], 15 / 10 - 1)
    with pytest.raises(ValueError):
        target_variables(table.select("symbol", "date", "Close", "Price_change_5d"), [5])


def test_samples_with_contexts_and_ids(spark):
    from barflow.functions.vectors import DEFAULT_DIM, hash_embedding
    from barflow.operators.datasets import prepare_datasets
    from barflow.operators.tokens import vocabulary

    rows = [(1, "a", "2024-01-01", 1.5, 1, "train"), (2, "b", "2024-01-02", 2.5, 0, "val"), (3, "b", "2024-01-03", None, None, "test")]
    samples = spark.createDataFrame(rows, "sample_id int, symbol string, date string, Close double, price_direction_1d int, split string")
    docs = spark.createDataFrame([(10, "a 2024-01-01 gains", {}), (11, "b 2024-01-02 losses", {})], "doc_id int, text string, metadata map<string,string>")
    docs = docs.withColumn("vec", hash_embedding("text", DEFAULT_DIM))
    plain = prepare_datasets(samples, features=["Close"])
    vocab = vocabulary(plain, "prompt", 5)
    made = prepare_datasets(samples, features=["Close"], docs=docs, context_length=1, vocab=vocab, max_length=6)
    got = {r["sample_id"]: r for r in made.collect()}
    assert [got[i]["label"] for i in (1, 2, 3)] == [1, 0, 0] and [got[i]["split"] for i in (1, 2, 3)] == ["train", "val", "test"]
    assert "Close: 1.50" in got[1]["prompt"] and "Context: a 2024-01-01 gains" in got[1]["prompt"]
    assert "Context: b 2024-01-02 losses" in got[2]["prompt"] and "Features" not in got[3]["prompt"]
    assert all(len(r["input_ids"]) == len(r["attention_mask"]) == 6 for r in got.values())
    assert "context" not in prepare_datasets(samples, features=["Close"], docs=docs, include_context=False).columns


def test_correlations_of_many_pairs_are_one_narrow_aggregation(spark):
    """Buffers for every pair in one aggregation make code too long to be compiled; the sums of one pair do not."""
    from barflow.operators.correlation import pair_correlations

    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(rng.normal(size=(60, 9)), columns=list("abcdefghi"))
    pdf["i"] = 2.0
    pairs = [(a, b) for a in pdf.columns for b in pdf.columns]
    df = spark.createDataFrame(pdf).withColumn("b", F.when(F.col("a") > 0, F.col("b")))
    held = pair_correlations(df, pairs)
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert plan.count("covar_pop") <= 6 and "Union" not in plan
    masked = pdf.assign(b=pdf["b"].where(pdf["a"] > 0))
    for r in held.collect():
        both = masked[[r["a"], r["b"]]].dropna() if r["a"] != r["b"] else masked[[r["a"]]].dropna()
        assert r["n"] == len(both)
        if "i" in (r["a"], r["b"]):
            assert r["corr"] is None
        else:
            assert abs(r["corr"] - masked[r["a"]].corr(masked[r["b"]])) < 1e-12
    empty = pair_correlations(df.limit(0), pairs[:2]).orderBy("pair").collect()
    assert [(r["pair"], r["n"], r["corr"]) for r in empty] == [(0, 0, None), (1, 0, None)]
    assert pair_correlations(df, []).collect() == []


def test_counting_rows_with_a_target_makes_no_target(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(5)], "symbol string, date int, Close double")
    made = clean.drop_missing_targets(target_variables(df, [1]), "price_direction_1d")
    assert "Window" not in made.groupBy("date").count()._jdf.queryExecution().optimizedPlan().toString()
    nan = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "t double")
    assert clean.drop_missing_targets(nan, "t").count() == 1


def test_words_are_counted_in_parts_and_split_at_ascii_white_space(spark, monkeypatch):

    import pyarrow as pa

    from barflow.operators import tokens

    words = ["x", "y z", "x", "あ", "x "]
    texts = [(" \t\n\x0b\f\r".join(words),), (None,), ("",), (" あ x ",)]
    df = spark.createDataFrame(texts, "t string").coalesce(1)
    vocab = tokens.vocabulary(df, "t", 3)
    assert [tuple(r) for r in vocab.orderBy("token_id").collect()] == [("x", 2), ("あ", 3), ("x ", 4)]
    ids = [list(r[0]) for r in tokens.tokenize(df, "t", "t", vocab, 6).select("input_ids").collect()]
    assert ids == [[2, 1, 2, 3, 4, 0], [0] * 6, [0] * 6, [3, 2, 0, 0, 0, 0]]
    monkeypatch.setattr(tokens, "COUNTED_WORDS", 2)
    parts = list(tokens._count_words(iter([pa.RecordBatch.from_pydict({"t": ["a b", "a", "c d a"]})])))
    assert max(p.num_rows for p in parts) <= 3 and len(parts) > 2 and sum(sum(p.column(1).to_pylist()) for p in parts) == 6
