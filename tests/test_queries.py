"""Registered queries against their SQL twins, and the plans they run with."""

import datetime as dt
import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_points
from barflow.operators.indicators import technical_indicators
from barflow.plans import ORACLES, QUERIES
from barflow.sources.market import load_price_data

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
# One or two per module by default; set ALL_QUERIES=1 for every query.
SAMPLE = """a02_resample_trades a04_load_fundamental_data a09_json_payload b01_forward_fill_small_blocks b05_clean_price_data
c00_all_indicators c03_recursive_hourly_small_blocks c20_return_volatility d03_targets_small_blocks e03_news_features
f01_split_by_position f03_create_sequences f08_feature_scores f13_prepare_data g01_feature_text g06_tokenize g12_format_template
h04_hash_embedding h06_search_cosine_blocks h14_chunk_text h15_clean_documents i02_price_metrics i09_max_drawdown_small_blocks
i13_confidence_metrics i17_score_calibration j06_feature_importance j08_explain k04_describe k09_correlations
l03_experiment_summary""".split()
CHECKED = sorted(ORACLES) if os.environ.get("ALL_QUERIES") else SAMPLE


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda t: [(x is None, str(x)) for x in t])


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    found = duck.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, found.fetchall())


def test_registry():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {
        "h11_contexts_of_samples", "j01_train_direction", "j10_train_and_evaluate",
    }
    for letter in "abcdefghijkl":
        assert any(n.startswith(letter) for n in QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).columns
    assert QUERIES.keys() <= entry_points.queries().keys()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_price_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "bars")
    rows = [("a", dt.date(2024, 1, 1), 1.0), ("b", dt.date(2024, 1, 2), 2.0)]
    spark.createDataFrame(rows, "symbol string, date date, Close double").write.partitionBy("symbol").parquet(path)
    plan = _plan(load_price_data(spark.read.parquet(path), ["a"], "2024-01-01", "2024-02-01"))
    assert "GreaterThanOrEqual(date" in plan and "LessThan(date" in plan
    assert "PartitionFilters: [isnotnull(symbol" in plan or "PartitionFilters: [symbol" in plan


def _ran(df):
    df.collect()
    return _plan(df).split("Initial Plan")[0]


def test_all_indicators_share_one_shuffle_by_block(spark, tick_series):
    """Short series are shuffled once, by key. Long ones once by block, and their prices alone once more for the blocks' maps."""
    whole = _ran(technical_indicators(tick_series, order="id"))
    cut = _ran(technical_indicators(tick_series, order="id", block_rows=200, bucket="id div 40"))
    assert whole.count("Exchange hashpartitioning(") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(_run#\d+, _blk", cut)) == 2
    for plan in (whole, cut):
        assert "Exchange SinglePartition" not in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", ["b01_forward_fill_small_blocks", "c03_recursive_hourly_small_blocks", "d03_targets_small_blocks"])
def test_no_series_is_gathered_in_one_task(spark, small, name):
    """Windows ordered by date are partitioned by block, never by symbol alone."""
    plan = _plan(QUERIES[name](spark, small))
    specs = re.findall(r"windowspecdefinition\(([^()]*)", plan)
    ordered = [x for x in specs if re.search(r"\b(date|ts)#", x)]
    assert ordered and all("_blk#" in x for x in ordered)
