import random

import pytest
from pyspark.sql import functions as F

from barflow.operators.assemble import mini_batches, split_dataset
from barflow.operators.numbering import number_rows
from barflow.operators.retrieval import number_documents
from barflow.sources.batches import append_batch, committed_batches, read_batches


def test_numbers_have_no_gaps_and_follow_the_order(spark):
    keys = [random.Random(1).choice([None, *range(50)]) for _ in range(3000)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int").repartition(7)
    rows = sorted(number_rows(df, ["k"], "n", 5).collect(), key=lambda r: r["n"])
    assert [r["n"] for r in rows] == list(range(5, 3005))
    assert [r["k"] for r in rows] == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert sorted(r["i"] for r in rows) == list(range(3000))


def test_equal_rows_are_dealt_apart(spark):
    df = spark.range(8000).select(F.lit("same").alias("k")).repartition(6)
    numbered = number_rows(df, ["k"], "n")
    assert numbered.agg(F.countDistinct("n"), F.min("n"), F.max("n")).first() == (8000, 0, 7999)
    assert number_rows(df.limit(0), ["k"], "n").count() == 0


def test_documents_keep_their_ids_however_they_are_dealt(spark):
    rows = [(f"text {i % 40}", {"a": str(i % 3), "b": "x"}) for i in range(120)] + [(None, None)]
    df = spark.createDataFrame(rows, "text string, metadata map<string,string>")
    seen = [
        sorted((r["doc_id"], r["text"], str(sorted((r["metadata"] or {}).items()))) for r in number_documents(df.repartition(n), 10).collect())
        for n in (1, 5)
    ]
    assert seen[0] == seen[1] and [r[0] for r in seen[0]] == list(range(10, 131))


def test_batches_in_order_have_no_window_over_all_rows(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    out = mini_batches(df, "k", 8)
    assert {(r["k"], r["batch_id"], r["batch_pos"]) for r in out.collect()} == {(k, k // 8, k % 8) for k in range(1000)}


def test_split_by_position_over_two_symbols(spark):
    df = spark.createDataFrame([(s, d) for s in "ab" for d in range(10)], "symbol string, date int")
    got = {(r["symbol"], r["date"]): r["split"] for r in split_dataset(df, (0.75,), mode="position").collect()}
    assert all(got[k] == ("train" if i < 15 else "test") for i, k in enumerate(sorted(got)))
    each = {(r["symbol"], r["date"]): r["split"] for r in split_dataset(df, (0.75,), mode="per_symbol_time").collect()}
    assert all(each[k] == ("train" if k[1] < 7 else "test") for k in each)


def test_a_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1,), (2,)], "a int")
    with pytest.raises(ValueError):
        read_batches(spark, path)
    assert append_batch(df, path, "1") and not append_batch(df, path, "1")
    df.write.parquet(f"{path}/data/batch=2")  # an attempt that was never committed
    assert read_batches(spark, path).count() == 2
    assert append_batch(df.limit(0), path, "3") and append_batch(df, path, "2")
    assert read_batches(spark, path).groupBy("batch").count().collect() and read_batches(spark, path).count() == 4
    assert sorted(r[0] for r in committed_batches(spark, path).collect()) == ["1", "2", "3"]
    with pytest.raises(ValueError):
        append_batch(df, path, "a/b")
