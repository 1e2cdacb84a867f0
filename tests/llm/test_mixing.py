import re
from collections import defaultdict

from pyspark.sql import functions as F

from barflow.llm.mixing import mix_sources, repeat_taken, targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _fill(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by dealing the rest again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full, out = share * sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        out = {s: most * sizes[s] if s in full else rest * weight[s] / free for s in order}
        over = {s for s in order if s not in full and out[s] > most * sizes[s]}
        if not over:
            return out
        full |= over


def test_targets(spark):
    for sizes in ({"a": 10, "b": 100, None: 50, "": 7}, {"a": 5}, {"x": 0, "y": 3}, {f"s{i}": i * i for i in range(20)}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        found = {r[0]: r[2] for r in targets(df, (5.0, 2.0, 1.0), 1.5, 2.0).collect()}
        for s, t in _fill(sizes).items():
            assert abs(found[s] - t) < 1e-6, (sizes, s)


def _docs(spark, n=6000):
    return spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.expr("repeat('w ', cast(1 + pow(id % 97, 2) / 40 as int))").alias("text"),
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('s', id % 7) END").alias("source"),
        F.lit(1).alias("before"),
        F.lit(2).alias("Size"),
    )


def test_taken_words_come_near_the_target(spark):
    found = mix_sources(_docs(spark))
    by = defaultdict(lambda: [0, 0, 0.0])
    for r in found.collect():
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] % max(1, r["size"]) == 0
        assert r["size"] == len(WORD.findall(r["text"]))
        by[r["source"]][0] += r["taken"]
        by[r["source"]][1] += r["size"]
        by[r["source"]][2] = r["target"]
    expected = _fill({s: v[1] for s, v in by.items()})
    for s, (taken, size, target) in by.items():
        assert abs(target - expected[s]) < 1e-6 * max(1, target)
        assert abs(taken - target) <= 0.02 * size + 300, s
    assert sorted(found.columns, key=str.lower) == sorted(
        ["doc_id", "text", "source", "before", "size", "source_size", "target", "taken"]
    )


def test_reruns_agree_and_partitions_do_not_matter(spark):
    docs = _docs(spark, 2000)
    keys = ["doc_id", "taken"]
    a = sorted(mix_sources(docs).select(*keys).collect())
    assert a == sorted(mix_sources(docs.repartition(7, "text")).select(*keys).collect())


def test_nulls_empty_and_repeated_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y", None), (3, "x y", None), (None, "z", "b"), (4, "p q r", "b")]
    found = mix_sources(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    got = {(r["doc_id"], r["source"]): r for r in found.collect()}
    assert found.count() == 6 and got[1, "a"]["size"] == 0 and got[1, "a"]["taken"] == 0
    assert got[None, "b"]["source_size"] == 4
    empty = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert mix_sources(empty).count() == 0


def test_repeat_taken(spark):
    mixed = mix_sources(_docs(spark, 500))
    total = mixed.agg(F.sum(F.when(F.col("size") > 0, F.col("taken") / F.col("size")))).first()[0]
    assert repeat_taken(mixed).count() == int(total)
