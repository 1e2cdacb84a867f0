import math
import re

import numpy as np
import pytest
import xxhash

from barflow.llm.queries import LLM_QUERIES
from barflow.llm.toxicity import FEATURES, OrdinalModel, counts, features, fit, grade, severity, train


def _made(rng, n):
    rows = []
    for i in range(n):
        level = int(rng.integers(0, 4))
        words = [f"w{rng.integers(0, 300)}" for _ in range(int(rng.integers(5, 60)))] + ["nasty", "nastier"][: level % 3] * level
        rows.append((i, " ".join(words), level))
    return rows


def test_thresholds_are_ordered_and_weights_shared():
    rng = np.random.default_rng(1)
    rows = _made(rng, 600)
    model = fit([counts(t) for _, t, _ in rows], np.array([g for *_, g in rows]), 3)
    assert isinstance(model, OrdinalModel) and (np.diff(model.thresholds) > 0).all() and model.weights.ndim == 1
    above = model.exceed(np.array([-5.0, 0.0, 5.0]))
    assert (np.diff(above, axis=1) < 0).all() and (np.diff(above, axis=0) > 0).all()


def test_features_of_a_word_are_its_prefixes():
    assert len(features("ab")) == 1 and len(features("abcdef")) == 4
    assert set(features("abcdxx")) & set(features("abcdyy"))
    ids, n = counts("b a b")
    assert n.sum() == 3 and len(ids) == 2


def test_severity_orders_toxic_rows():
    docs = [counts(t) for t in ["good day", "bad day", "bad bad day", "bad bad bad day", "nice day"]]
    assert severity(docs, np.array([0, 1, 1, 1, 0])).tolist() == [0, 1, 2, 3, 0]


@pytest.mark.parametrize("labels", [[], [0, 0], [1, 1]])
def test_nothing_to_tell_apart(labels):
    model = fit([counts("a b")] * len(labels), np.array(labels, np.int64), 3)
    assert len(model.weights) == 0 and (model.exceed(np.zeros(1))[0, 0] > 0.5) == (1 in labels)


def test_nulls_empty_texts_and_clashing_columns(spark, docs_of):
    docs = docs_of([(i, f"nasty word{i}" if i % 2 else f"kind word{i}") for i in range(60)] + [(60, None), (61, ""), (None, "nasty"), (62, "filler " * 40_000 + "nasty")])
    docs = docs.selectExpr("*", "true AS Toxic", "1 AS label")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (5, None), (999, 1), (60, 0)], "doc_id bigint, toxic int")
    found = grade(docs, train(docs, labels)).collect()
    got = {r["doc_id"]: r for r in found}
    assert [got[i]["toxic"] for i in range(60)] == [bool(i % 2) for i in range(60)]
    assert not got[60]["toxic"] and not got[61]["toxic"] and got[None]["toxic"] and got[62]["toxic"]
    assert grade(docs.limit(0), train(docs, labels.limit(0))).count() == 0
    assert all(r["toxic"] == (r["grade"] > 0) and 0 <= r["expected_severity"] <= 3 for r in found)


def test_given_grades_are_learned(spark):
    rows = _made(np.random.default_rng(2), 400)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, level int")
    model = train(df, df.selectExpr("doc_id", "level AS toxic"), graded=True)
    found = {r["doc_id"]: r["expected_severity"] for r in grade(df, model).collect()}
    means = [np.mean([found[i] for i, _, g in rows if g == k]) for k in (0, 1, 2)]
    assert means[0] < means[1] < means[2]


def test_held_out_accuracy(spark):
    """Fit on half of the labelled rows, judge the other half. One toxic label in twenty stands on a text without a toxic word."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = train(docs, labels.filter("xxhash64(doc_id) % 2 = 0"))
    judged = grade(docs, model).join(labels.filter("xxhash64(doc_id) % 2 <> 0").withColumnRenamed("toxic", "truth"), "doc_id")
    table = {(r[0], r[1]): r[2] for r in judged.groupBy("toxic", "truth").count().collect()}
    hit, miss, false = (table.get(k, 0) for k in ((True, 1), (False, 1), (True, 0)))
    assert hit >= 50 and hit / (hit + miss) > 0.85 and false <= 0.01 * table[False, 0]


def severity_by_hand(model, text):
    """(expected severity, grade) of one text from the fitted weights, feature by feature."""
    weight = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    times = {}
    for word in re.findall(r"\w+", (text or "").lower()):
        for part in {word} | {f"^{word[:k]}" for k in (3, 4, 5) if len(word) > k}:
            f = xxhash.xxh3_64_intdigest(part) % FEATURES
            times.setdefault(f, {}).setdefault(word, 0)
            times[f][word] += 1
    score = sum(weight[f] * math.log1p(sum(n.values())) for f, n in times.items() if f in weight)
    above = [1 / (1 + math.exp(-max(-40.0, min(40.0, score - t)))) for t in model.thresholds]
    return sum(above), sum(a >= 0.5 for a in above)


def test_query_against_scores_by_hand(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{small}/labels.parquet"))
    found = {r["doc_id"]: r for r in LLM_QUERIES["op6_toxicity"](spark, small).collect()}
    assert len(model.weights) and len(found) == docs.count()
    for r in docs.collect():
        expected, level = severity_by_hand(model, r["text"])
        got = found[r["doc_id"]]
        assert abs(got["expected_severity"] - expected) < 1e-6 and got["grade"] == level and got["toxic"] == (level > 0)
