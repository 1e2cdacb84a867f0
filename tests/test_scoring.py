import numpy as np
import pytest
from pyspark.sql import functions as F

from barflow.operators import scoring as S


@pytest.fixture(scope="module")
def samples(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "a", float(x), float(n), int(x > 0), "bad news" if i % 2 else "") for i, (x, n) in enumerate(rng.normal(size=(400, 2)))]
    return spark.createDataFrame(rows, "sample_id bigint, symbol string, x double, noise double, up int, context string")


def test_model_learns_saves_and_evaluates(samples, tmp_path):
    gaps = samples.withColumn("noise", F.when(F.col("sample_id") % 9 != 0, F.col("noise")))
    model = S.train_direction(gaps, ["x", "noise"], "up")
    S.save_model(model, str(tmp_path / "m"))
    again = S.load_model(str(tmp_path / "m"))
    for m in (model, again):
        row = S.evaluate(gaps, ["x", "noise"], S.model_scorer(m, ["x", "noise"]), "up").first()
        assert row["direction_accuracy"] > 0.95 and row["total_predictions"] == 400
    assert S.evaluate_scores(gaps, S.model_scorer(model, ["x", "noise"]), "up").first()["accuracy"] > 0.95


def test_prediction_record(samples):
    out = S.predict(samples, ["symbol", "x"], S.linear_scorer({"x": 1.0}), keep=["sample_id"], now=F.lit("t"))
    assert out.columns == ["sample_id", "prediction", "response", "input_text", "confidence", "timestamp", "input_symbol", "input_x"]
    for r in out.limit(20).collect():
        assert r["prediction"]["direction"] == ("UP" if r["input_x"] > 0 else "DOWN")
        assert 0.5 <= r["confidence"] < 1 and "Context" not in r["input_text"]
    with_context = S.predict(samples.where("context <> ''"), ["x"], S.linear_scorer({"x": 1.0}), "context")
    assert "Context: bad news" in with_context.first()["input_text"]


def test_importance_marks_the_feature_that_decides(samples):
    scorer = S.linear_scorer({"x": 1.0, "noise": 0.0})
    found = S.global_importance(S.feature_importance(samples, ["symbol", "x", "noise"], scorer))
    got = {r["feature"]: r["importance"] for r in found.collect()}
    ups = samples.where("x > 0").count() / 400
    assert got == {"x": pytest.approx(ups), "noise": 0.0}


def test_context_contribution_and_explanation(samples):
    scorer = S.linear_scorer({"x": 1.0}, 0.0, {"bad": -100.0})
    effect = S.context_contribution(samples, scorer)
    changed = {r["sample_id"] for r in effect.where("context_impact").collect()}
    assert changed == {r["sample_id"] for r in samples.where("context <> '' AND x > 0").collect()}
    rows = {r["sample_id"]: r for r in S.explain(samples, ["x"], scorer, "context").collect()}
    assert rows[0]["context_analysis"] is None and rows[1]["context_analysis"] is not None
    assert set(rows[1]["feature_analysis"]) == {"x"}
    full = S.run_predictions(samples, ["x"], scorer, "context")
    assert full.count() == 400 and "explanation" in full.columns
    assert "explanation" not in S.run_predictions(samples, ["x"], scorer, explanations=False).columns


def test_text_model_gets_prompts_in_batches(samples):
    scorer = S.prompt_scorer(["x"], lambda prompts: ["UP" if "x: -" not in p else "DOWN" for p in prompts])
    out = S.predict(samples, ["x"], scorer).collect()
    assert all((r["prediction"]["direction"] == "UP") == (round(r["input_x"], 4) >= 0 and r["input_x"] >= 0) for r in out)
    assert {r["confidence"] for r in out} == {0.5}
