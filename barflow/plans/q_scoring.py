"""Registered queries: training, scoring, explaining."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from barflow.functions import prompts as P
from barflow.operators import scoring as S
from barflow.operators.assemble import split_dataset
from barflow.operators.retrieval import align_contexts
from barflow.operators.targets import target_variables
from barflow.plans import inputs as I
from barflow.plans.inputs import sql
from barflow.plans.registry import query
from barflow.session import materialize, shared_dir

FEATURES = ("Open", "High", "Low", "Close", "Price_change")
# A rule with a known answer: up when the close is above its 20-bar mean.
WEIGHTS = {"Close": 1.0, "SMA_20": -1.0}
RULE_FEATURES = ("symbol", "date", "Close", "SMA_20")
_W = "OVER (PARTITION BY symbol ORDER BY date)"
_LOGIT = "coalesce(Close, 0) - coalesce(SMA_20, 0)"


def _table(spark, folder):
    return I.features(spark, folder).select("symbol", "date", "Open", "High", "Low", "Close", "SMA_20", "Price_change")


def _rule():
    return S.linear_scorer(WEIGHTS)


def _samples(spark, folder):
    return materialize(split_dataset(target_variables(_table(spark, folder), [1]), (0.8,)))


def _trained(spark, folder):
    samples = _samples(spark, folder)
    model = S.train_direction(samples.where("split = 'train'"), FEATURES, "price_direction_1d", 20)
    return samples.where("split = 'test'"), model


@query("j01_train_direction")
def train_direction(spark, folder):
    test, model = _trained(spark, folder)
    scored = S.model_scorer(model, FEATURES)(test)
    return scored.select("symbol", "date", F.transform("scores", lambda x: F.round(x, 3)).alias("scores"), "response")


@query(
    "j02_save_and_load_model",
    sql("SELECT symbol, count(*) AS samples, count(*) AS equal FROM bars JOIN (SELECT date, sum(count(*)) OVER (ORDER BY date) "
        "- count(*) AS pos, sum(count(*)) OVER () AS n FROM bars GROUP BY date) USING (date) "
        "WHERE pos >= CAST(floor(n * 0.8::DOUBLE) AS BIGINT) GROUP BY symbol", "bars"),
)
def save_and_load_model(spark, folder):
    """A reloaded model must score every test sample like the fitted one."""
    test, model = _trained(spark, folder)
    path = f"{shared_dir(spark)}/model-{uuid.uuid4().hex}"
    S.save_model(model, path)
    first = S.model_scorer(model, FEATURES)(test).withColumnRenamed("scores", "fitted").drop("response")
    both = S.model_scorer(S.load_model(path), FEATURES)(first)
    return both.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("samples"), F.count_if(F.col("fitted") == F.col("scores")).alias("equal")
    )


_DIRECTION = f"CASE WHEN {_LOGIT} > 0 THEN 'UP' ELSE 'DOWN' END"
_CONFIDENCE = f"1 / (1 + exp(-abs({_LOGIT})))"


@query(
    "j05_predict_from_table",
    sql(f"SELECT symbol AS input_symbol, date AS input_date, {_DIRECTION} AS direction, 'MEDIUM' AS confidence_word, "
        f"'Direction: ' || {_DIRECTION} AS response, round({_CONFIDENCE}, 6) AS confidence, round(Close, 6) AS input_Close FROM features",
        "features"),
)
def predict_from_table(spark, folder):
    out = S.predict(_table(spark, folder), RULE_FEATURES, _rule(), now=F.lit("2024-01-01T00:00:00"))
    return out.select(
        "input_symbol", "input_date", F.col("prediction.direction").alias("direction"),
        F.col("prediction.confidence").alias("confidence_word"), "response",
        F.round("confidence", 6).alias("confidence"), F.round("input_Close", 6).alias("input_Close"),
    )


def _prompt(context: str = "") -> str:
    task = P.INFER_TASK.replace("'", "''")
    return (
        "'Symbol: ' || symbol || chr(10) || 'Date: ' || CAST(date AS VARCHAR) || chr(10) || 'Features: Close: ' || "
        f"printf('%.4f', Close) || chr(10) || {context}'{task}'"
    )


@query("j03_prediction_record", sql(f"SELECT symbol, date, {_prompt()} AS input_text FROM bars", "bars"))
def prediction_record(spark, folder):
    out = S.predict(I.bars(spark, folder), ["symbol", "date", "Close"], S.linear_scorer({"Close": 1.0}), keep=["symbol", "date"])
    return out.select("symbol", "date", "input_text")


@query(
    "j03_prompt_model",
    sql("SELECT symbol, date, 'Confidence HIGH, price will ' || CASE WHEN contains(p, '.5') THEN 'fall' ELSE 'rise' END AS response, "
        f"CASE WHEN contains(p, '.5') THEN 'DOWN' ELSE 'UP' END AS direction, 0.5::DOUBLE AS confidence FROM (SELECT symbol, date, {_prompt()} AS p "
        "FROM bars)", "bars"),
)
def prompt_model(spark, folder):
    """A plugged-in text model answers every prompt in batches."""

    def answer(texts):
        return ["Confidence HIGH, price will " + ("fall" if ".5" in t else "rise") for t in texts]

    features = ["symbol", "date", "Close"]
    out = S.predict(I.bars(spark, folder), features, S.prompt_scorer(features, answer), keep=["symbol", "date"])
    return out.select("symbol", "date", "response", F.col("prediction.direction").alias("direction"), "confidence")


@query(
    "j04_batch_predict_with_contexts",
    sql("SELECT doc_id AS sample_id, CASE WHEN coalesce(quality, 0) - 0.5 + CASE WHEN contains(upper(coalesce(b.text, '')), 'DATA') "
        "THEN 1 ELSE 0 END > 0 THEN 'UP' ELSE 'DOWN' END AS direction FROM documents LEFT JOIN labels USING (doc_id) "
        "LEFT JOIN benchmark b ON b.item_id = doc_id"),
)
def batch_predict(spark, folder):
    """Contexts are matched to samples by id; a sample without one is scored without."""
    docs = I.documents(spark, folder).join(I.table(spark, folder, "labels"), "doc_id", "left")
    samples = docs.select(F.col("doc_id").alias("sample_id"), "quality")
    contexts = I.table(spark, folder, "benchmark").select(F.col("item_id").alias("sample_id"), F.col("text").alias("context"))
    scorer = S.linear_scorer({"quality": 1.0}, -0.5, {"data": 1.0})
    out = S.predict(align_contexts(samples, contexts), ["quality"], scorer, "context", keep=["sample_id"])
    return out.select("sample_id", F.col("prediction.direction").alias("direction"))


_BASE_UP = f"({_LOGIT} > 0)"
_IMPORTANCE = (
    f"SELECT symbol, date, 'Close' AS feature, CAST({_BASE_UP} <> (0 - coalesce(SMA_20, 0) > 0) AS DOUBLE) AS importance "
    f"FROM features UNION ALL SELECT symbol, date, 'SMA_20', CAST({_BASE_UP} <> (coalesce(Close, 0) > 0) AS DOUBLE) FROM features"
)


@query("j06_feature_importance", sql(_IMPORTANCE, "features"))
def feature_importance(spark, folder):
    return S.feature_importance(_table(spark, folder), RULE_FEATURES, _rule(), ["symbol", "date"])


@query("j06_global_importance", sql(f"SELECT feature, round(avg(importance), 6) AS importance FROM ({_IMPORTANCE}) GROUP BY 1", "features"))
def global_importance(spark, folder):
    found = S.feature_importance(_table(spark, folder), RULE_FEATURES, _rule(), ["symbol", "date"])
    return S.global_importance(found).withColumn("importance", F.round("importance", 6))


_CONTEXT_SCORER = {"bias": -0.5, "context_weights": {"the": 1.0}}


def _context_samples(spark, folder):
    d = I.documents(spark, folder).join(I.table(spark, folder, "labels"), "doc_id", "left")
    return d.select(F.col("doc_id").alias("sample_id"), "quality", F.col("text").alias("context"))


_CTX = (
    "SELECT doc_id AS sample_id, CASE WHEN a > 0 THEN 'UP' ELSE 'DOWN' END AS without_context, "
    "CASE WHEN b > 0 THEN 'UP' ELSE 'DOWN' END AS with_context, (a > 0) <> (b > 0) AS context_impact FROM ("
    "SELECT doc_id, coalesce(quality, 0) - 0.5 AS a, coalesce(quality, 0) - 0.5 + CASE WHEN contains(upper(text), 'THE') THEN 1 ELSE 0 END AS b "
    "FROM documents LEFT JOIN labels USING (doc_id))"
)


@query("j07_context_contribution", _CTX)
def context_contribution(spark, folder):
    out = S.context_contribution(_context_samples(spark, folder), S.linear_scorer({"quality": 1.0}, **_CONTEXT_SCORER))
    return out.select(
        "sample_id", F.col("without_context.direction").alias("without_context"),
        F.col("with_context.direction").alias("with_context"), "context_impact",
    )


@query(
    "j08_explain",
    f"SELECT sample_id, with_context AS direction, CAST((coalesce(quality, 0) - 0.5 + hit > 0) <> (hit - 0.5 > 0) AS DOUBLE) AS quality_importance, "
    f"context_impact FROM ({_CTX}) JOIN (SELECT doc_id AS sample_id, quality, CASE WHEN contains(upper(text), 'THE') THEN 1 ELSE 0 END AS hit "
    "FROM documents LEFT JOIN labels USING (doc_id)) USING (sample_id)",
)
def explain(spark, folder):
    out = S.explain(
        _context_samples(spark, folder), ["quality"], S.linear_scorer({"quality": 1.0}, **_CONTEXT_SCORER), "context"
    )
    return out.select(
        "sample_id",
        F.col("prediction.direction").alias("direction"),
        F.col("feature_analysis")["quality"].alias("quality_importance"),
        F.col("context_analysis.context_impact").alias("context_impact"),
    )


@query(
    "j09_run_predictions",
    sql(f"SELECT symbol, date, {_DIRECTION} AS direction, importance FROM features JOIN (SELECT symbol, date, importance "
        f"FROM ({_IMPORTANCE}) WHERE feature = 'Close') USING (symbol, date)", "features"),
)
def run_predictions(spark, folder):
    out = S.run_predictions(_table(spark, folder), RULE_FEATURES, _rule(), key=["symbol", "date"])
    return out.select(
        "symbol", "date", F.col("prediction.direction").alias("direction"),
        F.col("explanation.feature_analysis")["Close"].alias("importance"),
    )


@query(
    "j10_evaluate_rule",
    sql(
        "SELECT round(avg(CAST(y = p AS INT)), 6) AS direction_accuracy, count(*) AS total_predictions, "
        "CAST(sum(p) AS BIGINT) AS up_predictions FROM (SELECT CAST(coalesce(lead(Close) "
        f"{_W} > Close, false) AS INT) AS y, CAST({_LOGIT} > 0 AS INT) AS p FROM features)",
        "features",
    ),
)
def evaluate_rule(spark, folder):
    samples = target_variables(_table(spark, folder), [1])
    out = S.evaluate(samples, RULE_FEATURES, _rule(), "price_direction_1d")
    return out.select(F.round("direction_accuracy", 6).alias("direction_accuracy"), "total_predictions", "up_predictions")


@query("j10_train_and_evaluate")
def train_and_evaluate(spark, folder):
    test, model = _trained(spark, folder)
    return S.evaluate(test, FEATURES, S.model_scorer(model, FEATURES), "price_direction_1d")


@query(
    "e06_inputs_with_predictions",
    sql(f"SELECT symbol AS input_symbol, date AS input_date, round(Close, 6) AS input_Close, round(SMA_20, 6) AS input_SMA_20, "
        f"{_DIRECTION} AS direction FROM features", "features"),
)
def inputs_with_predictions(spark, folder):
    out = S.predict(_table(spark, folder), RULE_FEATURES, _rule())
    return out.select(
        "input_symbol", "input_date", F.round("input_Close", 6).alias("input_Close"),
        F.round("input_SMA_20", 6).alias("input_SMA_20"), F.col("prediction.direction").alias("direction"),
    )
