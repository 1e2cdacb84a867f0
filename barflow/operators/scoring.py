"""Training, scoring and explaining direction predictions.

A scorer is any ``DataFrame -> DataFrame`` function that adds ``response`` (text) and ``scores``
(array of two class scores, down and up). It sees the feature columns and, if given, ``context``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.functions.prompts import inference_prompt, parse_direction, parse_prediction
from barflow.operators.metrics import direction_accuracy, masked_accuracy, softmax_max

Scorer = Callable[[DataFrame], DataFrame]
CONTEXT = "context"
ID_FEATURES = ("symbol", "date")


def train_direction(df: DataFrame, features: Sequence[str], label: str, iterations: int = 50) -> PipelineModel:
    """Two-class direction model on the feature columns; missing values take the column mean."""
    filled = [f"_in_{c}" for c in features]
    stages = [
        Imputer(inputCols=list(features), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol="_label", maxIter=iterations),
    ]
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias("_label"))
    return Pipeline(stages=stages).fit(typed.where(F.col("_label").isNotNull()))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _answer(up: Column) -> Column:
    return F.when(up, "Direction: UP").otherwise("Direction: DOWN")


def model_scorer(model: PipelineModel, features: Sequence[str]) -> Scorer:
    added = ["_features", "rawPrediction", "probability", "prediction", *[f"_in_{c}" for c in features]]

    def score(df: DataFrame) -> DataFrame:
        typed = df.withColumns({c: F.col(c).cast("double") for c in features})
        out = model.transform(typed).withColumn("scores", vector_to_array("rawPrediction"))
        return out.withColumn("response", _answer(F.col("prediction") == 1)).drop(*added)

    return score


def linear_scorer(weights: Mapping[str, float], bias: float = 0.0, context_weights: Mapping[str, float] | None = None) -> Scorer:
    """Deterministic scorer: weighted sum of features, plus a weight per word found in the context."""

    def score(df: DataFrame) -> DataFrame:
        logit = F.lit(float(bias))
        for name, w in weights.items():
            logit = logit + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * w
        if context_weights and CONTEXT in df.columns:
            text = F.upper(F.coalesce(F.col(CONTEXT), F.lit("")))
            for word, w in context_weights.items():
                logit = logit + F.when(F.contains(text, F.lit(word.upper())), float(w)).otherwise(0.0)
        scored = df.withColumn("scores", F.array(F.lit(0.0), logit))
        return scored.withColumn("response", _answer(F.col("scores")[1] > 0))

    return score


def prompt_scorer(features: Sequence[str], answer: Callable[[list[str]], list[str]]) -> Scorer:
    """Plug in any text model: ``answer`` gets a batch of prompts and returns one response each."""

    @F.pandas_udf("string")
    def respond(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(answer(part.tolist()))

    def score(df: DataFrame) -> DataFrame:
        context = F.col(CONTEXT) if CONTEXT in df.columns else None
        prompt = inference_prompt(df.schema, features, context)
        return df.withColumn("response", respond(prompt)).withColumn("scores", F.lit(None).cast("array<double>"))

    return score


def predict(
    df: DataFrame,
    features: Sequence[str],
    scorer: Scorer,
    context: str | None = None,
    keep: Sequence[str] = (),
    now: Column | None = None,
) -> DataFrame:
    """Prediction records: parsed prediction, response, prompt, confidence, time, ``input_<feature>``."""
    source = df if context in (None, CONTEXT) else df.withColumn(CONTEXT, F.col(context))
    if context is None and CONTEXT in source.columns:
        source = source.drop(CONTEXT)
    text = inference_prompt(source.schema, features, F.col(CONTEXT) if context else None)
    scored = scorer(source.withColumn("input_text", text))
    return scored.select(
        *keep,
        parse_prediction("response").alias("prediction"),
        "response",
        "input_text",
        softmax_max("scores").alias("confidence"),
        (F.current_timestamp() if now is None else now).alias("timestamp"),
        *[F.col(c).alias(f"input_{c}") for c in features],
    )


def feature_importance(
    df: DataFrame, features: Sequence[str], scorer: Scorer, key: Sequence[str] = ("sample_id",)
) -> DataFrame:
    """``(key, feature, importance)``: 1.0 where setting the feature to 0 flips the direction.

    The base direction travels with its row into the variants, so nothing is shuffled.
    """
    names = [c for c in features if c not in ID_FEATURES]
    base = scorer(df).withColumn("_base", parse_direction("response")).drop("scores", "response")
    variants = base.withColumn("feature", F.explode(F.array(*[F.lit(c) for c in names])))
    zeroed = {c: F.when(F.col("feature") == c, 0.0).otherwise(F.col(c).cast("double")) for c in names}
    scored = scorer(variants.withColumns(zeroed))
    flipped = (parse_direction("response") != F.col("_base")).cast("double")
    return scored.select(*key, "feature", flipped.alias("importance"))


def global_importance(importance: DataFrame) -> DataFrame:
    return importance.groupBy("feature").agg(F.avg("importance").alias("importance"))


def context_contribution(
    df: DataFrame, scorer: Scorer, context: str = CONTEXT, key: Sequence[str] = ("sample_id",)
) -> DataFrame:
    """Predictions without and with the context, and whether the direction differs."""
    kept = df.withColumn("_context", F.col(context)).drop(context)
    plain = scorer(kept).withColumn("without_context", parse_prediction("response")).drop("response", "scores")
    both = scorer(plain.withColumn(CONTEXT, F.col("_context"))).withColumn("with_context", parse_prediction("response"))
    changed = F.col("without_context.direction") != F.col("with_context.direction")
    return both.select(*key, "without_context", "with_context", changed.alias("context_impact"))


def _records(
    df: DataFrame, features: Sequence[str], scorer: Scorer, context: str | None, key: Sequence[str], explanations: bool
) -> DataFrame:
    """One scored table: the record of every row and, with ``explanations``, what setting each feature to 0, or leaving the context
    out, changes. All scorings follow one another on the same rows, so nothing is joined or shuffled."""
    source = df if context in (None, CONTEXT) else df.withColumn(CONTEXT, F.col(context))
    if context is None and CONTEXT in source.columns:
        source = source.drop(CONTEXT)
    text = inference_prompt(source.schema, features, F.col(CONTEXT) if context else None)
    inputs = {f"_i_{c}": F.col(c) for c in features}
    rows = scorer(source.withColumns({f"_k_{c}": F.col(c) for c in key} | inputs | {"input_text": text}))
    rows = rows.withColumns(
        {"_prediction": parse_prediction("response"), "_response": F.col("response"), "_confidence": softmax_max("scores")}
    ).drop("response", "scores")
    kept = [*[F.col(f"_k_{c}").alias(c) for c in key], F.col("_prediction").alias("prediction"), F.col("_response").alias("response"),
            "input_text", F.col("_confidence").alias("confidence"), F.current_timestamp().alias("timestamp"),
            *[F.col(f"_i_{c}").alias(f"input_{c}") for c in features]]
    if not explanations:
        return rows.select(*kept)
    names = sorted(c for c in features if c not in ID_FEATURES)
    base = F.col("_prediction")["direction"]
    for c in names:
        rows = scorer(rows.withColumn(c, F.lit(0.0)))
        rows = rows.withColumns({f"_f_{c}": (parse_direction("response") != base).cast("double"), c: F.col(f"_i_{c}")}).drop("response", "scores")
    importance = F.map_from_arrays(
        F.array(*[F.lit(c) for c in names]).cast("array<string>"), F.array(*[F.col(f"_f_{c}") for c in names]).cast("array<double>")
    )
    parts = [F.col("_prediction").alias("prediction"), F.col("_response").alias("base_explanation"), importance.alias("feature_analysis")]
    if context is not None:
        rows = rows.withColumn("_context", F.col(CONTEXT))
        rows = scorer(rows.drop(CONTEXT)).withColumn("_without", parse_prediction("response")).drop("response", "scores")
        effect = F.struct(
            F.col("_without").alias("without_context"), F.col("_prediction").alias("with_context"),
            (F.col("_without")["direction"] != base).alias("context_impact"),
        )
        parts.append(F.when(F.coalesce("_context", F.lit("")) != "", effect).alias("context_analysis"))
    return rows.select(*kept, F.struct(*parts).alias("explanation"))


def explain(
    df: DataFrame,
    features: Sequence[str],
    scorer: Scorer,
    context: str | None = None,
    key: Sequence[str] = ("sample_id",),
) -> DataFrame:
    """Per sample: prediction, response, importance map and, where a context is given, its effect."""
    return _records(df, features, scorer, context, key, True).select(*key, "explanation.*")


def run_predictions(
    df: DataFrame,
    features: Sequence[str],
    scorer: Scorer,
    context: str | None = None,
    explanations: bool = True,
    key: Sequence[str] = ("sample_id",),
) -> DataFrame:
    """Prediction records for a whole table, with explanations on request."""
    return _records(df, features, scorer, context, key, explanations)


def evaluate(df: DataFrame, features: Sequence[str], scorer: Scorer, label: str) -> DataFrame:
    """Score a table, read the directions (UP is 1, anything else 0) and measure them."""
    scored = predict(df, features, scorer, keep=[label])
    up = (F.col("prediction.direction") == "UP").cast("int")
    return direction_accuracy(scored.select(F.col(label).alias("y_true"), up.alias("y_pred")))


def evaluate_scores(df: DataFrame, scorer: Scorer, label: str) -> DataFrame:
    """Masked accuracy of the class scores."""
    return masked_accuracy(scorer(df).select("scores", F.col(label).alias("label")))
