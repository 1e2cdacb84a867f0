"""Samples with prompts, labels, contexts and token ids, for all parts of a split at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.functions.prompts import feature_text, target_label, training_prompt
from barflow.operators.retrieval import TOP_K, retrieve_contexts
from barflow.operators.tokens import MAX_LENGTH, tokenize

TARGET = "price_direction_1d"


def prepare_datasets(
    samples: DataFrame,
    target: str = TARGET,
    features: Sequence[str] | None = None,
    docs: DataFrame | None = None,
    include_context: bool = True,
    context_length: int = TOP_K,
    vocab: DataFrame | None = None,
    max_length: int = MAX_LENGTH,
    key: str = "sample_id",
) -> DataFrame:
    """Add ``prompt`` and ``label``; with ``docs`` also ``context``, with ``vocab`` ``input_ids`` and ``attention_mask``.

    ``features`` (default: all columns) are the ones a prompt may show. With documents, ``context_length`` of them are
    retrieved for every sample by its ``key`` and go into the prompt. One pass over all samples, whatever their ``split``.
    """
    rows, context = samples, None
    if docs is not None and include_context:
        rows = retrieve_contexts(samples, docs, context_length, key=key)
        context = F.col("context")
    shown = feature_text(samples.columns if features is None else list(features))
    label = target_label(target, samples.schema[target].dataType)
    rows = rows.withColumns({"prompt": training_prompt(shown, context), "label": label})
    return rows if vocab is None else tokenize(rows, key, "prompt", vocab, max_length)
