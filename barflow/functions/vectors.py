"""Text to vectors, and vector arithmetic on array columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_DIM = 384
#: Texts counted in one vector step.
ROWS_AT_ONCE = 1024
WORD = r"([\p{L}\p{N}]+)"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def words(text: str | Column) -> Column:
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(WORD), F.lit(1))


def word_buckets(text: str | Column, dim: int = DEFAULT_DIM) -> Column:
    """Hash bucket of every word of the text (repeats kept)."""
    return F.transform(
        words(text), lambda w: (F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint") % dim).cast("int")
    )


def hash_embedding(
    text: str | Column, dim: int = DEFAULT_DIM, weights: Sequence[float] | None = None, kind: str = "float"
) -> Column:
    """L2-normalised word-count vector over hash buckets, an array of ``kind`` (``float`` or ``double``); zero without words.

    ``weights``, one per bucket, multiply the counts first, such as the ``idf`` of ``fit_idf``.
    """
    return embed_buckets(word_buckets(text, dim), dim, weights, kind)


def embed_buckets(
    buckets: str | Column, dim: int = DEFAULT_DIM, weights: Sequence[float] | None = None, kind: str = "float"
) -> Column:
    """``hash_embedding`` of the buckets of a text's words, where a query needs these as well."""
    scale = np.ones(dim) if weights is None else np.asarray(weights, dtype=np.float64)
    if len(scale) != dim:
        raise ValueError(f"{len(scale)} weights for {dim} buckets")

    number, kind = {"float": (np.float32, T.FloatType()), "double": (np.float64, T.DoubleType())}[kind]

    @F.arrow_udf(T.ArrayType(kind))
    def count_buckets(part: pa.Array) -> pa.Array:
        found = np.empty((len(part), dim), number)
        for lo in range(0, len(part), ROWS_AT_ONCE):
            some = part.slice(lo, ROWS_AT_ONCE)
            rows = np.repeat(np.arange(len(some)), some.value_lengths().to_numpy(zero_copy_only=False))
            flat = some.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            counts = np.bincount(rows * dim + flat, minlength=len(some) * dim).reshape(len(some), dim) * scale
            norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
            found[lo : lo + len(some)] = counts / np.where(norms == 0, 1.0, norms)
        return pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32) * dim, pa.array(found.ravel()))

    return count_buckets(F.coalesce(_c(buckets), F.array().cast("array<int>")))


def fit_idf(docs: DataFrame, text: str = "text", dim: int = DEFAULT_DIM) -> DataFrame:
    """``bucket, texts, idf`` of all ``dim`` buckets: in how many texts a bucket occurs, and ln((n + 1) / (texts + 1)).

    ``n`` counts all texts, null and empty ones too. One pass: a text gives each of its buckets once, counted before the shuffle.
    """
    distinct = docs.select(F.explode_outer(F.array_distinct(word_buckets(text, dim))).alias("bucket"))
    texts = distinct.where(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.count(F.lit(1)).alias("texts"))
    frame = docs.sparkSession.range(dim).select(F.col("id").cast("int").alias("bucket"))
    total = docs.agg(F.count(F.lit(1)))
    found = frame.join(texts, "bucket", "left").withColumn("texts", F.coalesce("texts", F.lit(0)))
    return found.withColumn("idf", F.log((total.scalar() + 1) / (F.col("texts") + 1)))


def idf_weights(idf: DataFrame) -> list[float]:
    """The weights in order of the buckets; as many numbers as a vector has, read by the driver."""
    return [r["idf"] for r in idf.select("bucket", "idf").orderBy("bucket").collect()]


def custom_embedding(text: str | Column, encode: Callable[[list[str]], np.ndarray]) -> Column:
    """Plug in any encoder: ``encode`` gets a batch of texts and returns one vector per text."""

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(list(np.asarray(encode(part.fillna("").tolist()), dtype=np.float32)))

    return run(_c(text))


def dot(a: str | Column, b: str | Column) -> Column:
    products = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def l2_norm(v: str | Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: str | Column) -> Column:
    """v / |v| as ``array<float>``; a zero vector stays as it is."""
    norm = l2_norm(v)
    return F.transform(_c(v), lambda x: F.when(norm == 0, x).otherwise(F.try_divide(x.cast("double"), norm)).cast("float"))
