"""Word-level token ids for prompts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PAD_ID, UNKNOWN_ID = 0, 1
FIRST_WORD_ID = 2
MAX_LENGTH = 512
# A vocabulary has a fixed size, chosen by whoever builds it; this is the most that is sent to every executor.
MOST_WORDS = 1_000_000
#: Different words that a task counts before it hands their counts on.
COUNTED_WORDS = 100_000


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's words, handed on whenever they are ``COUNTED_WORDS`` different ones. Bytes split at ASCII white space only."""
    seen: Counter[bytes] = Counter()

    def counted() -> pa.RecordBatch:
        words = pa.array(seen.keys(), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(seen.values(), pa.int64())], names=["token", "n"])

    for b in batches:
        for t in b.column(0).cast(pa.binary()):
            seen.update((t.as_py() or b"").split())
            if len(seen) >= COUNTED_WORDS:
                yield counted()
                seen.clear()
    yield counted()


def vocabulary(df: DataFrame, text: str, size: int) -> DataFrame:
    """``(token, token_id)`` of the ``size`` most frequent words, ties in word order."""
    counts = df.select(F.col(text).alias("text")).mapInArrow(_count_words, "token string, n bigint")
    counts = counts.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(size)
    place = F.row_number().over(Window.orderBy(F.desc("n"), "token"))
    return counts.select("token", (place + FIRST_WORD_ID - 1).cast("int").alias("token_id"))


def tokenize(df: DataFrame, key: str, text: str, vocab: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """Add ``input_ids`` and ``attention_mask``, truncated and padded to ``max_length``.

    The vocabulary goes to every executor as a dictionary, so no text and no token is shuffled. One of more than
    ``MOST_WORDS`` words is refused. ``key`` is not needed for that; it stays for callers that name it.
    """
    words = vocab.limit(MOST_WORDS + 1).toPandas()
    if len(words) > MOST_WORDS:
        raise ValueError(f"a vocabulary has at most {MOST_WORDS} words")
    ids = {w.encode(): i for w, i in zip(words["token"], words["token_id"].tolist(), strict=True)}
    shared = df.sparkSession.sparkContext.broadcast(ids)

    @F.arrow_udf("array<int>")
    def ids_of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found = shared.value.get
        for batch in texts:
            # Bytes split at ASCII white space only.
            split = [(t or b"").split()[:max_length] for t in batch.cast(pa.binary()).to_pylist()]
            yield pa.array([[found(w, UNKNOWN_ID) for w in s] for s in split], pa.list_(pa.int32()))

    found = F.col("_ids")
    pads = F.lit(max_length) - F.size(found)
    return (
        df.withColumn("_ids", ids_of(text))
        .withColumn("input_ids", F.concat(found, F.array_repeat(F.lit(PAD_ID), pads)))
        .withColumn("attention_mask", F.concat(F.array_repeat(F.lit(1), F.size(found)), F.array_repeat(F.lit(0), pads)))
        .drop("_ids")
    )
