"""Token counts, rolled up by source, language and tokenizer version and maintained by deltas.

A batch carries signed rows: +1 document and its tokens for an insert, the negative of both for a delete, both for a
revised count. Totals are additive, so a commit adds the batch's sums to the last totals, writes a new version of them, and then
adds one row, the batch's name and that version, to a table of batches, which is what makes it count. A batch that is
committed again changes nothing.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from barflow.llm.common import column, only, put
from barflow.sources.store import path_exists

KEYS = ("source", "lang", "tokenizer")
MEASURES = ("documents", "tokens")


def tokenizer_version(path: str) -> str:
    """File name and start of its digest: another vocabulary under the same name is another version."""
    with open(path, "rb") as f:
        return f"{os.path.basename(path)}@{hashlib.sha256(f.read()).hexdigest()[:12]}"


def _encoder(held: dict):
    """The encoder of a file of ranks; a Python worker keeps the broadcast dictionary, and the encoder in it, for all its tasks."""
    if "encode" not in held:
        import tiktoken

        merges = {base64.b64decode(t): int(r) for t, r in map(bytes.split, held["file"].splitlines())}
        held["encode"] = tiktoken.Encoding("counted", pat_str=held["pattern"], mergeable_ranks=merges, special_tokens={}).encode_ordinary
    return held["encode"]


def count_tokens(docs: DataFrame, ranks: str, pattern: str, text: str = "text", out: str = "tokens") -> DataFrame:
    """Replace the text by its number of tokens, special ones not recognised. A null or empty text has 0.

    ``ranks`` is a file of base64 tokens and ranks on the driver; it is sent to the executors. A column called like
    ``out`` is replaced, all others stay. Equal rows count each for itself; no rows give none. A text is encoded whole, however long.
    """
    with open(ranks, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast({"file": f.read(), "pattern": pattern})
    keep = [c for c in docs.columns if c.lower() not in (text.lower(), out.lower())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared.value)
        for b in batches:
            n = np.fromiter((len(encode(t.as_py() or "")) for t in b.columns[-1]), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n)], names=[*keep, out])

    schema = StructType([*[docs.schema[c] for c in keep], StructField(out, LongType())])
    return docs.select(*[column(docs, c) for c in keep], column(docs, text)).mapInArrow(run, schema)


def signed(counted: DataFrame, sign: int) -> DataFrame:
    """Counted documents (``source``, ``lang``, ``tokenizer``, ``tokens``) as rows of a batch: +1 inserts, -1 deletes."""
    rows = only(counted, *KEYS, "tokens")
    return rows.select(*KEYS, F.lit(sign).cast("bigint").alias("documents"), (F.col("tokens") * sign).alias("tokens"))


def revised(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of a batch that takes back the counts of documents and puts in their new ones, keys included."""
    return signed(before, -1).unionByName(signed(after, 1))


class Rollup:
    """Totals by the keys in a folder that all executors reach. One writer at a time; readers see whole versions only."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _held(self) -> DataFrame:
        """A row (``version, batch``) for every batch held."""
        kind = "version bigint, batch string"
        if not path_exists(self.spark, f"{self.path}/batches"):
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(f"{self.path}/batches")

    def _version(self) -> int:
        """The last version that counts; 0 before the first batch."""
        return self._held().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def batches(self) -> DataFrame:
        """Names of the batches held, a row each."""
        return self._held().select("batch")

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """Add a batch of signed rows. False, and nothing done, if a batch of that name is held.

        Null keys are groups of their own; null measures count 0. An empty batch is held like any other. Totals that a failed
        commit left behind are overwritten.
        """
        if not self._held().filter(F.col("batch") == batch).isEmpty():
            return False
        last = self._version()
        sums = only(rows, *KEYS, *MEASURES)
        if last:
            sums = sums.unionByName(self.spark.read.parquet(f"{self.path}/totals/{last}"))
        sums = sums.groupBy(*KEYS).agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in MEASURES])
        sums.write.mode("overwrite").parquet(f"{self.path}/totals/{last + 1}")
        held = self.spark.createDataFrame([(last + 1, batch)], "version bigint, batch string")
        held.coalesce(1).write.mode("append").parquet(f"{self.path}/batches")
        return True

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, documents, tokens``, without groups whose sums are all 0."""
        last = self._version()
        if not last:
            kinds = ", ".join([*[f"{k} string" for k in KEYS], *[f"{m} bigint" for m in MEASURES]])
            return self.spark.createDataFrame([], kinds)
        return self.spark.read.parquet(f"{self.path}/totals/{last}").filter(" OR ".join(f"{m} <> 0" for m in MEASURES))


def with_version(docs: DataFrame, version: str) -> DataFrame:
    """Name the tokenizer that counted the documents."""
    return put(docs, tokenizer=F.lit(version))
