"""From raw documents to token ids: toxicity, exact dedup, near-dedup, mixing, encoding.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. All but the last return the columns of ``documents``; each
is written as Parquet and read again as the next one's documents. Extra columns of the documents are kept, whatever their
names, up to the last stage, which returns ids and digests only.

Null texts count as empty; no stage drops a document for being empty. An empty table gives an empty one. Texts are read
whole, however long.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.llm.byte_bpe import Vocabulary, encode
from barflow.llm.common import column, only
from barflow.llm.exact_dedup import exact_dedup, scratch_index
from barflow.llm.minhash import near_duplicates
from barflow.llm.mixing import mix_sources, repeat_taken
from barflow.llm.toxicity import grade, train
from barflow.session import materialize

#: The last stage is bytes and ids and the first a fitted model: SQL cannot express them.
ORACLE_SQL = None


def _same_columns(stage):
    """Give a stage the columns it reads and the others under names that clash with nothing; undo that in its result."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: c if c in ("doc_id", "text", "source") else f"kept_{i}" for i, c in enumerate(docs.columns)}
        found = stage(spark, docs.select(*[column(docs, c).alias(n) for c, n in names.items()]), sf_dir)
        return found.select(*[column(found, n).alias(c) for c, n in names.items()])

    return run


@_same_columns
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on the labelled ones, puts at grade 0. Empty texts are at grade 0, equal texts at the same;
    without labels of both kinds nothing is dropped."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return grade(docs, model, keep_text=True).filter("NOT toxic")


@_same_columns
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text, the one with the largest id; of null and empty texts one in all, of rows that tie in id one."""
    return exact_dedup(docs, scratch_index(spark), batch="documents").filter("kept")


@_same_columns
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingle sets of similarity 0.8 or more, the one with the smallest id. Texts without words are
    linked with nothing and stay, and so do rows without an id. Rows that share an id stay or go together."""
    kept = near_duplicates(docs, percent=80).filter("kept").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").unionByName(docs.filter("doc_id IS NULL"))


@_same_columns
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, at most twice; those without words, which add nothing to any share, once."""
    return repeat_taken(mix_sources(docs))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number, and digests of the ids and of the text they decode to. An empty text has no ids."""
    vocabulary = Vocabulary.from_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    both = encode(only(docs, "doc_id", "source", "text"), vocabulary, decoded="decoded")
    return both.select(
        "doc_id",
        "source",
        "ids",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("byte_bpe", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
