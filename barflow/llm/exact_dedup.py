"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by SHA-256 digest. A batch of documents is reduced to its digests, those that
the index already holds are removed by a sort-merge anti-join that does not move the index, and the rest is appended.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barflow.llm.common import column, free_name, only, put, whole
from barflow.session import materialize, shared_dir

#: A group of copies is cut into this many parts, by a hash of the document id, before anything is joined by digest.
PARTS = 64


class DigestIndex:
    """Digests seen so far: ``digest binary, keep_id bigint, batch string``, bucketed and sorted by digest.

    ``path`` is a folder that all executors reach. An index that another session wrote is opened again by giving the
    same name, path and number of buckets.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = 64):
        if not re.fullmatch(r"\w+", name):
            raise ValueError(f"not a plain table name: {name}")
        self.spark, self.name, self.path, self.buckets = spark, name, path.rstrip("/"), buckets
        if not spark.catalog.tableExists(name):
            spark.sql(
                f"CREATE TABLE {name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
                f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'"
            )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, groups: DataFrame, batch: str) -> None:
        """Append the groups (digest, keep_id) that the index lacks. Repeating a batch changes nothing."""
        groups.join(self.table().select("digest").hint("merge"), "digest", "left_anti").select(
            "digest", F.col("keep_id").cast("bigint"), F.lit(batch).alias("batch")
        ).repartition(self.buckets, "digest").write.mode("append").format("parquet").bucketBy(
            self.buckets, "digest"
        ).sortBy("digest").option("path", self.path).saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)


def scratch_index(spark: SparkSession, buckets: int = 64) -> DigestIndex:
    """A new empty index in the shared folder."""
    name = f"digests_{uuid.uuid4().hex}"
    return DigestIndex(spark, name, f"{shared_dir(spark)}/{name}", buckets)


def exact_dedup(docs: DataFrame, index: DigestIndex, batch: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Mark one row of each distinct text that the index lacked, and append those texts to the index.

    Adds ``keep_id`` (id of the row that stays: of the batch's equal texts the largest, or the row of an earlier batch),
    ``group_size`` (rows of this batch with the text), ``kept`` and ``text_sha256``; columns of these names are replaced,
    all others stay. Texts are compared as they are; a null text is an empty one. Of rows that repeat id and text, one
    is kept. A null id is the smallest; a group of null ids keeps one row and has a null ``keep_id``. A batch that is
    applied again under its name gets the same result. An empty batch gives no rows.
    """
    spark = docs.sparkSession
    digest, part, rank = (free_name(docs, n) for n in ("xd_digest", "xd_part", "xd_rank"))
    keyed = docs.select(
        "*",
        F.unhex(F.sha2(whole(column(docs, text)).cast("binary"), 256)).alias(digest),
        F.pmod(F.xxhash64(column(docs, id)), F.lit(PARTS)).cast("int").alias(part),
    )
    narrow = only(keyed, id, digest, part).toDF("id", "digest", "part")
    parts = materialize(narrow.groupBy("digest", "part").agg(F.max("id").alias("top"), F.count("*").alias("n")))
    groups = parts.groupBy("digest").agg(F.max("top").alias("keep_id"), F.sum("n").alias("group_size"))
    index.append(groups, batch)

    held = index.table().select("digest", F.col("keep_id").alias("held_id"), "batch")
    decided = groups.select("digest", "group_size").join(held.hint("merge"), "digest")
    decided = parts.select("digest", "part").join(decided, "digest")
    decided = decided.select(
        F.col("digest").alias(digest), F.col("part").alias(part), "held_id", "group_size", "batch"
    ).alias("d")

    rows = keyed.alias("k").join(decided, [digest, part])
    order = Window.partitionBy(digest, part).orderBy(F.col(f"k.`{id}`").desc_nulls_last())
    found = rows.select(
        *[F.col(f"k.`{c}`") for c in docs.columns],
        F.col("d.held_id").alias(free_name(docs, "xd_held")),
        F.col("d.group_size").alias(free_name(docs, "xd_size")),
        (F.col("d.batch") == batch).alias(free_name(docs, "xd_new")),
        F.row_number().over(order).alias(rank),
        F.col(digest),
    )
    held_id, size, new = (F.col(free_name(docs, n)) for n in ("xd_held", "xd_size", "xd_new"))
    out = put(
        found,
        keep_id=held_id,
        group_size=size,
        kept=new & (F.col(rank) == 1) & F.col(f"`{id}`").eqNullSafe(held_id),
        text_sha256=F.lower(F.hex(F.col(digest))),
    )
    names = [c for c in docs.columns if c.lower() not in ("keep_id", "group_size", "kept", "text_sha256")]
    return only(out, *names, "keep_id", "group_size", "kept", "text_sha256")
