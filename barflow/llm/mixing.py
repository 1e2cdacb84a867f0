"""Mixing sources to target weights by systematic sampling.

Within a source the documents stand in order of size and id. Each one is expected target / size copies; the running sum
of expected copies, shifted by one random offset of the source, crosses an integer boundary once for each copy to emit.
The running sum needs no ordered pass over a source: counts by size and by blocks of ids give each row its place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barflow.llm.common import WORD_PATTERN, column, free_name, only, put, whole
from barflow.session import materialize

#: Documents of one source, size and run of so many ids are ordered in one task.
ID_BLOCK = 1024
_OUT = ("size", "source_size", "target", "taken")


def words(text: Column) -> Column:
    """Number of words in a text, a null one as empty."""
    return F.regexp_count(whole(text), F.lit(WORD_PATTERN)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Targets of the sources (``source``, ``source_size``): ``share`` of all sizes, dealt by weight.

    Sources in order of code points, null last, take the weights in turn. No target exceeds ``most`` times its source's
    size; what is cut off is dealt again among the others. One level serves all that stay below their limit: weight
    times the level at which limits and levels add up to the whole. In order of the level that fills them, the first source
    that the rest does not fill gives that level; for later ones it only falls.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    cap = F.col("source_size") * F.lit(float(most))
    by_level = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    all_of = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
        .withColumn("cap", cap)
        .withColumn("full_at", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(all_of) * F.lit(float(share)))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(all_of) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("capped")) / F.col("open"))
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(all_of))
    )
    dealt = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("level")))
    return levels.select("source", "source_size", dealt.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Add to each document how many of its words the mix takes.

    Adds ``size`` (words of the text; null text: 0), ``source_size``, ``target`` (both of its source) and ``taken``
    (size times the number of copies); columns of these names are replaced, all others stay. The null source is one
    source, another than the empty name; a source without words takes none. Rows of equal source, size and id are
    ordered by a digest of their text; rows that repeat all of it are interchangeable. ``seed`` fixes the offsets, so reruns
    agree. No rows give no rows.
    """
    own = {n: free_name(docs, f"mx_{n}") for n in ("size", "block", "key")}
    rows = docs.select(
        "*",
        words(column(docs, text)).alias(own["size"]),
        F.floor(column(docs, id) / F.lit(ID_BLOCK)).cast("bigint").alias(own["block"]),
        F.xxhash64(whole(column(docs, text))).alias(own["key"]),
    )
    counts = materialize(
        only(rows, source, own["size"], own["block"])
        .toDF("source", "size", "block")
        .groupBy("source", "size", "block")
        .agg(F.count("*").alias("n"))
    )
    by_size = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sized = by_size.withColumn(
        "before_size",
        F.coalesce(
            F.sum("n").over(Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).select("source", "size", "before_size")
    sources = targets(
        by_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, share, most
    )
    in_size = Window.partitionBy("source", "size").orderBy(F.col("block").asc_nulls_first())
    blocks = counts.withColumn(
        "before_block", F.coalesce(F.sum("n").over(in_size.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    places = (
        blocks.alias("b")
        .join(sized.alias("s"), F.expr("b.source <=> s.source AND b.size = s.size"))
        .join(sources.alias("t"), F.expr("b.source <=> t.source"))
        .selectExpr("b.source", "b.size", "b.block", "before_size + before_block AS before", "source_size", "target")
    )

    r = rows.alias("r")
    at = lambda name: F.col(f"r.`{name}`")
    joined = r.join(
        places.alias("p"),
        at(source).eqNullSafe(F.col("p.source"))
        & (at(own["size"]) == F.col("p.size"))
        & at(own["block"]).eqNullSafe(F.col("p.block")),
    )
    in_block = Window.partitionBy(at(source), at(own["size"]), at(own["block"])).orderBy(
        at(id).asc_nulls_first(), at(own["key"])
    )
    place = F.col("p.before") + F.row_number().over(in_block)
    rate = F.when(F.col("p.source_size") > 0, F.col("p.target") / F.col("p.source_size")).otherwise(F.lit(0.0))
    named = F.concat(F.lit(seed + "/"), F.coalesce(F.concat(F.lit("="), at(source)), F.lit("null")))
    offset = F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    crossed = F.floor(offset + place * rate) - F.floor(offset + (place - 1) * rate)
    out = joined.select(
        *[at(c) for c in docs.columns if c.lower() not in _OUT],
        at(own["size"]).alias("size"),
        F.col("p.source_size").alias("source_size"),
        F.col("p.target").alias("target"),
        (crossed * at(own["size"])).cast("bigint").alias("taken"),
    )
    return out


def repeat_taken(mixed: DataFrame) -> DataFrame:
    """Each row as often as the mix takes it. Rows without words, null texts among them, add nothing to any share and stay once."""
    copies = F.expr("CAST(if(size = 0, 1, taken DIV size) AS INT)")
    return put(mixed.filter("size = 0 OR taken > 0"), mx_copy=F.explode(F.sequence(F.lit(1), copies))).drop("mx_copy")
