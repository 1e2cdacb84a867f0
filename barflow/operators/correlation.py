"""Pearson correlation of many column pairs in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _name(names: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.col("pair").cast("int") + 1)


def pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(pair, a, b, n, corr)`` over the rows where both columns are present.

    One pass and one aggregation by pair, however many there are: within a task a row stands once for each pair, and the few sums of a
    pair are all that is shuffled. A constant column has no correlation (null).
    """
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    at = F.array(*[F.struct(F.lit(i).alias("pair"), F.lit(names.index(a)).alias("a"), F.lit(names.index(b)).alias("b")) for i, (a, b) in enumerate(pairs)])
    frame = df.sparkSession.range(len(pairs)).select(F.col("id").cast("int").alias("pair"))
    corr = F.lit(None).cast("double")
    if pairs:
        rows = df.select(F.array(*[F.col(c).cast("double") for c in names]).alias("v"), F.explode(at).alias("p"))
        rows = rows.select("p.pair", F.col("v")[F.col("p.a")].alias("x"), F.col("v")[F.col("p.b")].alias("y"))
        sums = rows.where("x IS NOT NULL AND y IS NOT NULL").groupBy("pair").agg(
            F.count(F.lit(1)).alias("n"), F.covar_pop("x", "y").alias("xy"), F.var_pop("x").alias("xx"), F.var_pop("y").alias("yy")
        )
        frame = frame.join(F.broadcast(sums), "pair", "left")
        corr = F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy")))
    else:
        frame = frame.withColumn("n", F.lit(0).cast("bigint"))
    named = [_name([a for a, _ in pairs] or [""]).alias("a"), _name([b for _, b in pairs] or [""]).alias("b")]
    return frame.select("pair", *named, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), corr.alias("corr"))
