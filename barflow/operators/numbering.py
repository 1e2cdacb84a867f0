"""Gapless row numbers in a given order, without gathering the rows.

Rows are dealt to blocks by ranges of the order and stored with their block, as the ranges come from a sample. A block's first
number is the rows in the blocks before it, a table of one row per block; inside a block rows are numbered by their order.
A task that is run again reads the stored block, so it gives the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.session import materialize


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str = "row", start: int = 0) -> DataFrame:
    """Add ``name``: ``start`` and up in ascending ``order`` (nulls first). Rows that tie in all of it stand in any order.

    Rows that tie are dealt apart too, so no block holds more than its share.
    """
    keys = {f"_o{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order)}
    dealt = df.withColumns({**keys, "_tie": F.monotonically_increasing_id()}).repartitionByRange(*keys, "_tie")
    dealt = materialize(dealt.withColumn("_block", F.spark_partition_id()))
    counts = dealt.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    starts = counts.select("_block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + start).alias("_start"))
    inside = Window.partitionBy("_block").orderBy(*keys, "_tie")
    placed = dealt.withColumn("_at", F.row_number().over(inside) - 1).join(F.broadcast(starts), "_block")
    return placed.withColumn(name, F.col("_start") + F.col("_at")).select(*df.columns, name)
