"""Exact linear-interpolated quantiles by radix selection for groups of any size, by sorting for groups that a task can hold.

A double is mapped to a 64-bit integer of the same order. A histogram over the integers' first digits, per group and column,
tells in which digit each wanted rank lies; only the values there are looked at again, by their next digits, until the
whole integer is known. Histograms are counted before they are shuffled, and no group is gathered: what is kept of it
gets smaller with every digit.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.operators.groups import BROADCAST_GROUPS
from barflow.operators.series import BLOCK_ROWS, dealt, key_text
from barflow.session import materialize

#: Bits below the digits looked at so far, level by level: digits of 16, 24 and 24 bits.
SHIFTS = (48, 24, 0)
LARGEST = (1 << 63) - 1
#: Rows of a group that one task sorts at most, as many as a block of a series has.
SORTED_GROUP_ROWS = BLOCK_ROWS
_GROUP = "_run"


def _name(column: str, prob: float) -> str:
    return f"{column}_p{prob * 100:g}".replace(".", "_")


def quantile_names(column: str, probs: Sequence[float]) -> list[str]:
    return [_name(column, p) for p in probs]


@F.arrow_udf(T.LongType())
def _sortable(x: pa.Array) -> pa.Array:
    values = x.fill_null(0.0).to_numpy()
    bits = values.view(np.int64)
    magnitude = bits & LARGEST
    keys = np.where(np.isnan(values), LARGEST, np.where(bits < 0, -magnitude, magnitude))
    return pa.array(keys, mask=x.is_null().to_numpy(zero_copy_only=False))


@F.arrow_udf(T.DoubleType())
def _double(key: pa.Array) -> pa.Array:
    keys = key.fill_null(0).to_numpy()
    values = np.abs(keys).view(np.float64)
    return pa.array(np.where(keys < 0, -values, values), mask=key.is_null().to_numpy(zero_copy_only=False))


def add_sortable(df: DataFrame, x: str = "x", out: str = "key") -> DataFrame:
    """Add a 64-bit integer in the order of the doubles of ``x``: the bits of the magnitude, negated below zero; NaN is
    largest, null stays null.

    Different doubles get different integers, and both zeros get 0.
    """
    return df.withColumn(out, _sortable(F.col(x)))


def group_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), stored: bool = False
) -> DataFrame:
    """What ``exact_quantiles`` gives: groups of up to ``SORTED_GROUP_ROWS`` rows are sorted after one shuffle, which takes fewer passes
    over the rows where there are many groups; larger ones go through ``exact_quantiles``."""
    by = list(by)
    rows = df if stored else materialize(df.select(*by, *columns))
    keyed = rows.withColumn(_GROUP, key_text(by))
    sizes = keyed.groupBy(_GROUP).agg(F.count(F.lit(1)).alias("n"))
    n, most = sizes.agg(F.sum("n"), F.max("n")).first()
    if (most or 0) <= SORTED_GROUP_ROWS:
        return _sorted_quantiles(rows, columns, probs, by, n)
    if not by:
        return exact_quantiles(rows, columns, probs, by, stored=True)
    # Fewer than rows / SORTED_GROUP_ROWS.
    large = F.broadcast(materialize(sizes.where(F.col("n") > SORTED_GROUP_ROWS).select(_GROUP)))
    small, rest = (keyed.join(large, _GROUP, how).select(*by, *columns) for how in ("left_anti", "left_semi"))
    return _sorted_quantiles(small, columns, probs, by, n).unionByName(exact_quantiles(rest, columns, probs, by))


def _sorted_quantiles(rows: DataFrame, columns: Sequence[str], probs: Sequence[float], by: list[str], n: int | None) -> DataFrame:
    """From each group's values in order. The rows are shuffled before they are collected, so they are sorted by group only once."""
    names = [f"_v{i}" for i in range(len(columns))]
    # A sum with zero makes both zeros one.
    values = rows.select(*by, *[(F.col(c).cast("double") + F.lit(0.0)).alias(x) for c, x in zip(columns, names, strict=True)])
    whole = dealt(values.repartition(*by), n, *by) if by else values
    lists = whole.groupBy(*by).agg(*[F.sort_array(F.collect_list(x)).alias(x) for x in names])
    picks = []
    for c, x in zip(columns, names, strict=True):
        last = F.size(x) - 1
        for p in probs:
            exact = last * F.lit(float(p))
            low = F.floor(exact).cast("int")
            lo, hi = F.get(x, low), F.get(x, F.least(low + 1, last))
            picks.append((lo + F.when(hi == lo, F.lit(0.0)).otherwise((hi - lo) * (exact - low))).alias(_name(c, p)))
    return lists.select(*by, *picks)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), stored: bool = False
) -> DataFrame:
    """One row per group with ``<column>_p<percent>`` columns; nulls are ignored, a group of nulls has null quantiles.

    Without ``by`` there is one row, also for an empty table. ``stored`` says that ``df`` is a stored table, which is read
    twice; another one is stored first.
    """
    by, names = list(by), [f"_v{i}" for i in range(len(columns))]
    keys = [_sortable(F.col(c).cast("double")).alias(n) for c, n in zip(columns, names, strict=True)]
    rows = df.select(*by, *keys) if stored else materialize(df.select(*by, *keys))
    groups = rows.select(*by).distinct() if by else df.sparkSession.range(1)
    groups = groups.withColumn(_GROUP, key_text(by))
    rows = rows.select(key_text(by).alias(_GROUP), *names)

    first = rows.select(_GROUP, F.posexplode(F.array(*names)).alias("c", "key")).where("key IS NOT NULL")
    level = first.groupBy(_GROUP, "c", F.shiftright("key", SHIFTS[0]).alias("digit")).agg(F.count(F.lit(1)).alias("n"))
    level = materialize(level)
    wanted = level.groupBy(_GROUP, "c").agg(F.sum("n").alias("total"))
    wanted = wanted.select(_GROUP, "c", F.explode(F.array(*[_ranks(k, p) for k, p in enumerate(probs)])).alias("r"))
    sides = [F.struct("r.k", F.lit(s).alias("side"), F.col(f"r.{s}").alias("rank"), "r.frac") for s in ("lo", "hi")]
    wanted = wanted.select(_GROUP, "c", F.explode(F.array(*sides)).alias("r")).select(_GROUP, "c", "r.*")

    found = materialize(_narrow(level, wanted, [_GROUP, "c"]))
    near = _values_near(rows, names, found).groupBy(_GROUP, "c", "key").agg(F.count(F.lit(1)).alias("n"))
    near = materialize(near)
    for above, below in zip(SHIFTS, SHIFTS[1:], strict=False):
        level = near.withColumns({"upper": F.shiftright("key", above), "digit": F.shiftright("key", below)})
        level = level.groupBy(_GROUP, "c", "upper", "digit").agg(F.sum("n").alias("n"))
        found = _narrow(level, found.withColumnRenamed("digit", "upper"), [_GROUP, "c", "upper"])

    at = {(i, k, s): F.max(F.when((F.col("c") == i) & (F.col("k") == k) & (F.col("side") == s), F.col("digit"))).alias(f"_{i}_{k}_{s}")
          for i in range(len(columns)) for k in range(len(probs)) for s in ("lo", "hi")}
    part = {(i, k): F.max(F.when((F.col("c") == i) & (F.col("k") == k), F.col("frac"))).alias(f"_{i}_{k}") for i, k, _ in at}
    wide = found.groupBy(_GROUP).agg(*at.values(), *part.values())
    # The last digits are the whole integers.
    wide = wide.withColumns({f"_{i}_{k}_{s}": _double(F.col(f"_{i}_{k}_{s}")) for i, k, s in at})
    picks = []
    for i, c in enumerate(columns):
        for k, p in enumerate(probs):
            lo, hi = F.col(f"_{i}_{k}_lo"), F.col(f"_{i}_{k}_hi")
            picks.append((lo + F.when(hi == lo, F.lit(0.0)).otherwise((hi - lo) * F.col(f"_{i}_{k}"))).alias(_name(c, p)))
    return groups.join(wide, _GROUP, "left").select(*by, *picks)


def _values_near(rows: DataFrame, names: Sequence[str], found: DataFrame) -> DataFrame:
    """The integers of ``rows`` in the digits that hold wanted ranks, as ``(group, c, key)``.

    Those digits, a few for each column, lie in one row per group. Up to ``BROADCAST_GROUPS`` such rows are broadcast, so that no
    value is shuffled for them; more of them are joined by group before the values become rows.
    """
    spots = [F.collect_set(F.when(F.col("c") == i, F.col("digit"))).alias(f"_s{i}") for i in range(len(names))]
    spots = materialize(found.groupBy(_GROUP).agg(*spots))
    side = F.broadcast(spots) if spots.count() <= BROADCAST_GROUPS else spots
    near = [F.when(F.array_contains(f"_s{i}", F.shiftright(n, SHIFTS[0])), F.col(n)) for i, n in enumerate(names)]
    return rows.join(side, _GROUP).select(_GROUP, F.posexplode(F.array(*near)).alias("c", "key")).where("key IS NOT NULL")


def _ranks(k: int, prob: float) -> Column:
    """Places, from 0, of the two values a quantile lies between, and how far it lies from the lower one."""
    exact = (F.col("total") - 1) * F.lit(float(prob))
    low = F.floor(exact)
    return F.struct(
        F.lit(k).alias("k"), low.alias("lo"), F.least(low + 1, F.col("total") - 1).alias("hi"), (exact - low).alias("frac")
    )


def _narrow(level: DataFrame, wanted: DataFrame, within: list[str]) -> DataFrame:
    """The digits that hold the wanted ranks, and the ranks inside them: a running sum over a histogram of one digit."""
    order = Window.partitionBy(*within).orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    before = level.withColumn("_before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    inside = (F.col("rank") >= F.col("_before")) & (F.col("rank") < F.col("_before") + F.col("n"))
    held = before.join(wanted, within).filter(inside).withColumn("rank", F.col("rank") - F.col("_before"))
    return held.select(*[c for c in within if c != "upper"], "digit", "k", "side", "rank", "frac")
