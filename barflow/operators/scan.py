"""Exponential averages as a prefix scan over blocks.

Over the rows of one block an average is an affine map of the value ``y`` it comes in with: after p rows it is
``g**p * y + offset``, with g = 1 - alpha. The offsets come from running sums inside the block alone. A block's map is
(rows, offset at its end); maps are composed over the blocks before, a table of one row per block, and give every block the
value it comes in with. No block needs another's rows, however long the gaps.

An average of averages (a signal line) is affine too: in its own value and in those of the averages it is made of, with
coefficients that depend on the number of rows only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from barflow.operators.series import BLOCK, CORE, RUN, Blocks

# What is weighted below 2**-80 is lost in double rounding anyway.
NEGLIGIBLE_BITS = 80
MAX_SCALE_EXPONENT = 600.0


@dataclass(frozen=True)
class Average:
    """y[0] = x[0], y[t] = (1 - alpha) * y[t-1] + alpha * x[t] over the counted rows; null until ``min_rows`` rows.

    ``source`` is not null where rows are counted. With ``from_zero`` the first source is 0, as that of a first difference is.
    """

    out: str
    source: Column
    alpha: float
    min_rows: int
    from_zero: bool = False

    @property
    def keep(self) -> float:
        return 1.0 - self.alpha


@dataclass(frozen=True)
class Difference:
    """``out``: the average with ``alpha`` of (fast - slow), begun at the slow one's first value and null for ``min_rows`` - 1 more."""

    out: str
    fast: Average
    slow: Average
    alpha: float
    min_rows: int

    @property
    def keep(self) -> float:
        return 1.0 - self.alpha


def negligible_after(alpha: float) -> int:
    """Rows after which a term of an exponential average weighs less than 2**-80."""
    return max(1, math.ceil(NEGLIGIBLE_BITS * math.log(2) / -math.log1p(-alpha)))


def _power(base: float, exponent: Column | str) -> Column:
    return F.pow(F.lit(base), exponent)


def _offsets(blocks: Blocks, sums: dict[str, tuple[Column, float]]) -> Blocks:
    """Running ``offset``: the sum of alpha * x * g ** (rows since), from the start of the block, for each (alpha * x, alpha).

    Rows are cut into segments short enough for g ** -p, and so long that only the segment just before still matters.
    """
    inner = Window.partitionBy(*blocks.keys, BLOCK, "_seg").orderBy(*blocks.order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*blocks.keys, BLOCK).orderBy("_seg", *blocks.order).rowsBetween(Window.unboundedPreceding, -1)
    terms, locals_, carried, outs = {}, {}, {}, {}
    for name, (term, alpha) in sums.items():
        g = 1.0 - alpha
        terms[f"_t{name}"] = F.when(F.col("_counted"), term * _power(g, -F.col("_off")))
        locals_[f"_l{name}"] = F.sum(f"_t{name}").over(inner) * _power(g, "_off")
        carried[f"_c{name}"] = F.last(F.when(F.col("_last"), F.col(f"_l{name}")), True).over(earlier)
        outs[name] = F.when(F.col("_counted"), F.col(f"_l{name}") + F.coalesce(_power(g, F.col("_off") + 1) * F.col(f"_c{name}"), F.lit(0.0)))
    for step in (terms, locals_, carried, outs):
        blocks = blocks.with_columns(step)
    return blocks.temporaries(*terms, *locals_, *carried, *outs)


def averages(blocks: Blocks, counted: str, wanted: Sequence[Average], signal: Difference | None = None) -> Blocks:
    """Add the averages, and the signal line on two of them, over the rows where ``counted`` is not null."""
    alphas = [a.alpha for a in wanted] + ([signal.alpha] if signal else [])
    reach = max(map(negligible_after, alphas))
    if reach * -math.log1p(-max(alphas)) > MAX_SCALE_EXPONENT:
        raise ValueError("smoothing factors too far apart for one pass; compute them separately")
    blocks = blocks.with_columns({"_counted": F.col(CORE) & F.col(counted).isNotNull()})
    blocks = blocks.with_columns({"_pos": F.count(F.when(F.col("_counted"), 1)).over(blocks.so_far)})
    blocks = blocks.with_columns(
        {
            "_seg": F.expr(f"greatest(_pos - 1, 0) div {reach}"),
            "_off": F.expr(f"greatest(_pos - 1, 0) % {reach}"),
            "_last": (F.expr(f"_pos % {reach}") == 0) & F.col("_counted"),
        }
    ).temporaries("_counted", "_pos", "_seg", "_off", "_last")
    blocks = _offsets(blocks, {f"_y_{a.out}": (a.alpha * a.source, a.alpha) for a in wanted})
    if signal:
        gap = F.col(f"_y_{signal.fast.out}") - F.col(f"_y_{signal.slow.out}")
        blocks = _offsets(blocks, {"_y_signal": (signal.alpha * gap, signal.alpha)})
    states = _states_cut(blocks, wanted, signal, reach) if blocks.is_cut else _states_whole(blocks, wanted)
    pos = F.col("_ahead") + F.col("_pos")
    found = {a.out: F.col(f"_y_{a.out}") + _power(a.keep, "_pos") * F.col(f"_in_{a.out}") for a in wanted}
    states = states.with_columns({a.out: F.when(pos >= a.min_rows, found[a.out]) for a in wanted})
    if signal:
        states = _signal(states, signal, found, pos)
    return states


def _chain(signal: Difference, part: Average, rows: Column | str) -> Column:
    """What one unit of an average's incoming value adds to the signal's sum after so many rows."""
    rows = F.col(rows) if isinstance(rows, str) else rows
    g, h = signal.keep, part.keep
    if abs(g - h) < 1e-12:
        return signal.alpha * h * rows * F.pow(F.lit(g), rows - 1)
    return signal.alpha * h * (_power(g, rows) - _power(h, rows)) / (g - h)


def _sum(signal: Difference, rows: Column | str) -> Column:
    """The signal's sum from the start of the series, on a row or at a block's end."""
    fast, slow = (_chain(signal, p, rows) * F.col(f"_in_{p.out}") for p in (signal.fast, signal.slow))
    return F.col("_y_signal") + fast - slow + _power(signal.keep, rows) * F.col("_in_signal")


def _signal(blocks: Blocks, signal: Difference, found: dict[str, Column], pos: Column) -> Blocks:
    """The signal begins with the slow average's first value: that is put in as one more term, which fades."""
    skip = signal.slow.min_rows - 1
    gap = found[signal.fast.out] - found[signal.slow.out]
    blocks = blocks.with_columns({"_sum": F.when(F.col("_counted"), _sum(signal, "_pos"))}).temporaries("_sum")
    if not blocks.is_cut:
        last = F.coalesce(F.max(F.when(pos == skip, F.col("_sum"))).over(blocks.so_far), F.lit(0.0))
        start = F.max(F.when(pos == skip + 1, gap)).over(blocks.so_far)
        blocks = blocks.with_columns({"_start": start - last}).temporaries("_start")
    value = F.col("_sum") + F.coalesce(_power(signal.keep, pos - skip) * F.col("_start"), F.lit(0.0))
    return blocks.with_columns({signal.out: F.when(pos >= skip + signal.min_rows, value)})


def _states_whole(blocks: Blocks, wanted: Sequence[Average]) -> Blocks:
    """A series in one block comes in with its first value."""
    new = {f"_in_{a.out}": F.lit(0.0) if a.from_zero else F.first(F.when(F.col("_counted"), a.source), True).over(blocks.so_far) for a in wanted}
    new |= {"_in_signal": F.lit(0.0), "_ahead": F.lit(0)}
    return blocks.with_columns(new).temporaries(*new)


def _states_cut(blocks: Blocks, wanted: Sequence[Average], signal: Difference | None, reach: int) -> Blocks:
    """Values every block comes in with, from the maps of the blocks before it.

    One row per block with counted rows; blocks without need no value. A block looks back over the blocks that end within
    ``reach`` counted rows before it, each of which has at least one, and folds their maps.
    """
    names = [f"_y_{a.out}" for a in wanted] + (["_y_signal"] if signal else [])
    skip = signal.slow.min_rows - 1 if signal else 0
    head = F.struct("_pos", *names)
    maps = blocks.df.where("_counted").groupBy(RUN, BLOCK).agg(
        F.max("_pos").alias("_n"),
        *[F.max_by(n, "_pos").alias(n) for n in names],
        *[F.min_by(a.source, "_pos").alias(f"_first_{a.out}") for a in wanted if not a.from_zero],
        F.collect_list(F.when(F.col("_pos") <= skip + 1, head)).alias("_head"),
    )
    in_order = Window.partitionBy(RUN).orderBy(BLOCK)
    maps = maps.withColumn("_ahead", F.coalesce(F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    lead = F.when(F.lag("_n").over(in_order).isNotNull(), F.struct(*[F.lag(c).over(in_order).alias(c) for c in ("_n", *names)]))
    first = {f"_first_{a.out}": F.first(f"_first_{a.out}").over(in_order) for a in wanted if not a.from_zero}
    maps = maps.withColumns({"_prev": lead, **first})
    near = Window.partitionBy(RUN).orderBy("_ahead").rangeBetween(-reach, Window.currentRow)
    maps = maps.withColumn("_maps", F.collect_list("_prev").over(near))

    def begin(a: Average) -> Column:
        return F.lit(0.0) if a.from_zero else F.col(f"_first_{a.out}")

    def step(state: Column, m: Column) -> Column:
        new = [(state[a.out] * _power(a.keep, m["_n"]) + m[f"_y_{a.out}"]).alias(a.out) for a in wanted]
        if signal:
            fast, slow = (_chain(signal, p, m["_n"]) * state[p.out] for p in (signal.fast, signal.slow))
            new.append((m["_y_signal"] + fast - slow + _power(signal.keep, m["_n"]) * state["signal"]).alias("signal"))
        return F.struct(*new)

    zero = [begin(a).alias(a.out) for a in wanted] + ([F.lit(0.0).alias("signal")] if signal else [])
    maps = maps.withColumn("_state", F.aggregate("_maps", F.struct(*zero), step))
    values = {f"_in_{a.out}": F.col("_state")[a.out] for a in wanted} | {"_in_signal": F.col("_state")["signal"] if signal else F.lit(0.0)}
    maps = maps.withColumns(values)
    if signal:
        maps = maps.withColumn("_start", F.max(_start_of(signal, skip)).over(Window.partitionBy(RUN)))
    maps = maps.select(
        F.col(RUN).alias("_map_run"), F.col(BLOCK).alias("_map_blk"), "_ahead", *values, *(["_start"] if signal else [])
    )
    joined = blocks.df.join(maps, (F.col(RUN) == F.col("_map_run")) & (F.col(BLOCK) == F.col("_map_blk")), "left")
    added = ["_ahead", *values, *(["_start"] if signal else [])]
    return Blocks(joined.drop("_map_run", "_map_blk"), blocks.keys, blocks.order, (*blocks.added, *added), True)


def _start_of(signal: Difference, skip: int) -> Column:
    """In the block where the signal begins: its first value less the sum just before, from the block's first rows."""
    at = F.lit(skip + 1) - F.col("_ahead")  # place of the signal's first row in the block

    def gap(h: Column) -> Column:
        fast, slow = (h[f"_y_{p.out}"] + _power(p.keep, h["_pos"]) * F.col(f"_in_{p.out}") for p in (signal.fast, signal.slow))
        return fast - slow

    def total(h: Column) -> Column:
        fast, slow = (_chain(signal, p, h["_pos"]) * F.col(f"_in_{p.out}") for p in (signal.fast, signal.slow))
        return h["_y_signal"] + fast - slow + _power(signal.keep, h["_pos"]) * F.col("_in_signal")

    here = F.filter("_head", lambda h: h["_pos"] == at)
    before = F.filter("_head", lambda h: h["_pos"] == at - 1)
    value = gap(F.get(here, F.lit(0))) - F.coalesce(total(F.get(before, F.lit(0))), F.col("_in_signal"))
    return F.when((at >= 1) & (at <= F.col("_n")), value)
