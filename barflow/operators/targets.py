"""Forward-looking target columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.operators.series import BLOCK_ROWS, Blocks, cut_blocks

HORIZONS = (1, 5, 20)


CHANGE = "price_change"
# Spark compares names ignoring case, so next to the indicator Price_change_5d the target needs another name.
CHANGE_BESIDE_INDICATORS = "next_price_change"


def target_columns(horizons: Sequence[int] = HORIZONS, change: str = CHANGE) -> list[str]:
    return [f"{kind}_{h}d" for h in horizons for kind in ("price_direction", change, "volatility")]


def add_targets(
    blocks: Blocks,
    horizons: Sequence[int] = HORIZONS,
    close: str = "Close",
    tail: str = "zero",
    change: str = CHANGE,
) -> Blocks:
    """Targets on a cut series (halo ahead at least ``max(horizons)``).

    ``tail`` decides the direction of the last rows, which have no future close: ``zero`` or ``null``.
    ``change`` names the return targets.
    """
    if tail not in ("zero", "null"):
        raise ValueError("tail must be 'zero' or 'null'")
    taken = {c.lower() for c in blocks.df.columns} & {c.lower() for c in target_columns(horizons, change)}
    if taken:
        raise ValueError(f"target columns would overwrite {sorted(taken)}; pass change=")
    new: dict[str, Column] = {}
    for h in horizons:
        ahead = F.lead(close, h).over(blocks.window)
        rises = ahead > F.col(close)
        new[f"price_direction_{h}d"] = (F.coalesce(rises, F.lit(False)) if tail == "zero" else rises).cast("int")
        new[f"{change}_{h}d"] = F.try_divide(ahead, F.col(close)) - 1
        frame = blocks.rows(1, h)
        new[f"volatility_{h}d"] = F.when(F.count(close).over(frame) == h, F.stddev_samp(close).over(frame))
    return blocks.with_columns(new)


def target_variables(
    df: DataFrame,
    horizons: Sequence[int] = HORIZONS,
    by: Sequence[str] = ("symbol",),
    order: str = "date",
    close: str = "Close",
    tail: str = "zero",
    block_rows: int = BLOCK_ROWS,
    change: str = CHANGE,
) -> DataFrame:
    blocks = cut_blocks(df, by, order, 0, max(horizons), block_rows)
    return add_targets(blocks, horizons, close, tail, change).result()


def direction_text(direction: Column) -> Column:
    """0/1 direction as the texts False / True."""
    return F.initcap(direction.cast("boolean").cast("string"))
