"""Cleaning, predicates and null handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.operators.groups import beside_groups
from barflow.operators.quantiles import group_quantiles
from barflow.operators.series import BLOCK_ROWS, cut_blocks
from barflow.session import materialize

PRICE_COLUMNS = ("Open", "High", "Low", "Close", "Volume")
NEWS_ZERO_FILLED = ("news_count", "sentiment_mean", "sentiment_std")
ID_COLUMNS = ("symbol", "date")


def forward_fill(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = ("symbol",),
    order: str = "date",
    block_rows: int = BLOCK_ROWS,
    bucket: Column | str | None = None,
) -> DataFrame:
    """Last non-null value so far, however far back; leading nulls stay null."""
    carries = {
        f"_last_{c}": (
            F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col(order))),
            lambda col, before: F.last(col, ignorenulls=True).over(before),
        )
        for c in columns
    }
    blocks = cut_blocks(df, by, order, 0, 0, block_rows, bucket, carries)
    filled = {
        c: F.coalesce(F.last(c, ignorenulls=True).over(blocks.so_far), F.col(f"_last_{c}")) for c in columns
    }
    return blocks.with_columns(filled).result().select(*df.columns)


def drop_empty_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(how="all", subset=list(columns))


def iqr_bounds(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = ("symbol",),
    factor: float = 1.5,
    stored: bool = False,
) -> DataFrame:
    """Per group ``<column>_lo`` / ``<column>_hi``: quartiles -/+ ``factor`` times their distance."""
    quartiles = group_quantiles(df, columns, (0.25, 0.75), by, stored)
    picks = []
    for c in columns:
        q1, q3 = F.col(f"{c}_p25"), F.col(f"{c}_p75")
        picks += [(q1 - factor * (q3 - q1)).alias(f"{c}_lo"), (q3 + factor * (q3 - q1)).alias(f"{c}_hi")]
    return quartiles.select(*by, *picks)


def cap_outliers(df: DataFrame, bounds: DataFrame, columns: Sequence[str], by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Clamp to the group's bounds; nulls stay null. Columns become double."""
    joined = beside_groups(df, bounds, by)
    capped = {}
    for c in columns:
        value, lo, hi = F.col(c).cast("double"), F.col(f"{c}_lo"), F.col(f"{c}_hi")
        capped[c] = F.when(value < lo, lo).when(value > hi, hi).otherwise(value)
    return joined.withColumns(capped).select(*df.columns)


def clean_price_data(
    df: DataFrame,
    columns: Sequence[str] = PRICE_COLUMNS,
    by: Sequence[str] = ("symbol",),
    order: str = "date",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Forward fill, drop rows that are still empty, cap outliers at the IQR bounds.

    The filled table is written once because the bounds and the capping both read it.
    """
    present = [c for c in columns if c in df.columns]
    filled = materialize(drop_empty_rows(forward_fill(df, present, by, order, block_rows), present))
    return cap_outliers(filled, iqr_bounds(filled, present, by, stored=True), present, by)


def drop_missing_targets(df: DataFrame, target: str) -> DataFrame:
    """Rows with a target; a NaN is none. Only that needs ``dropna``: a plain test goes where a target cannot be null, and with it,
    where only the rows are counted, what the target is made of."""
    kind = df.schema[target].dataType
    return df.dropna(subset=[target]) if isinstance(kind, (T.FloatType, T.DoubleType)) else df.where(df[target].isNotNull())


def fill_news_zeros(df: DataFrame) -> DataFrame:
    """``sentiment_count`` is deliberately left null where there was no news."""
    return df.fillna(0, subset=[c for c in NEWS_ZERO_FILLED if c in df.columns])


def validate_samples(df: DataFrame, target: str) -> DataFrame:
    """Raise when a required column is absent; return the counts of rows and of null targets."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    for c in ID_COLUMNS:
        if c not in df.columns:
            raise ValueError(f"required column {c!r} not found")
    return df.agg(F.count(F.lit(1)).alias("samples"), F.count_if(F.col(target).isNull()).alias("missing_targets"))


def feature_columns(df: DataFrame, target: str = "price_direction_1d", reference_compat: bool = False) -> list[str]:
    """All columns but the ids and the target. Other forward-looking columns leak the future and are
    left out too, unless ``reference_compat`` asks for them."""
    kept = [c for c in df.columns if c not in (*ID_COLUMNS, target)]
    if reference_compat:
        return kept
    future = tuple(f"{k}_" for k in ("price_direction", "price_change", "next_price_change", "volatility"))
    return [c for c in kept if not (c.startswith(future) and c.endswith("d") and c[:-1].rsplit("_", 1)[-1].isdigit())]
