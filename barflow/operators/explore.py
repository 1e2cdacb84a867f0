"""Exploration queries: counts, profiles, distributions, correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.operators.correlation import pair_correlations
from barflow.operators.quantiles import exact_quantiles


def rows_per_symbol(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"))


def profile(df: DataFrame, time: str = "date", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.min(time).alias("first_date"),
        F.max(time).alias("last_date"),
    )


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, sample std, min, exact quartiles, max."""
    stats = []
    for c in columns:
        x = F.col(c).cast("double")
        stats.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(x).alias("count"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
            )
        )
    moments = df.agg(F.array(*stats).alias("s")).select(F.inline("s"))
    quart = exact_quantiles(df, columns, (0.25, 0.5, 0.75), ())
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}_p25").alias("p25"),
            F.col(f"{c}_p50").alias("p50"),
            F.col(f"{c}_p75").alias("p75"),
        )
        for c in columns
    ]
    long = quart.select(F.inline(F.array(*rows)))
    return moments.join(long, "column").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def column_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-null and distinct counts per column."""
    found = df.agg(
        *[F.count(c).alias(f"n_{c}") for c in columns], *[F.countDistinct(c).alias(f"d_{c}") for c in columns]
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("non_null"), F.col(f"d_{c}").alias("distinct"))
        for c in columns
    ]
    return found.select(F.inline(F.array(*rows)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of every non-null value, most frequent first, with its percentage."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(column)).scalar()
    return counts.withColumn("percent", F.try_divide(F.col("count") * 100.0, total)).orderBy(
        F.desc("count"), column
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed; empty bins included."""
    x = F.col(column).cast("double")
    span = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias("s")).scalar()
    placed = df.where(x.isNotNull()).select(x.alias("_x"), span.alias("_s"))
    lo, width = F.col("_s.lo"), (F.col("_s.hi") - F.col("_s.lo")) / bins
    index = F.least(F.coalesce(F.floor(F.try_divide(F.col("_x") - lo, width)), F.lit(0)), F.lit(bins - 1))
    counts = placed.groupBy(index.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), span.alias("_s"))
    return frame.join(counts, "bin", "left").select(
        "bin",
        (lo + width * F.col("bin")).alias("lower"),
        (lo + width * (F.col("bin") + 1)).alias("upper"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def correlations(df: DataFrame, columns: Sequence[str], lower_only: bool = False) -> DataFrame:
    """Pearson correlation of every pair over the rows where both are present, in one aggregation.

    ``(a, b, corr)``, both orders and the diagonal unless ``lower_only`` (a after b in ``columns``).
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[: i + (0 if lower_only else 1)]]
    found = pair_correlations(df, pairs)
    both = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    sides = F.slice(both, 1, 1) if lower_only else F.array_distinct(both)
    return found.select(F.inline(sides), "corr")


def top_correlated(df: DataFrame, columns: Sequence[str], target: str, n: int = 10) -> DataFrame:
    """The ``n`` columns with the largest absolute correlation with ``target``."""
    found = pair_correlations(df, [(c, target) for c in columns if c != target])
    return found.select(F.col("a").alias("feature"), "corr").orderBy(F.abs("corr").desc_nulls_last(), "feature").limit(n)


def volatility_summary(
    df: DataFrame, returns: str = "daily_return", volatility: str = "return_volatility_20d", rsi: str = "RSI"
) -> DataFrame:
    return df.agg(
        F.avg(returns).alias("mean_return"),
        F.stddev_samp(returns).alias("return_std"),
        F.avg(volatility).alias("mean_volatility"),
        F.max(volatility).alias("max_volatility"),
        F.min(rsi).alias("min_rsi"),
        F.max(rsi).alias("max_rsi"),
    )
