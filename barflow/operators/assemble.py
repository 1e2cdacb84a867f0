"""Splits, sequences, scaling, feature selection, batching and the composite feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.operators.clean import clean_price_data, drop_missing_targets
from barflow.operators.correlation import pair_correlations
from barflow.operators.groups import beside_groups
from barflow.operators.indicators import INDICATORS, add_indicators, lookback_for
from barflow.operators.news import news_features
from barflow.operators.numbering import number_rows
from barflow.operators.series import BLOCK_ROWS, ROW, cut_blocks, default_bucket
from barflow.operators.targets import CHANGE_BESIDE_INDICATORS, HORIZONS, add_targets
from barflow.session import materialize

SPLIT = "split"
SHUFFLE_BUCKET_DIGITS = 4


def _cut_points(n: Column, fractions: Sequence[float]) -> list[Column]:
    """Row counts of all parts but the last, each truncated to an integer."""
    points, at = [], F.lit(0).cast("bigint")
    for f in fractions:
        at = at + F.floor(n * F.lit(f))
        points.append(at)
    return points


def _label(position: Column, n: Column, fractions: Sequence[float], names: Sequence[str]) -> Column:
    label = F.lit(names[-1])
    for name, point in reversed(list(zip(names, _cut_points(n, fractions)))):
        label = F.when(position < point, name).otherwise(label)
    return label


def _cut_dates(df: DataFrame, fractions: Sequence[float], order: str) -> list[Column]:
    """First date of every part but the first, as scalar subqueries; null for a part that has none.

    Only counts by date are shuffled. Running sums go over coarse buckets of dates and then inside each bucket.
    """
    try:
        bucket = default_bucket(df, order)
    except ValueError:  # a kind of key without buckets, such as text
        bucket = F.lit(0)
    days = df.where(F.col(order).isNotNull()).groupBy(order).agg(F.count(F.lit(1)).alias("_m"))
    days = days.withColumn("_bucket", bucket)
    so_far = (Window.unboundedPreceding, -1)
    buckets = days.groupBy("_bucket").agg(F.sum("_m").alias("_n"))
    buckets = buckets.select(
        "_bucket",
        F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(*so_far)), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_all"),
    )
    inside = F.sum("_m").over(Window.partitionBy("_bucket").orderBy(order).rowsBetween(*so_far))
    days = days.join(buckets, "_bucket").withColumn("_at", F.col("_before") + F.coalesce(inside, F.lit(0)))
    points = _cut_points(F.col("_all"), fractions)
    cuts = days.agg(*[F.min(F.when(F.col("_at") >= p, F.col(order))).alias(f"_{i}") for i, p in enumerate(points)])
    return [cuts.select(f"_{i}").scalar() for i in range(len(points))]


def split_dataset(
    df: DataFrame,
    fractions: Sequence[float] = (0.8,),
    names: Sequence[str] = ("train", "test"),
    mode: str = "global_time",
    by: str = "symbol",
    order: str = "date",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add a ``split`` column. ``fractions`` gives all parts but the last.

    * ``global_time``: whole dates, earliest first; a date belongs to the part its first row falls in.
    * ``per_symbol_time``: the same row fractions within every symbol.
    * ``position``: by row number of the symbol-by-symbol concatenation, so the last symbols are the
      last part.
    """
    if len(names) != len(fractions) + 1:
        raise ValueError("one more name than fractions is needed")
    if mode == "global_time":
        label = F.lit(names[-1])
        for name, start in reversed(list(zip(names, _cut_dates(df, fractions, order)))):
            label = F.when(start.isNull() | (F.col(order) < start), name).otherwise(label)
        return df.withColumn(SPLIT, F.when(F.col(order).isNotNull(), label))
    if mode == "position":
        # The total is a scalar, the numbers those of the rows in order of symbol and time.
        numbered = number_rows(df, [by, order], ROW)
        whole = numbered.withColumn("_all", df.agg(F.count(F.lit(1))).scalar())
        return whole.withColumn(SPLIT, _label(F.col(ROW), F.col("_all"), fractions, names)).select(*df.columns, SPLIT)
    if mode != "per_symbol_time":
        raise ValueError(f"unknown split mode {mode!r}")
    totals = df.groupBy(by).agg(F.count(F.lit(1)).alias("_all"))
    numbered = cut_blocks(df, [by], order, block_rows=block_rows).result(keep=[ROW])
    joined = beside_groups(numbered, totals, [by])
    label = _label(F.col(ROW), F.col("_all"), fractions, names)
    return joined.withColumn(SPLIT, label).select(*df.columns, SPLIT)


def prepare_dataset(df: DataFrame, target: str, test_size: float = 0.2, mode: str = "global_time", **kw) -> DataFrame:
    """Drop rows without a target, then mark train and test."""
    return split_dataset(drop_missing_targets(df, target), (1 - test_size,), ("train", "test"), mode, **kw)


def three_way_split(df: DataFrame, train: float = 0.7, val: float = 0.15, mode: str = "global_time", **kw) -> DataFrame:
    return split_dataset(df, (train, val), ("train", "val", "test"), mode, **kw)


def first_sample(df: DataFrame, split: str, order: Sequence[str] = ("symbol", "date")) -> DataFrame:
    """The first row of a split; an absent split raises."""
    if split not in ("train", "val", "test"):
        raise ValueError(f"split {split!r} not available")
    found = df.where(F.col(SPLIT) == split).orderBy(*order).limit(1)
    if found.isEmpty():
        raise ValueError(f"split {split!r} not available")
    return found


def create_sequences(
    df: DataFrame,
    length: int = 30,
    column: str = "Close",
    by: Sequence[str] = ("symbol",),
    order: str = "date",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``length`` values before each row as ``X`` (nulls kept) and the row's own value as ``y``."""
    blocks = cut_blocks(df.select(*by, order, column), by, order, length, 0, block_rows)
    boxed = F.collect_list(F.struct(F.col(column).alias("v"))).over(blocks.rows(-length, -1))
    blocks = blocks.with_columns({"X": F.transform(boxed, lambda s: s["v"])})
    return blocks.result(keep=[ROW]).where(F.col(ROW) >= length).select(*by, order, "X", F.col(column).alias("y"))


# --- scaling -----------------------------------------------------------------------------------


def fit_scaler(df: DataFrame, columns: Sequence[str], kind: str = "standard") -> DataFrame:
    """Parameters ``(feature, center, scale)``; one row per feature, nulls ignored."""
    if kind not in ("standard", "minmax"):
        raise ValueError("kind must be 'standard' or 'minmax'")
    stats = []
    for c in columns:
        if kind == "standard":
            center, scale = F.avg(c), F.stddev_pop(c)
        else:
            center, scale = F.min(c).cast("double"), (F.max(c) - F.min(c)).cast("double")
        safe = F.when(scale == 0, 1.0).otherwise(scale)
        stats.append(F.struct(F.lit(c).alias("feature"), center.alias("center"), safe.alias("scale")))
    return df.agg(F.array(*stats).alias("p")).select(F.inline("p"))


def apply_scaler(df: DataFrame, params: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Scale the named features; without ``columns``, those listed in ``params``, which are then looked up first.

    The one-row parameter map is a scalar subquery.
    """
    whole = params.agg(
        F.map_from_entries(F.collect_list(F.struct("feature", F.struct("center", "scale")))).alias("m")
    ).scalar()
    names = columns if columns is not None else [r[0] for r in params.select("feature").collect()]
    scaled = {c: (F.col(c) - F.col("_p")[c]["center"]) / F.col("_p")[c]["scale"] for c in names}
    return df.withColumn("_p", whole).withColumns(scaled).select(*df.columns)


def scale_features(df: DataFrame, columns: Sequence[str], kind: str = "standard") -> DataFrame:
    return apply_scaler(df, fit_scaler(df, columns, kind), columns)


# --- feature selection -------------------------------------------------------------------------


def feature_scores(df: DataFrame, columns: Sequence[str], target: str, k: int = 20) -> DataFrame:
    """Univariate F score of every feature against ``target`` in one aggregation.

    ``(feature, idx, score, rank, selected)``; a constant feature scores 0 and of equal scores the
    later column ranks first. Rows with a null in a feature or the target do not count for it.
    """
    found = pair_correlations(df, [(c, target) for c in columns])
    r2 = F.col("corr") * F.col("corr")
    score = F.when(F.col("corr").isNull(), 0.0).otherwise(
        F.when(r2 >= 1, F.lit(float("inf"))).otherwise(F.try_divide(r2, 1 - r2) * (F.col("n") - 2))
    )
    scored = found.select(F.col("a").alias("feature"), F.col("pair").alias("idx"), score.alias("score"))
    best = Window.orderBy(F.desc("score"), F.desc("idx"))
    return scored.withColumn("rank", F.row_number().over(best)).withColumn("selected", F.col("rank") <= k)


def selected_names(scores: DataFrame) -> list[str]:
    """Names of the selected features in original column order (a handful of rows)."""
    return [r[0] for r in scores.where("selected").orderBy("idx").select("feature").collect()]


def select_features(df: DataFrame, columns: Sequence[str], target: str, k: int = 20) -> DataFrame:
    """The other columns and the ``k`` best features. The table is stored, as it is read for the scores and for the result; the
    scores, one row per column, tell the driver which columns to read."""
    others = [c for c in df.columns if c not in columns]
    stored = materialize(df)
    return stored.select(*others, *selected_names(feature_scores(stored, columns, target, k)))


# --- rows as dictionaries, batches -------------------------------------------------------------


def feature_map(columns: Sequence[str]) -> Column:
    """One row's features as ``map<string,double>``."""
    pairs = []
    for c in columns:
        pairs += [F.lit(c), F.col(c).cast("double")]
    return F.create_map(*pairs)


def mini_batches(df: DataFrame, key: str, size: int = 4, seed: int | None = None) -> DataFrame:
    """Add ``batch_id`` and ``batch_pos``: seeded random order, or key order without a seed.

    In key order rows are numbered by ranges of the key. In random order positions come from counts per bucket, a
    range of hashes, plus the place within a bucket, so all are about equal.
    """
    if seed is None:
        return _batch(number_rows(df, [key], ROW), F.col(ROW), size, df.columns)
    hashed = df.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}/"), F.col(key).cast("string"))))
    hashed = hashed.withColumn("_b", F.substring("_h", 1, SHUFFLE_BUCKET_DIGITS))
    counts = hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("_m"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_b", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_at"))
    place = F.row_number().over(Window.partitionBy("_b").orderBy("_h", key)) - 1
    return _batch(hashed.join(starts, "_b"), F.col("_at") + place, size, df.columns)


def _batch(df: DataFrame, position: Column, size: int, columns: Sequence[str]) -> DataFrame:
    numbered = df.withColumn("_position", position)
    return numbered.select(
        *columns,
        F.expr(f"_position div {size}").alias("batch_id"),
        (F.col("_position") % size).cast("int").alias("batch_pos"),
    )


# --- composites --------------------------------------------------------------------------------


def feature_table(
    bars: DataFrame,
    news: DataFrame | None = None,
    indicators: Sequence[str] = tuple(INDICATORS),
    horizons: Sequence[int] = HORIZONS,
    clean: bool = True,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Clean, indicators, targets and news for all symbols; indicators and targets share one cut.

    Return targets are called ``next_price_change_<h>d`` here.
    """
    base = clean_price_data(bars, block_rows=block_rows) if clean else bars
    blocks = cut_blocks(base, ["symbol"], "date", lookback_for(indicators), max(horizons), block_rows)
    blocks = add_targets(add_indicators(blocks, indicators), horizons, change=CHANGE_BESIDE_INDICATORS)
    table = blocks.result()
    return news_features(news, table) if news is not None else table


def prepare_data(
    bars: DataFrame,
    news: DataFrame | None = None,
    target: str = "price_direction_1d",
    test_size: float = 0.2,
    mode: str = "global_time",
    **kw,
) -> DataFrame:
    """The whole preparation: feature table plus ``split``."""
    return prepare_dataset(feature_table(bars, news, **kw), target, test_size, mode)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
