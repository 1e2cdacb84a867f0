"""Classification, regression, risk and calibration metrics.

Every function returns one row, or one row per group of ``by``. Ratios that the definition leaves
open for empty or constant input return the stated value instead of raising under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.operators.groups import beside_groups
from barflow.operators.quantiles import group_quantiles
from barflow.operators.series import BLOCK, BLOCK_ROWS, ROW, Blocks, cut_blocks
from barflow.session import materialize

TRADING_DAYS = 252
IGNORED_LABEL = -100
# The exact doubles of eleven evenly spaced points from 0 to 1. The products 3 * 0.1,
# 6 * 0.1 and 7 * 0.1 lie just above 0.3, 0.6 and 0.7.
BIN_EDGES = (0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9, 1.0)

INF = float("inf")
NAN = float("nan")


def ratio(a: Column, b: Column, otherwise: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(otherwise))


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _direction_counts(truth: str, pred: str) -> list[Column]:
    """Additive states of the direction metrics."""
    y, p = F.col(truth), F.col(pred)
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(y == p).alias("ok"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if(p == 1).alias("up"),
        F.count_if(p == 0).alias("down"),
        F.count_if(y == 1).alias("pos"),
    ]


def direction_accuracy(df: DataFrame, truth: str = "y_true", pred: str = "y_pred", by: Sequence[str] = ()) -> DataFrame:
    return _direction_ratios(df.groupBy(*by).agg(*_direction_counts(truth, pred)), by)


def direction_rollup(df: DataFrame, by: Sequence[str], truth: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """The direction metrics for all of ``by``, for all but its last column, and so on to the whole table, in one pass.

    The counts are made once per group of all columns; GROUPING SETS add them up, and ratios are formed last. ``level`` says how many
    of the columns a row is for; the others are null in it.
    """
    states = _direction_counts(truth, pred)
    fine = df.groupBy(*by).agg(*states)
    names = [c for c in fine.columns if c not in by]
    sets = [[F.col(c) for c in by[:k]] for k in range(len(by), -1, -1)]
    level = F.lit(len(by)) - F.bit_count(F.grouping_id())
    sums = fine.groupingSets(sets, *by).agg(level.cast("int").alias("level"), *[F.sum(c).alias(c) for c in names])
    return _direction_ratios(sums, [*by, "level"])


def _direction_ratios(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    c = F.col
    precision, recall = ratio(c("tp"), c("up")), ratio(c("tp"), c("pos"))
    return counts.select(
        *by,
        ratio(c("ok"), c("n")).alias("direction_accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        ratio(2 * c("tp"), c("up") + c("pos")).alias("f1_score"),
        ratio(c("tp"), c("up")).alias("up_accuracy"),
        ratio(c("tn"), c("down")).alias("down_accuracy"),
        c("n").alias("total_predictions"),
        c("up").alias("up_predictions"),
        c("down").alias("down_predictions"),
    )


def _errors(truth: str, pred: str) -> list[Column]:
    y, e = F.col(truth).cast("double"), F.col(truth).cast("double") - F.col(pred)
    mse, sst = F.avg(e * e), F.var_pop(y) * F.count(y)
    sse = F.sum(e * e)
    r2 = F.when(sst == 0, F.when(sse == 0, 1.0).otherwise(0.0)).otherwise(1 - F.try_divide(sse, sst))
    return [
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        r2.alias("r2_score"),
    ]


def _share(error: Column, base: Column) -> Column:
    """error / base with IEEE results where the base is zero."""
    return F.when(base == 0, F.when(error == 0, NAN).otherwise(INF)).otherwise(F.try_divide(error, base))


def regression_metrics(df: DataFrame, truth: str = "y_true", pred: str = "y_pred", by: Sequence[str] = ()) -> DataFrame:
    """mse, rmse, mae, r2, mape and smape in one pass."""
    y, p = F.col(truth).cast("double"), F.col(pred).cast("double")
    return df.groupBy(*by).agg(
        *_errors(truth, pred),
        (F.avg(_share(F.abs(y - p), F.abs(y))) * 100).alias("mape"),
        (F.avg(_share(2 * F.abs(y - p), F.abs(y) + F.abs(p))) * 100).alias("smape"),
    )


def price_direction_accuracy(
    df: DataFrame,
    order: str,
    truth: str = "y_true",
    pred: str = "y_pred",
    by: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Share of consecutive rows whose true and predicted changes are both rises or both not."""
    blocks = cut_blocks(df.select(*by, order, truth, pred), by, order, 1, 0, block_rows)
    w = blocks.window
    same = (F.col(truth) > F.lag(truth).over(w)) == (F.col(pred) > F.lag(pred).over(w))
    moves = blocks.with_columns({"_same": same}).result(keep=[ROW]).where(F.col(ROW) > 0)
    return moves.groupBy(*by).agg(F.avg(F.col("_same").cast("double")).alias("price_direction_accuracy"))


def _combine(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    if by:
        return left.join(right, list(by), "left")
    names = [c for c in right.columns]
    whole = right.agg(F.first(F.struct(*names)).alias("s")).scalar()
    return left.withColumn("_right", whole).select(*left.columns, *[F.col("_right")[n].alias(n) for n in names])


def price_metrics(
    df: DataFrame, order: str, truth: str = "y_true", pred: str = "y_pred", by: Sequence[str] = (), **kw
) -> DataFrame:
    return _combine(
        regression_metrics(df, truth, pred, by), price_direction_accuracy(df, order, truth, pred, by, **kw), by
    )


def volatility_levels(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """``<column>_level``: 2 above the 67th percentile, 1 above the 33rd, else 0, per column.

    The table is stored, as it is read for the percentiles and for the levels.
    """
    df = materialize(df)
    cuts = group_quantiles(df, columns, (0.33, 0.67), by, stored=True)
    joined = beside_groups(df, cuts, by) if by else _combine(df, cuts, by)
    levels = {
        f"{c}_level": F.when(F.col(c) > F.col(f"{c}_p67"), 2).when(F.col(c) > F.col(f"{c}_p33"), 1).otherwise(0)
        for c in columns
    }
    return joined.withColumns(levels).select(*df.columns, *levels)


def volatility_metrics(
    df: DataFrame,
    truth: str = "y_true",
    pred: str = "y_pred",
    by: Sequence[str] = (),
) -> DataFrame:
    leveled = volatility_levels(df, (truth, pred), by)
    agree = (F.col(f"{truth}_level") == F.col(f"{pred}_level")).cast("double")
    return leveled.groupBy(*by).agg(*_errors(truth, pred), F.avg(agree).alias("volatility_direction_accuracy"))


def _annualised(mean: Column, std: Column) -> Column:
    return F.when(std.isNull() | (std == 0), 0.0).otherwise(F.try_divide(mean, std) * F.sqrt(F.lit(TRADING_DAYS)))


def sharpe_ratio(df: DataFrame, returns: str = "ret", risk_free: float = 0.02, by: Sequence[str] = ()) -> DataFrame:
    r = F.col(returns)
    return df.groupBy(*by).agg(
        _annualised(F.avg(r - risk_free / TRADING_DAYS), F.stddev_pop(r)).alias("sharpe_ratio")
    )


def _compounded(df: DataFrame, order: str, returns: str, by: Sequence[str], block_rows: int) -> Blocks:
    """Rows with the product of 1 + return since the start of their block and its running maximum."""
    blocks = cut_blocks(df.select(*by, order, returns), by, order, 0, 0, block_rows)
    blocks = blocks.with_columns({"_grow": F.product(1 + F.col(returns)).over(blocks.so_far)})
    return blocks.with_columns({"_top": F.max("_grow").over(blocks.so_far)})


def _block_states(blocks: Blocks, by: Sequence[str], returns: str) -> DataFrame:
    """One row per block: the state of its drawdown, and with it the product ``_factor`` of all blocks before it
    and the highest cumulative value ``_high`` reached before it.

    The state merges: of two blocks one after the other, the product is that of both products, the highest value the larger of the
    first's and the second's times the first's product, and the deepest point the lowest of the first's own, the second's own, and
    the second's lowest value over the first's highest. A row's value over its peak is the smaller of its ratio to ``_high`` and
    its ratio to the peak inside the block, so the lowest value and the lowest inner ratio of a block say all about it.
    """
    inner = F.try_divide(F.col("_grow"), F.col("_top"))
    states = blocks.df.groupBy(*blocks.keys, BLOCK).agg(
        *[F.first(b).alias(b) for b in by],
        F.max_by("_grow", ROW).alias("_end"),
        F.max("_grow").alias("_max"),
        F.min(F.struct(F.col("_grow"), F.col(ROW))).alias("_low"),
        F.min(F.struct(inner.alias("q"), F.col(ROW), F.col("_top"))).alias("_worst"),
        F.sum(returns).alias("_sum"),
        F.count(returns).alias("_n"),
    )
    before = Window.partitionBy(*blocks.keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    states = states.withColumn("_factor", F.coalesce(F.product("_end").over(before), F.lit(1.0)))
    return states.withColumn("_high", F.max(F.col("_factor") * F.col("_max")).over(before))


def cumulative_returns(
    df: DataFrame, order: str, returns: str = "ret", by: Sequence[str] = (), block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Per row ``idx``, ``cumulative`` product of 1 + return, its running maximum ``peak`` and ``drawdown``.

    Both scans are running windows inside a block plus one value carried over from the blocks before, so
    no series has to fit in one task. A series in one block needs no carrying.
    """
    blocks = _compounded(df, order, returns, by, block_rows)
    if blocks.is_cut:
        states = _block_states(blocks, (), returns).select(*blocks.keys, BLOCK, "_factor", "_high")
        rows = blocks.df.join(states, [*blocks.keys, BLOCK])
        rows = rows.withColumn("cumulative", F.col("_factor") * F.col("_grow"))
        rows = rows.withColumn("peak", F.greatest(F.col("_factor") * F.col("_top"), "_high"))
    else:
        rows = blocks.df.withColumns({"cumulative": F.col("_grow"), "peak": F.col("_top")})
    drawdown = F.try_divide(F.col("cumulative") - F.col("peak"), F.col("peak"))
    return rows.select(*by, order, F.col(returns), F.col(ROW).alias("idx"), "cumulative", "peak", drawdown.alias("drawdown"))


def _deepest(states: DataFrame) -> Column:
    """(value over peak, row, peak) of a block's deepest point."""
    outer = F.when(
        F.col("_high").isNotNull(),
        F.struct(
            F.try_divide(F.col("_factor") * F.col("_low._grow"), F.col("_high")).alias("q"),
            F.col(f"_low.{ROW}").alias("row"),
            F.col("_high").alias("peak"),
        ),
    )
    inner = F.struct(
        F.col("_worst.q").alias("q"),
        F.col(f"_worst.{ROW}").alias("row"),
        (F.col("_factor") * F.col("_worst._top")).alias("peak"),
    )
    return F.least(outer, inner)


def max_drawdown(
    df: DataFrame, order: str, returns: str = "ret", by: Sequence[str] = (), block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Deepest drawdown, its first index, the first index that regains the peak, and the duration.

    The duration is null without recovery, and also when the recovery index is 0. A series in one block takes one
    aggregation: every row knows the next one at its peak. For a cut one the depth comes from the merged states of its
    blocks, and for the recovery only the rows of at most two blocks are looked at, as where a block first regains a
    given peak has no state of fixed size.
    """
    blocks = _compounded(df, order, returns, by, block_rows)
    found = _recovery_of_cut(blocks, by, returns) if blocks.is_cut else _recovery_of_whole(blocks, by)
    duration = F.when(F.col("recovery_idx") > 0, F.col("recovery_idx") - F.col("max_drawdown_idx"))
    return found.select(
        *by, "max_drawdown", "max_drawdown_idx", "recovery_idx", duration.alias("drawdown_duration")
    )


def _recovery_of_whole(blocks: Blocks, by: Sequence[str]) -> DataFrame:
    ahead = blocks.window.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = blocks.with_columns({"_back": F.min(F.when(F.col("_grow") >= F.col("_top"), F.col(ROW))).over(ahead)}).df
    q = F.try_divide(F.col("_grow"), F.col("_top"))
    worst = F.min(F.struct(q.alias("q"), F.col(ROW).alias("row"), F.col("_back").alias("back")))
    found = rows.groupBy(*blocks.keys).agg(*[F.first(b).alias(b) for b in by], worst.alias("_w"))
    return found.select(
        *by, (F.col("_w.q") - 1).alias("max_drawdown"), F.col("_w.row").alias("max_drawdown_idx"), F.col("_w.back").alias("recovery_idx")
    )


def _recovery_of_cut(blocks: Blocks, by: Sequence[str], returns: str) -> DataFrame:
    keys = blocks.keys
    states = _block_states(blocks, by, returns)
    series = Window.partitionBy(*keys)
    states = states.withColumn("_deep", _deepest(states))
    states = states.withColumn("_w", F.min(F.struct("_deep", BLOCK)).over(series))
    states = states.select(
        *keys, BLOCK, *by, "_factor", "_max", "_w._deep.q", "_w._deep.row", "_w._deep.peak", F.col(f"_w.{BLOCK}").alias("_at")
    )
    later = F.col(BLOCK) > F.col("_at")
    regains = later & (F.col("_factor") * F.col("_max") >= F.col("peak"))
    visits = states.withColumn("_next", F.min(F.when(regains, F.col(BLOCK))).over(series))
    visits = visits.where((F.col(BLOCK) == F.col("_at")) | (F.col(BLOCK) == F.col("_next")))
    seen = blocks.df.select(*keys, BLOCK, ROW, "_grow").join(
        visits.select(*keys, BLOCK, *by, "_factor", "q", "row", "peak"), [*keys, BLOCK]
    )
    back = (F.col(ROW) >= F.col("row")) & (F.col("_factor") * F.col("_grow") >= F.col("peak"))
    return seen.groupBy(*keys).agg(
        *[F.first(b).alias(b) for b in by],
        (F.first("q") - 1).alias("max_drawdown"),
        F.first("row").alias("max_drawdown_idx"),
        F.min(F.when(back, F.col(ROW))).alias("recovery_idx"),
    )


def calmar_ratio(
    df: DataFrame, order: str, returns: str = "ret", by: Sequence[str] = (), block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Annual mean return over the depth of the deepest drawdown, from block states alone."""
    blocks = _compounded(df, order, returns, by, block_rows)
    states = _block_states(blocks, by, returns)
    # Without ``by`` there is one series, and a row even if it is empty.
    keys = blocks.keys if by else ()
    found = states.withColumn("_deep", _deepest(states)).groupBy(*keys).agg(
        *[F.first(b).alias(b) for b in by],
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("m"), (F.min("_deep.q") - 1).alias("d"),
    )
    annual = F.col("m") * TRADING_DAYS
    value = (
        F.when(F.col("d").isNull(), 0.0)
        .when(F.col("d") == 0, F.when(annual > 0, INF).otherwise(0.0))
        .otherwise(F.try_divide(annual, F.abs("d")))
    )
    return found.select(*by, value.alias("calmar_ratio"))


def paired_returns(strategy: DataFrame, benchmark: DataFrame, on: Sequence[str]) -> DataFrame:
    """Join two return series on their time key. A row without a partner raises when the job runs."""
    left = strategy.withColumn("_left", F.lit(True))
    right = benchmark.withColumn("_right", F.lit(True))
    joined = left.join(right, list(on), "full")
    complete = F.when(F.col("_left") & F.col("_right"), True).otherwise(
        F.raise_error(F.lit("strategy and benchmark returns must cover the same rows")).cast("boolean")
    )
    return joined.where(complete).drop("_left", "_right")


def information_ratio(
    df: DataFrame, strategy: str = "ret", benchmark: str = "bench", by: Sequence[str] = ()
) -> DataFrame:
    d = F.col(strategy) - F.col(benchmark)
    return df.groupBy(*by).agg(_annualised(F.avg(d), F.stddev_pop(d)).alias("information_ratio"))


def hit_rate(
    df: DataFrame, truth: str = "y_true", pred: str = "y_pred", threshold: float = 0.0, by: Sequence[str] = ()
) -> DataFrame:
    hit = (F.abs(F.col(truth) - F.col(pred)) <= threshold).cast("double")
    return df.groupBy(*by).agg(F.coalesce(F.avg(hit), F.lit(0.0)).alias("hit_rate"))


def confidence_bin(confidence: Column, closed: str = "left") -> Column:
    """Bin 0..9 by the exact edges; ``left`` means [lo, hi), ``right`` means (lo, hi]. Else null."""
    out = F.lit(None).cast("int")
    for i in range(10):
        lo, hi = BIN_EDGES[i], BIN_EDGES[i + 1]
        inside = (
            (confidence >= lo) & (confidence < hi) if closed == "left" else (confidence > lo) & (confidence <= hi)
        )
        out = F.when(inside, i).otherwise(out)
    return out


def _bins(df: DataFrame, confidence: str, correct: Column, closed: str, by: Sequence[str]) -> DataFrame:
    """Per bin: accuracy, confidence and the sums needed for whole-set moments."""
    c = F.col(confidence).cast("double")
    return (
        df.select(*by, c.alias("_c"), correct.cast("double").alias("_ok"))
        .withColumn("bin", confidence_bin(F.col("_c"), closed))
        .groupBy(*by, "bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("_ok").alias("accuracy"),
            F.avg("_c").alias("confidence"),
            F.var_pop("_c").alias("var"),
            F.min("_c").alias("lo"),
            F.max("_c").alias("hi"),
        )
    )


def reliability_table(
    df: DataFrame,
    truth: str = "y_true",
    pred: str = "y_pred",
    confidence: str = "confidence",
    closed: str = "left",
    by: Sequence[str] = (),
) -> DataFrame:
    """Count, accuracy and mean confidence of every non-empty bin."""
    bins = _bins(df, confidence, F.col(truth) == F.col(pred), closed, by)
    return bins.where(F.col("bin").isNotNull()).select(*by, "bin", "n", "accuracy", "confidence")


def confidence_metrics(
    df: DataFrame,
    truth: str = "y_true",
    pred: str = "y_pred",
    confidence: str = "confidence",
    by: Sequence[str] = (),
) -> DataFrame:
    """Unweighted calibration error over the non-empty bins [lo, hi), and moments of the confidence."""
    bins = _bins(df, confidence, F.col(truth) == F.col(pred), "left", by)
    gap = F.when(F.col("bin").isNotNull(), F.abs(F.col("accuracy") - F.col("confidence")))
    n = F.sum("n")
    mean = F.sum(F.col("n") * F.col("confidence")) / n
    square = F.sum(F.col("n") * (F.col("var") + F.col("confidence") * F.col("confidence"))) / n
    return bins.groupBy(*by).agg(
        F.coalesce(F.avg(gap), F.lit(0.0)).alias("ece_unweighted"),
        mean.alias("average_confidence"),
        F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))).alias("confidence_std"),
        (F.max("hi") - F.min("lo")).alias("confidence_range"),
    )


def calibration(
    df: DataFrame, correct: Column, confidence: str = "confidence", by: Sequence[str] = ()
) -> DataFrame:
    """Calibration error weighted by bin share over bins (lo, hi], mean confidence and accuracy."""
    bins = _bins(df, confidence, correct, "right", by)
    n = F.sum("n")
    gap = F.when(F.col("bin").isNotNull(), F.abs(F.col("accuracy") - F.col("confidence")) * F.col("n"))
    return bins.groupBy(*by).agg(
        (F.coalesce(F.sum(gap), F.lit(0.0)) / n).alias("ece_weighted"),
        (F.sum(F.col("n") * F.col("confidence")) / n).alias("average_confidence"),
        (F.sum(F.col("n") * F.col("accuracy")) / n).alias("average_accuracy"),
    )


def argmax(scores: str | Column) -> Column:
    """Index of the first largest score."""
    s = _c(scores)
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")


def softmax_max(scores: str | Column, default: float = 0.5) -> Column:
    """Largest softmax probability; ``default`` where there are no scores."""
    s = _c(scores)
    top = F.array_max(s)
    total = F.aggregate(F.transform(s, lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x)
    return F.coalesce(F.try_divide(F.lit(1.0), total), F.lit(default))


def masked_accuracy(
    df: DataFrame, scores: str = "scores", label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    """Accuracy of the best class over rows whose label is not the ignored one."""
    used = F.col(label) != IGNORED_LABEL
    right = used & (argmax(scores) == F.col(label))
    return df.groupBy(*by).agg(
        ratio(F.count_if(right), F.count_if(used)).alias("accuracy"),
        F.count_if(right).alias("correct_predictions"),
        F.count_if(used).alias("total_predictions"),
    )


def score_calibration(
    df: DataFrame, scores: str = "scores", label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    used = df.where(F.col(label) != IGNORED_LABEL).withColumn("_conf", softmax_max(scores))
    return calibration(used, argmax(scores) == F.col(label), "_conf", by)


def label_agreement(df: DataFrame, direction: str = "direction", truth: str = "y_true", by: Sequence[str] = ()) -> DataFrame:
    """Agreement of parsed directions with 0/1 truth, counting UNKNOWN as down or as wrong."""
    d, y = F.col(direction), F.col(truth)
    as_down = F.when(d == "UP", 1).otherwise(0)
    strict = F.when(d == "UP", 1).when(d == "DOWN", 0)
    return df.groupBy(*by).agg(
        ratio(F.count_if(as_down == y), F.count(F.lit(1))).alias("unknown_as_down"),
        ratio(F.count_if(strict == y), F.count(F.lit(1))).alias("unknown_as_wrong"),
    )


def comprehensive_metrics(df: DataFrame, task: str = "direction", order: str | None = None, **kw) -> DataFrame:
    if task == "direction":
        return direction_accuracy(df, **kw)
    if task == "price":
        if order is None:
            raise ValueError("price metrics need an order column")
        return price_metrics(df, order, **kw)
    if task == "volatility":
        return volatility_metrics(df, **kw)
    raise ValueError(f"unknown task type: {task}")
