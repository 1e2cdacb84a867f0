"""Ordered operators over series of any length.

A window partitioned by ``symbol`` alone puts the whole history of one symbol into one task. Here a
series is cut into blocks of about ``block_rows`` consecutive rows, and a block also receives copies
of the rows just before and after it (its halo), so that framed windows and leads give
on every block the values they give on the whole series; recurrences hand on a state instead (``scan``). The cut needs exact row numbers; they come
from row counts per time bucket, a table far smaller than the data:

1. where a series is longer than a block, count rows per ``(key, bucket)`` (map-side combined),
2. for such series, running sums of those counts give each bucket's first row number
   and thus its blocks; a shorter series is one block and needs no routing,
3. join the routing to the rows on ``(key, bucket)`` and shuffle once on ``(key, block)``.

Steps 1 and 2 can also carry per-bucket aggregates forward (last non-null value, running product),
which replaces an unbounded look-back.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from barflow.session import materialize

BLOCK_ROWS = 65_536
INTEGER_BUCKET_ROWS = 32_768
UNROUTED_ROWS = 1 << 60
#: Rows that a task sorts: where the session's shuffle partitions would hold more on average, there are more of them.
SORTED_ROWS = 1 << 19
#: Routes that Spark may send to all tasks; for more of them the rows are shuffled too, to be joined.
SENT_ROUTES = 100_000
ALL_KEY = "_series"
RUN, BLOCK, ROW, CORE = "_run", "_blk", "_rn", "_core"

Carry = tuple[Column, Callable[[Column, WindowSpec], Column]]


def default_bucket(df: DataFrame, order: str) -> Column:
    """Monotone coarse bucket of the order key: month of a date, day of a timestamp, id range.

    With (key, order) unique a bucket holds at most 31 daily bars, 86,400 one-second bars or
    ``INTEGER_BUCKET_ROWS`` ids. Pass ``bucket=`` for finer data.
    """
    kind = df.schema[order].dataType
    if isinstance(kind, T.DateType):
        return F.year(order) * 12 + F.month(order)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(order)
    if isinstance(kind, T.IntegralType):
        return F.expr(f"`{order}` div {INTEGER_BUCKET_ROWS}")
    raise ValueError(f"no default bucket for {order}: {kind.simpleString()}; pass bucket=")


@dataclass(frozen=True)
class Blocks:
    """A series cut into blocks: ``df`` has the block id, the global row number and a core flag."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    added: tuple[str, ...]
    is_cut: bool = True

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, BLOCK).orderBy(*self.order)

    def rows(self, start: int, end: int) -> WindowSpec:
        return self.window.rowsBetween(start, end)

    @property
    def so_far(self) -> WindowSpec:
        return self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def with_columns(self, columns: dict[str, Column]) -> "Blocks":
        return replace(self, df=self.df.withColumns(columns)) if columns else self

    def temporaries(self, *names: str) -> "Blocks":
        return replace(self, added=self.added + names)

    def result(self, keep: Sequence[str] = ()) -> DataFrame:
        """Own rows of every block without the helper columns."""
        return self.df.where(CORE).drop(*[c for c in self.added if c not in keep])


def key_text(keys: Sequence[str]) -> Column:
    """The key of a series as one text that is never null, so that joins on it need no null-safe comparison."""
    parts = [F.coalesce(F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")), F.lit("-")) for k in keys]
    return F.concat(*parts) if parts else F.lit("")


def dealt(rows: DataFrame, n: int | None, *keys: str) -> DataFrame:
    """``rows``, ``n`` of them, dealt by ``keys`` to more tasks than the session's if those would have to sort too many rows each."""
    tasks = -(-(n or 0) // SORTED_ROWS)
    return rows.repartition(tasks, *keys) if tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows


def cut_blocks(
    df: DataFrame,
    by: Sequence[str],
    order: str | Sequence[str],
    lookback: int = 0,
    lookahead: int = 0,
    block_rows: int = BLOCK_ROWS,
    bucket: Column | str | None = None,
    carries: dict[str, Carry] | None = None,
) -> Blocks:
    """Cut every series of ``df`` into blocks with ``lookback``/``lookahead`` halo rows.

    ``order`` must be unique within a key. ``bucket`` (a column or SQL expression) is monotone in the
    order key and coarse enough to count by, fine enough to hold few rows. ``carries`` maps a name to a bucket aggregate and a
    function giving its prefix over the buckets before; each row gets the prefix of its bucket.

    Series are counted first, at once; where none is longer than a block there is nothing to route and no bucket is counted.
    """
    order = (order,) if isinstance(order, str) else tuple(order)
    carries = carries or {}
    rows = (df if by else df.withColumn(ALL_KEY, F.lit(0))).withColumn(RUN, key_text(by))
    if bucket is None:
        bucket = default_bucket(df, order[0])
    rows = rows.withColumn("_bucket", F.expr(bucket) if isinstance(bucket, str) else bucket)

    counts = rows.groupBy(RUN, "_bucket").agg(F.count(F.lit(1)).alias("_n"), *[agg.alias(name) for name, (agg, _) in carries.items()])
    per_key = Window.partitionBy(RUN)
    long_series = counts.withColumns(
        {
            "_total": F.sum("_n").over(per_key),
            "_size": F.greatest(F.lit(block_rows), F.max("_n").over(per_key)).cast("bigint"),
        }
    ).where(F.col("_total") > F.col("_size"))
    before = per_key.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    spans = long_series.select(
        RUN,
        "_bucket",
        "_n",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        "_total",
        "_size",
        *[prefix(F.col(name), before).alias(name) for name, (_, prefix) in carries.items()],
    )
    first = F.expr(f"greatest(_start - {lookahead}, 0) div _size")
    last = F.expr(f"least(_total - 1, _start + _n - 1 + {lookback}) div _size")
    routed = spans.withColumn("_to", F.explode(F.sequence(first, last)))
    routed = routed.select(
        F.col(RUN).alias("_to_run"),
        F.col("_bucket").alias("_to_bucket"),
        "_to",
        F.col("_size").alias("_to_size"),
        F.min("_start").over(Window.partitionBy(RUN, "_to")).alias("_base"),
        *carries,
    )
    helpers = (RUN, BLOCK, ROW, CORE, *carries) + (() if by else (ALL_KEY,))
    totals = rows.groupBy(RUN).agg(F.count(F.lit(1)).alias("_n"))
    n, longest = totals.agg(F.sum("_n"), F.max("_n")).first()
    routes = 0
    if (longest or 0) > block_rows:
        routed = materialize(routed)
        routes = routed.count()
    is_cut = routes > 0
    if not is_cut:
        alone = Window.partitionBy(RUN, BLOCK).orderBy(*order)
        whole = dealt(rows.drop("_bucket"), n, RUN).withColumn(BLOCK, F.lit(0).cast("bigint"))
        nothing = {name: F.lit(None).cast(routed.schema[name].dataType) for name in carries}
        whole = whole.withColumns({ROW: F.row_number().over(alone).cast("bigint") - 1, CORE: F.lit(True), **nothing})
        return Blocks(whole, (RUN,), order, helpers, is_cut)

    # Buckets as texts that are never null: a plain equality keeps to the tasks that the rows are dealt to.
    rows = rows.withColumn("_spot", F.coalesce(F.col("_bucket").cast("string"), F.lit("")))
    routed = routed.withColumn("_to_spot", F.coalesce(F.col("_to_bucket").cast("string"), F.lit("")))
    if routes > SENT_ROUTES:
        rows = dealt(rows, n, RUN, "_spot")
    joined = rows.join(routed, (F.col(RUN) == F.col("_to_run")) & (F.col("_spot") == F.col("_to_spot")), "left").withColumns(
        {
            BLOCK: F.coalesce("_to", F.lit(0)),
            "_size": F.coalesce("_to_size", F.lit(UNROUTED_ROWS)),
            "_base": F.coalesce("_base", F.lit(0)),
        }
    )
    joined = dealt(joined.drop("_bucket", "_to_bucket", "_spot", "_to_spot", "_to", "_to_size", "_to_run"), n, RUN, BLOCK)
    numbered = joined.withColumn(
        ROW, F.col("_base") + F.row_number().over(Window.partitionBy(RUN, BLOCK).orderBy(*order)) - 1
    )
    low = F.col(BLOCK) * F.col("_size")
    end = low + F.col("_size")
    numbered = numbered.withColumn(CORE, (F.col(ROW) >= low) & (F.col(ROW) < end))
    if not carries:  # a carried value is right only behind the whole bucket
        numbered = numbered.where((F.col(ROW) >= low - lookback) & (F.col(ROW) < end + lookahead))
    return Blocks(numbered.drop("_size", "_base"), (RUN,), order, helpers, is_cut)
