"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def whole(text: Column) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(text, F.lit(""))


def column(df: DataFrame, name: str) -> Column:
    """A column by its literal name, dots included."""
    return df["`" + name.replace("`", "``") + "`"]


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that no other column can clash with an operator's own names."""
    return df.select(*[column(df, n) for n in names])


def free_name(df: DataFrame, wish: str, also: Sequence[str] = ()) -> str:
    """``wish``, with underscores in front until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in [*df.columns, *also]}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def put(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns; they replace columns of the same name in any case."""
    gone = {n.lower() for n in columns}
    return df.select(
        *[column(df, c) for c in df.columns if c.lower() not in gone],
        *[c.alias(n) for n, c in columns.items()],
    )


#: A key is hot when it holds more than one part in this many of the rows; there are fewer such keys than that.
HOT_SHARE = 10_000


def lookup(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """``left`` with the columns of ``right``, which has at most one row for a key, however unevenly the keys of ``left`` lie.

    Keys that hold more than one part in ``HOT_SHARE`` of the left rows, fewer than ``HOT_SHARE`` of them, meet their right
    rows by broadcast, the others by a shuffle. ``left`` is read three times, so it should be a stored table. Null keys match nothing.
    """
    keyed = left.filter(F.col(on).isNotNull())
    counts = keyed.groupBy(on).agg(F.count(F.lit(1)).alias("_rows"))
    total = keyed.agg(F.count(F.lit(1)).alias("_all"))
    hot = counts.filter(F.col("_rows") * HOT_SHARE > total.scalar()).select(on)
    here = F.broadcast(right.join(F.broadcast(hot), on, "left_semi"))
    often = left.join(F.broadcast(hot), on, "left_semi").join(here, on, how)
    rest = left.join(F.broadcast(hot), on, "left_anti").join(right, on, how)
    return often.unionByName(rest)
