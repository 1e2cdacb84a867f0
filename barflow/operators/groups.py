"""Values of groups beside the rows of the groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.operators.series import key_text
from barflow.session import materialize

#: Groups that are sent to every executor at most.
BROADCAST_GROUPS = 200_000


def beside_groups(rows: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """``rows`` with the columns of ``groups``, which has at most one row for a key; null keys are a group like any other.

    The groups are stored and counted. Up to ``BROADCAST_GROUPS`` of them are broadcast, so the rows stay where they are,
    whatever one key holds. More of them are joined by key, and adaptive execution splits the partition of a key with many rows.
    """
    by = list(by)
    rest = [c for c in groups.columns if c not in by]
    small = materialize(groups.select(key_text(by).alias("_group"), *rest))
    side = F.broadcast(small) if small.count() <= BROADCAST_GROUPS else small
    return rows.withColumn("_group", key_text(by)).join(side, "_group", "left").drop("_group")
