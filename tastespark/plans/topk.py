"""Top-k per group.

``row_number() <= k`` over a window is planned by Catalyst with a partial
``WindowGroupLimit`` on the map side of the shuffle, so at most k rows per
group and map task are shuffled: a group holding a third of all rows costs
k x (map tasks) rows in its final task, never the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column],
                    k: int | None, rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of each group in ``order`` (ties must be broken
    by the caller's order); ``k=None`` ranks every row."""
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w))
    if k is not None:
        ranked = ranked.filter(F.col(rank_col) <= k)
    return ranked
