"""Ordered cut-offs: global top-N and per-group top-k with tie-keeping ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def top_n(df: DataFrame, order_by: str, n: int, fill=None,
          tie_breakers: Sequence[str | Column] = ()) -> DataFrame:
    """The ``n`` rows with the largest ``order_by``.

    ``fill`` replaces a null ``order_by`` first (so nulls rank as that value).
    ``tie_breakers`` (ascending) make the cut deterministic. Plans as
    ``TakeOrderedAndProject``: each task keeps its own top ``n``, one task
    merges them - never a full sort.
    """
    if fill is not None:
        df = df.withColumn(order_by, F.coalesce(F.col(order_by), F.lit(fill)))
    return df.orderBy(F.col(order_by).desc(), *_cols(tie_breakers)).limit(n)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """Rows ranked ``<= k`` within each group by ``order`` (``rank()``: full ties
    share a rank, so a group can return more than ``k`` rows; ranks skip).

    The rank filter sits right on the window, so Catalyst inserts a partial
    ``WindowGroupLimit`` before the shuffle: each map task forwards at most its
    own top-k (plus ties) per group, and a group holding most of the rows never
    reaches one task whole.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.rank().over(w)).filter(F.col(rank_col) <= k)
