"""Ordering, global top-n and per-group top-k.

* ``top_n`` is ``orderBy().limit(n)``: Spark plans ``TakeOrderedAndProject``,
  a per-partition bounded heap followed by a merge of at most n rows per task.
* ``top_k_per_group`` is ``row_number() <= k`` over a window: Spark inserts a
  ``WindowGroupLimit`` before the shuffle, so each task sends at most k rows
  per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OrderSpec = list[tuple[str, bool]]  # (column, ascending)


def _order(spec: OrderSpec) -> list[Column]:
    return [F.col(c).asc() if asc else F.col(c).desc() for c, asc in spec]


def top_n(df: DataFrame, order: OrderSpec, n: int | None) -> DataFrame:
    """The first ``n`` rows by ``order``; ``n=None`` gives the whole order."""
    ordered = df.orderBy(*_order(order))
    return ordered if n is None else ordered.limit(n)


def top_k_per_group(
    df: DataFrame,
    group: list[str] | tuple[str, ...],
    order: OrderSpec,
    k: int,
    rank_col: str = "rank",
) -> DataFrame:
    """Up to ``k`` rows per group, numbered 1..k in ``order``."""
    w = Window.partitionBy(*group).orderBy(*_order(order))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def best_k(df: DataFrame, group: list[str], value: str, name: str, k: int = 10, rank_col: str = "rank") -> DataFrame:
    """The ``k`` smallest ``(value, name)`` pairs per group."""
    return top_k_per_group(df, group, [(value, True), (name, True)], k, rank_col)


def worst_k(df: DataFrame, group: list[str], value: str, name: str, k: int = 10, rank_col: str = "rank") -> DataFrame:
    """The ``k`` largest ``(value, name)`` pairs per group; rank 1 is the largest."""
    return top_k_per_group(df, group, [(value, False), (name, False)], k, rank_col)
