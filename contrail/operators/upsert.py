"""Keyed upsert: the whole row of a key is replaced by the update for that key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(updates: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One update per key: the row with the smallest ``order`` values, nulls last
    (then the smallest other values, so the choice is always the same).

    A ``min`` over a struct is a partial aggregate, so a key with very many
    updates is reduced before the shuffle.
    """
    order = order or []
    ranked = order + [c for c in updates.columns if c not in keys and c not in order]
    fields = [x for c in ranked for x in (F.col(c).isNull().alias(f"_null_{c}"), F.col(c))]
    packed = F.struct(*(fields or [F.lit(0).alias("_none")])).alias("_row")
    return updates.groupBy(*keys).agg(F.min(packed).alias("_row")).select(
        *keys, *[F.col(f"_row.{c}").alias(c) for c in updates.columns if c not in keys]
    ).select(*updates.columns)


def upsert(current: DataFrame, updates: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Rows of ``current`` whose key has no update, plus the updates.

    Several updates for one key collapse to the smallest by ``order`` (and the
    other columns) first: the serving table keeps one item per key.
    """
    updates = first_per_key(updates, keys, order)
    kept = current.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(updates.select(*current.columns))
