"""Per-group ordered lists and their text form.

Lists are only built after a top-k, so each collected group holds at most k
entries: nothing unbounded is gathered into one row or task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.scalars import named_value, pair_text


def ranked_list(
    df: DataFrame, group: list[str], rank_col: str, fields: list[str], alias: str = "entries"
) -> DataFrame:
    """One row per group with ``array<struct<rank, fields...>>`` sorted by rank."""
    item = F.struct(F.col(rank_col).alias("rank"), *[F.col(f) for f in fields])
    return df.groupBy(*group).agg(F.array_sort(F.collect_list(item)).alias(alias))


def list_text(entries: str | Column, name: str, value: str) -> Column:
    """``name(value) name(value) ...`` from a ranked list column."""
    arr = F.col(entries) if isinstance(entries, str) else entries
    return F.concat_ws(" ", F.transform(arr, lambda e: named_value(e[name], e[value])))


def ranked_text(
    df: DataFrame, group: list[str], rank_col: str, name: str, value: str, alias: str = "text"
) -> DataFrame:
    """One row per group: ``name(value) name(value) ...`` in rank order."""
    listed = ranked_list(df, group, rank_col, [name, value], alias="_entries")
    return listed.select(*group, list_text("_entries", name, value).alias(alias))


def pairs_text(entries: str | Column, first: str, second: str) -> Column:
    """``[(first, second), (first, second)]`` from a ranked list column (the
    text of an ordered set of pairs, numbers as Java prints doubles)."""
    arr = F.col(entries) if isinstance(entries, str) else entries
    inner = F.concat_ws(", ", F.transform(arr, lambda e: pair_text(e[first], e[second])))
    return F.concat(F.lit("["), inner, F.lit("]"))
