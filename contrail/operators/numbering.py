"""Positions in a full order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.operators.rank import OrderSpec, _order
from contrail.session import scratch_path
from contrail.sinks.files import materialize

_WITHIN = (1 << 33) - 1  # the part of a monotonically increasing id that counts inside a partition


def with_position(df: DataFrame, order: OrderSpec, name: str = "position") -> DataFrame:
    """``df`` with every row's place, from 1, in the full ``order`` (which should leave no ties).

    The rows are sorted into ranges, one a partition, and written with their partition and
    their number in it; a partition starts after all rows of the ones before it, found from
    the row counts (one row per partition). Nothing else crosses partitions.
    """
    if {name, "_part", "_within"} & set(df.columns):
        raise ValueError(f"the columns {name}, _part and _within are made here")
    spark = df.sparkSession
    placed = df.orderBy(*_order(order)).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN)).alias("_within")
    )
    written = materialize(placed, scratch_path(spark, "positions"))
    counts = written.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = counts.select(F.col("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    joined = written.join(F.broadcast(starts), "_part")
    return joined.select(*df.columns, (F.col("_start") + F.col("_within") + 1).alias(name))
