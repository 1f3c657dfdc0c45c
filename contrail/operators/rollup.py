"""A mergeable rollup of flights, from which several questions are answered with one scan.

One row per key (origin, destination, carrier, and the day if asked for) holds the counts and exact
sums that the questions need. Rollups of different flights are merged by adding them up, so a
new day's flights need not touch the old ones. The rules on missing fields and cancelled
flights are those of :mod:`contrail.plans.questions`, applied while the flights are counted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.scalars import is_cancelled, round_half_up
from contrail.operators.aggregates import mean_of_parts, merged_parts, sum_parts
from contrail.operators.filters import has_value, require
from contrail.operators.rank import best_k, top_n, worst_k
from contrail.schemas import CLEAN_COLUMNS

BY_DAY = ("origin", "dest", "carrier", "flight_date")
BY_ROUTE = ("origin", "dest", "carrier")
# arr: arrival delays; arr2: the same, each rounded first; dep: departure delays; flown: those not cancelled.
MEASURES = ("arr", "arr2", "dep", "flown")


def _holds(flights: DataFrame, n: int) -> Column:
    """At least ``n`` fields once trailing empty ones are cut."""
    return reduce(lambda a, b: a | b, [has_value(flights, c) for c in CLEAN_COLUMNS[n - 1 :]])


def rollup(flights: DataFrame, by: tuple[str, ...] = BY_DAY) -> DataFrame:
    """Counts and sums of ``flights`` per ``by``."""
    nine, eight = _holds(flights, 9), _holds(flights, 8)
    arr, dep = F.when(nine, F.col("arr_delay")), F.when(eight, F.col("dep_delay"))
    return flights.groupBy(*by).agg(
        F.count(F.when(nine, 1)).alias("flights"),
        *sum_parts(arr, "arr"),
        *sum_parts(round_half_up(arr), "arr2"),
        *sum_parts(dep, "dep"),
        *sum_parts(F.when(~is_cancelled(), dep), "flown"),
    )


def merge(*rollups: DataFrame, by: tuple[str, ...] = BY_DAY) -> DataFrame:
    """Rollups of different flights as one; also takes a rollup to fewer keys."""
    rows = reduce(DataFrame.unionByName, rollups)
    return rows.groupBy(*by).agg(F.sum("flights").alias("flights"), *[c for m in MEASURES for c in merged_parts(m)])


def _means(rolled: DataFrame, by: list[str], measure: str, digits: int | None) -> DataFrame:
    parts = require(rolled, *by).groupBy(*by).agg(*merged_parts(measure)).filter(F.col(f"{measure}_n") > 0)
    return parts.select(*by, mean_of_parts(measure, digits).alias("delay"))


def traffic(rolled: DataFrame) -> DataFrame:
    both = require(rolled.filter("flights > 0"), "origin", "dest")
    ends = both.select(F.explode(F.array("origin", "dest")).alias("airport"), "flights")
    return ends.groupBy("airport").agg(F.sum("flights").alias("flights"))


def answer_from_rollup(qid: str, rolled: DataFrame, n: int | None = 10) -> DataFrame:
    """The answer of a question from a rollup, equal to the one from the flights."""
    k = n or 10
    if qid in ("1-1", "3-1"):
        return top_n(traffic(rolled), [("flights", False), ("airport", False)], n if qid == "1-1" else None)
    if qid == "1-2":
        means = _means(rolled, ["carrier"], "arr2", None).withColumnRenamed("carrier", "airline")
        return top_n(means, [("delay", True), ("airline", True)], n)
    if qid == "2-1":
        return best_k(_means(rolled, ["origin", "carrier"], "flown", 2), ["origin"], "delay", "carrier", k)
    if qid == "2-2":
        return best_k(_means(rolled, ["origin", "dest"], "dep", 2), ["origin"], "delay", "dest", k)
    if qid == "2-2-worst":
        ranked = worst_k(_means(rolled, ["origin", "dest"], "dep", None), ["origin"], "delay", "dest", k)
        return ranked.withColumn("delay", round_half_up("delay"))
    if qid == "2-4":
        return _means(rolled, ["origin", "dest"], "arr", 2)
    raise ValueError(f"{qid} is not answered from a rollup")


ROLLUP_IDS = ("1-1", "1-2", "2-1", "2-2", "2-2-worst", "2-4", "3-1")
