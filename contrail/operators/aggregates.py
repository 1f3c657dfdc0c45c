"""Aggregates: traffic counts, means, minima.

Each one is a single ``groupBy().agg()``: Spark plans a partial aggregate
before the shuffle and a final one after it, so a hot key (a hub airport with
a third of all flights) reaches the exchange as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.scalars import round_half_up


def endpoint_counts(
    df: DataFrame, ends: tuple[str, ...] = ("origin", "dest"), key: str = "airport", count: str = "flights"
) -> DataFrame:
    """Flights in plus out per airport: each row counts once for each end.

    ``explode`` of an array of the ends reads the input once (rather than a
    union of two projections), and the partial count runs in the same stage.
    """
    return (
        df.select(F.explode(F.array(*[F.col(e) for e in ends])).alias(key))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias(count))
    )


# Delays are summed as whole numbers of 1 / EXACT_SCALE, in two parts of which neither can leave
# a long, so the sum of a group is the same in whatever order its rows come. A value that is not finite,
# or beyond EXACT_MOST, is summed as a double.
EXACT_SCALE = 1_000_000
EXACT_MOST = 1e12
EXACT_PART = 1 << 20
SUM_PARTS = ("hi", "lo", "n", "odd")


def sum_parts(value: Column, name: str) -> list[Column]:
    """Aggregates ``<name>_hi, _lo, _n, _odd`` of the values that are not null: mergeable parts of an exact sum."""
    usual = F.abs(value) <= EXACT_MOST
    whole = F.when(usual, F.floor(value * EXACT_SCALE + F.lit(0.5)))
    return [
        F.sum(F.shiftright(whole, 20)).alias(f"{name}_hi"),
        F.sum(whole.bitwiseAND(F.lit(EXACT_PART - 1).cast("long"))).alias(f"{name}_lo"),
        F.count(value).alias(f"{name}_n"),
        F.sum(F.when(~usual, value)).alias(f"{name}_odd"),
    ]


def merged_parts(name: str) -> list[Column]:
    """Aggregates that merge the parts of several groups."""
    return [F.sum(f"{name}_{p}").alias(f"{name}_{p}") for p in SUM_PARTS]


def sum_of_parts(name: str) -> Column:
    """The sum that the parts hold, rounded once; null if there is no value."""
    whole = (F.coalesce(F.col(f"{name}_hi"), F.lit(0)).cast("double") * EXACT_PART + F.coalesce(F.col(f"{name}_lo"), F.lit(0))) / EXACT_SCALE
    return F.when(F.col(f"{name}_n") > 0, whole + F.coalesce(F.col(f"{name}_odd"), F.lit(0.0)))


def mean_of_parts(name: str, digits: int | None = None) -> Column:
    """The mean that the parts hold; null if there is no value."""
    mean = F.when(F.col(f"{name}_n") > 0, sum_of_parts(name) / F.col(f"{name}_n"))
    return mean if digits is None else round_half_up(mean, digits)


def mean_by(
    df: DataFrame,
    keys: list[str] | tuple[str, ...],
    value: str | Column,
    alias: str = "delay",
    digits: int | None = None,
) -> DataFrame:
    """Mean of ``value`` per key; rounded half-up to ``digits`` when given. The sum is exact for
    values of up to six decimals, so the mean doesn't depend on how the rows are partitioned."""
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*keys).agg(*sum_parts(v, "_v")).select(*keys, mean_of_parts("_v", digits).alias(alias))
