"""Join helpers: size-checked broadcast, unique lookups, semi-join restriction, salted join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side above this size is joined without a broadcast hint; the planner and AQE
# then choose from real sizes.
BROADCAST_BYTES = 64 * 1024 * 1024
TEXT_BYTES = 64  # taken for a string, binary or nested value


def row_bytes(df: DataFrame) -> int:
    """Bytes of a row in a broadcast relation, from the column types."""
    fixed = {"boolean": 8, "tinyint": 8, "smallint": 8, "int": 8, "bigint": 8, "float": 8, "double": 8, "date": 8,
             "timestamp": 8, "timestamp_ntz": 8}
    return 32 + sum(fixed.get(t, TEXT_BYTES) for _, t in df.dtypes)


def broadcast_rows(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> int:
    """How many rows of ``df`` fit into ``max_bytes``."""
    return max(1, max_bytes // row_bytes(df))


def bounded_broadcast(df: DataFrame, max_rows: int | None = None, known_rows: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` is proven to hold at most ``max_rows`` rows
    (default: what fits into ``BROADCAST_BYTES``).

    ``known_rows`` is an upper bound the caller already has by construction
    (a request list of known length); otherwise the check reads at most
    ``max_rows + 1`` rows. Beyond the bound the frame is returned as it is,
    so Spark falls back to a shuffled join.
    """
    most = broadcast_rows(df) if max_rows is None else max_rows
    n = known_rows if known_rows is not None else df.limit(most + 1).count()
    return F.broadcast(df) if n <= most else df


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """Whether ``df`` holds at most ``max_rows`` rows (default: what fits into
    ``BROADCAST_BYTES``); reads at most one row more."""
    most = broadcast_rows(df) if max_rows is None else max_rows
    return df.limit(most + 1).count() <= most


def unique_by_key(lookup: DataFrame, key: str = "code", value: str = "description") -> DataFrame:
    """One row per key (the smallest value), so a repeated code cannot multiply
    the rows of a join."""
    return lookup.groupBy(key).agg(F.min(value).alias(value))


def restrict_to(
    df: DataFrame,
    allowed: DataFrame,
    on: list[str],
    max_rows: int | None = None,
    known_rows: int | None = None,
) -> DataFrame:
    """Rows of ``df`` whose ``on`` columns match a row of ``allowed`` (left semi
    join). ``allowed`` is a request table, broadcast when its size is proven
    small, so the large side is filtered where it is read, without a shuffle."""
    return df.join(bounded_broadcast(allowed, max_rows, known_rows), on, "left_semi")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: list,
    right_keys: list[str],
    how: str = "left",
    buckets: int | None = None,
) -> DataFrame:
    """Equi-join where one key of ``left`` may hold a large share of its rows.

    Each left row gets a salt from a hash of its content (deterministic, so a
    retried task sends every row to the same place), and each right row is
    repeated once per salt value. A hot key is then split over ``buckets``
    tasks; ``right`` grows ``buckets`` times, so it should be the per-key side
    (one row per key). ``buckets`` defaults to the number of shuffle partitions,
    so a hot key spreads over the whole cluster. ``left_keys`` are columns or
    expressions matched in order to ``right_keys``.
    """
    buckets = buckets or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(buckets))
    salted_left = left.withColumn("_salt", salt)
    salted_right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    cond = salted_left["_salt"] == salted_right["_salt"]
    for lk, rk in zip(left_keys, right_keys):
        lcol = salted_left[lk] if isinstance(lk, str) else lk
        cond = cond & (lcol == salted_right[rk])
    return salted_left.join(salted_right, cond, how).drop(salted_left["_salt"]).drop(salted_right["_salt"])


def lookup_left_join(
    left: DataFrame,
    lookup: DataFrame,
    left_key,
    lookup_key: str,
    max_rows: int | None = None,
    buckets: int | None = None,
    fits: bool | None = None,
) -> DataFrame:
    """Left join to a lookup that is unique by ``lookup_key``.

    The lookup is broadcast when a bounded count proves it small (the usual
    case: airports and airlines); otherwise the join is salted, so a hot key
    of ``left`` (a hub airport) is still spread over ``buckets`` tasks.
    ``fits`` passes the result of an earlier check of the same lookup.
    """
    if fits is None:
        fits = fits_broadcast(lookup, max_rows)
    lcol = left[left_key] if isinstance(left_key, str) else left_key
    if fits:
        return left.join(F.broadcast(lookup), lcol == lookup[lookup_key], "left")
    return salted_join(left, lookup, [left_key], [lookup_key], "left", buckets)
