"""Filters of a large table made at run time from a table of wanted keys.

The wanted keys stay a DataFrame of any size: what the filter needs of them is a
scalar subquery, which Spark runs before the scan it filters, so building a plan
starts no job.

* :func:`within_range` compares a column with the least and greatest wanted value. The
  comparison reaches the scan (``PushedFilters``), where Parquet skips row groups by their
  statistics; on a directory column it is a partition filter, and directories are not read.
* :func:`maybe_wanted` tests a Bloom filter of the wanted keys: an array of 64-bit words,
  built by aggregates and read by bit tests inside generated code. It lets through every wanted
  key and a small share of the others, so a join that follows shuffles little else.
* :func:`computed_once` lets a query use a small computed table in several places at the
  price of one.
* :func:`semi_join` puts both ahead of a left semi join, which makes the result exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A Bloom filter of 2^20 bits (128 KB as an array of longs) lets through about 4 % at 100,000
# wanted keys and 0.04 % at 10,000; more keys only make it less selective.
BLOOM_BITS = 1 << 20
HASHES = 2


def within_range(df: DataFrame, column: Column, wanted: DataFrame, value: Column, end: Column | None = None) -> DataFrame:
    """Rows of ``df`` whose ``column`` lies between the least and greatest ``value`` of
    ``wanted`` (of the same type; no rows if there is none). With ``end``, an expression on
    ``wanted`` too, the column must be below the greatest ``end`` instead."""
    low = wanted.select(value.alias("v")).filter(F.col("v").isNotNull())
    high = low if end is None else wanted.select(end.alias("v")).filter(F.col("v").isNotNull())
    # Two single-row sorts, not min and max: those would be merged into one subquery with two
    # fields, and a field of a subquery is not pushed into a scan.
    least = low.orderBy(F.asc("v")).limit(1).scalar()
    most = high.orderBy(F.desc("v")).limit(1).scalar()
    return df.filter((column >= least) & (column <= most if end is None else column < most))


def positions(keys: list[Column], bits: int) -> list[Column]:
    """The bits of a key, one per hash function."""
    return [F.pmod(F.xxhash64(*keys, F.lit(i)), F.lit(bits).cast("long")) for i in range(HASHES)]


def bloom_words(wanted: DataFrame, keys: list[Column], bits: int) -> DataFrame:
    """One row: the Bloom filter of the keys as an array of ``bits`` / 64 longs."""
    one = F.lit(1).cast("long")
    at = wanted.select(F.explode(F.array(*positions(keys, bits))).alias("p"))
    held = at.select(
        F.shiftright("p", 6).alias("w"), F.call_function("shiftleft", one, F.col("p").bitwiseAND(F.lit(63).cast("long")).cast("int")).alias("b")
    )
    empty = wanted.sparkSession.range(0, bits // 64, 1, 1).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("b"))
    words = held.groupBy("w").agg(F.bit_or("b").alias("b")).unionByName(empty).groupBy("w").agg(F.bit_or("b").alias("b"))
    return words.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "b"))), lambda x: x["b"]).alias("words"))


def maybe_wanted(df: DataFrame, keys: list[Column], wanted: DataFrame, wanted_keys: list[Column], bits: int = BLOOM_BITS) -> DataFrame:
    """Rows of ``df`` whose keys pass the Bloom filter of ``wanted`` (all that are wanted, few others).
    The key types must be the same on both sides."""
    words = bloom_words(wanted, wanted_keys, bits).scalar()
    passes = F.lit(True)
    for p in positions(keys, bits):
        word = F.get(words, F.shiftright(p, 6).cast("int"))
        passes = passes & (F.getbit(word, p.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1)
    return df.filter(passes)


def semi_join(
    df: DataFrame, wanted: DataFrame, on: list[str] | dict[str, Column], known_rows: int | None = None, bits: int = BLOOM_BITS
) -> DataFrame:
    """Rows of ``df`` whose ``on`` columns are in ``wanted``; starts no job. ``on`` names columns of
    both, or gives the expression on ``df`` for each column of ``wanted``.

    ``known_rows`` bounds ``wanted`` by construction; it is then broadcast, which filters
    ``df`` where it is read. Otherwise ``df`` passes the Bloom filter first, and what is
    left is joined as Spark finds best from the sizes at run time.
    """
    keys = on if isinstance(on, dict) else {c: F.col(c) for c in on}
    asked = wanted.select(*[F.col(c).alias(f"_wanted_{c}") for c in keys])
    same = [k == asked[f"_wanted_{c}"] for c, k in keys.items()]
    if known_rows is not None:
        return df.join(F.broadcast(asked), same, "left_semi")
    few = maybe_wanted(df, list(keys.values()), wanted, [F.col(c) for c in keys], bits)
    return few.join(asked.distinct(), same, "left_semi")  # a key wanted very often is one row


def computed_once(df: DataFrame) -> DataFrame:
    """``df``, of a few rows by construction, as a relation that a query computes once however
    often it uses it: its rows are one array in a scalar subquery, and equal subqueries are run once."""
    rows = df.agg(F.collect_list(F.struct(*df.columns)).alias("rows")).scalar()
    return df.sparkSession.range(0, 1, 1, 1).select(F.inline(rows))
