"""Store the clean flights table once; every question then reads it.

The table is written under ``year=`` directories (partition pruning for date
predicates) and hashed on (year, month, spread) before the write, spread being a row
hash over as many values as there are partitions, so a month holding a third of
all flights is split across many tasks. Rows are sorted by date inside a task,
so Parquet row-group statistics let scans skip days. Unlike a range
partitioning, this reads the input once (no sampling pass).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators.clean import clean_lookup, enrich, project_clean
from contrail.operators.runtime_filter import maybe_wanted, within_range
from contrail.schemas import CLEAN_COLUMNS
from contrail.sinks.files import write_table
from contrail.sources.files import bad_lines, good_lines, read_lookup, read_raw_flights, read_raw_marked


DAY_BITS = 1 << 16  # a Bloom filter of days: a century has 36,525


def store_flights(flights: DataFrame, path: str, partitions: int) -> None:
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in flights.columns]), F.lit(partitions))
    dealt = (
        flights.withColumn("year", F.year("flight_date"))
        .repartition(partitions, F.col("year"), F.month("flight_date"), spread)
        .sortWithinPartitions("year", "flight_date")
    )
    write_table(dealt, path, partition_by=["year"])


def read_stored_flights(spark: SparkSession, path: str, days: list[str] | DataFrame | None = None) -> DataFrame:
    """The stored table without its ``year`` directory column. With ``days`` only flights on
    them: other years' directories are not read and the days reach the Parquet scan.

    ``days`` are ``yyyy-MM-dd``, known now, or a DataFrame with a ``flight_date`` column, of any
    size, read when the query runs: the span of its years is then a partition filter, the span of its
    days a filter of the scan, and a Bloom filter leaves out most other days (not all of them:
    a join with the requests makes it exact)."""
    stored = spark.read.parquet(path)
    if isinstance(days, DataFrame):
        wanted = days.select("flight_date").distinct()
        stored = within_range(stored, F.col("year"), wanted, F.year("flight_date"))
        stored = within_range(stored, F.col("flight_date"), wanted, F.col("flight_date"))
        stored = maybe_wanted(stored, [F.col("flight_date")], wanted, [F.col("flight_date")], DAY_BITS)
    elif days is not None:
        stored = stored.filter(
            F.col("year").isin(sorted({int(d[:4]) for d in days})) & F.col("flight_date").isin([dt.date.fromisoformat(d) for d in days])
        )
    return stored.drop("year")


def clean_from_raw(
    spark: SparkSession,
    raw_path: str,
    airports_path: str | None = None,
    airlines_path: str | None = None,
    file_glob: str | None = None,
    strict: bool = True,
    with_names: bool = False,
    rejects: str | None = None,
) -> DataFrame:
    """Raw on-time CSV files to clean flights: header and undated rows
    dropped, the 10 clean columns typed, and (when lookups are given) the
    airport and airline names joined on. Without ``with_names`` only the 10
    clean columns are kept, and Catalyst then drops the lookup joins. ``strict``
    fails the job on a malformed line or number; otherwise it becomes null. With ``rejects`` (a
    directory), a bad line is neither: it is written there, with its file and the reason,
    and the rest is read strictly."""
    if rejects:
        marked = read_raw_marked(spark, raw_path, file_glob)
        write_table(bad_lines(marked), rejects)
        flights = project_clean(good_lines(marked))
    else:
        flights = project_clean(read_raw_flights(spark, raw_path, file_glob=file_glob, strict=strict), strict=strict)
    if airports_path and airlines_path:
        flights = enrich(
            flights,
            clean_lookup(read_lookup(spark, airports_path)),
            clean_lookup(read_lookup(spark, airlines_path)),
            lookups_unique=True,
        )
    return flights if with_names else flights.select(*CLEAN_COLUMNS)
