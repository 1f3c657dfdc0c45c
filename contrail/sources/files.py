"""File sources: raw on-time CSV, lookups, clean pipe files, stored results.

All readers take a declared schema (no inference pass over the data) and
return DataFrames whose scans prune columns and push filters down.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.scalars import unquote
from contrail.schemas import CLEAN_FLIGHTS, KEY_VALUE, LOOKUP, OLD_CLEAN_FLIGHTS, RAW_FLIGHTS, RAW_TO_CLEAN


def _mode(strict: bool) -> str:
    return "FAILFAST" if strict else "PERMISSIVE"


def read_raw_flights(spark: SparkSession, path: str, file_glob: str | None = None, strict: bool = True) -> DataFrame:
    """Raw on-time CSV files (all strings), quote-aware, header lines skipped.

    ``path`` may itself be a glob (``.../On_Time_*_2008_1*``); ``file_glob``
    filters file names inside a directory instead.
    """
    reader = spark.read.schema(RAW_FLIGHTS).option("header", True).option("mode", _mode(strict))
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    return reader.csv(path)


REASONS = ("fields", "date", "number")


def read_raw_marked(spark: SparkSession, path: str, file_glob: str | None = None) -> DataFrame:
    """Raw on-time lines with the raw columns, ``_file``, ``_line`` (the whole line) and ``_reason``: null for a
    good line, else the first that holds of ``fields`` (not as many as the layout has, or broken quotes), ``date``
    (no valid flight date) and ``number`` (a delay or an id that is not a number). Header lines
    are left out. A line is parsed on its own, so a quoted line end splits it, as in the other readers.

    The parsed row is the output of a generator (``inline`` of one row): a filter on it is not
    pushed below the parse, where it would parse the line again for every use of a field.
    """
    reader = spark.read.option("pathGlobFilter", file_glob) if file_glob else spark.read
    lines = reader.text(path).select(F.col("value").alias("_line"), F.col("_metadata.file_path").alias("_file"))
    schema = T.StructType(RAW_FLIGHTS.fields + [T.StructField("_broken", T.StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken", "columnPruning": "false"}
    row = F.from_csv("_line", schema.simpleString()[len("struct<") : -1].replace(":", " "), options)
    rows = lines.select("_file", "_line", F.inline(F.array(row)))
    trimmed = lambda c: F.nullif(F.trim(unquote(F.col(c))), F.lit(""))
    types = {f.name: f.dataType.simpleString() for f in CLEAN_FLIGHTS.fields}
    numbers = [(raw, types[name]) for raw, name in RAW_TO_CLEAN if types[name] in ("int", "double")]
    bad_number = reduce(lambda a, b: a | b, [trimmed(c).isNotNull() & trimmed(c).try_cast(t).isNull() for c, t in numbers])
    header = F.coalesce(trimmed("FlightDate") == "FlightDate", F.lit(False))
    reason = (
        F.when(F.col("_broken").isNotNull(), "fields")
        .when(trimmed("FlightDate").try_cast("date").isNull(), "date")
        .when(bad_number, "number")
    )
    return rows.filter(~header).withColumn("_reason", reason).drop("_broken")


def good_lines(marked: DataFrame) -> DataFrame:
    """The good lines of :func:`read_raw_marked` as raw rows."""
    return marked.filter(F.col("_reason").isNull()).drop("_file", "_line", "_reason")


def bad_lines(marked: DataFrame) -> DataFrame:
    """(file, reason, line) of the lines that were set aside."""
    return marked.filter(F.col("_reason").isNotNull()).select(F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.col("_line").alias("line"))


def observed(marked: DataFrame, observation: Observation) -> DataFrame:
    """``marked`` with counts of lines and of every reason taken while a job runs over it
    (``observation.get``), at no pass of their own."""
    counts = [F.count(F.when(F.col("_reason") == r, 1)).alias(r) for r in REASONS]
    return marked.observe(observation, F.count(F.lit(1)).alias("lines"), F.count(F.when(F.col("_reason").isNull(), 1)).alias("good"), *counts)


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A two-column lookup CSV ``(code, description)``. The header row is kept
    (it is dropped by :func:`contrail.operators.clean.clean_lookup`)."""
    return spark.read.schema(LOOKUP).option("header", False).option("escape", '"').csv(path)


def read_clean_flights(
    spark: SparkSession, path: str, strict: bool = True, corrupt_col: str | None = None
) -> DataFrame:
    """Pipe-delimited clean flights, typed; empty fields are null, quotes removed.

    ``strict`` fails the job on a malformed line. With ``corrupt_col`` the read
    is lenient and a malformed line is kept whole in that extra column, so it
    can be counted or set aside.
    """
    schema = CLEAN_FLIGHTS
    reader = spark.read.option("sep", "|").option("header", False).option("escape", '"').option("dateFormat", "yyyy-MM-dd")
    if corrupt_col:
        schema = T.StructType(CLEAN_FLIGHTS.fields + [T.StructField(corrupt_col, T.StringType(), True)])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
    else:
        reader = reader.option("mode", _mode(strict))
    return reader.schema(schema).csv(path)


def read_old_clean_flights(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """The older pipe layout: carrier, origin, dest, arrival delay, airline id and name."""
    return (
        spark.read.schema(OLD_CLEAN_FLIGHTS)
        .option("sep", "|")
        .option("header", False)
        .option("mode", _mode(strict))
        .csv(path)
        .select("carrier", "origin", "dest", "arr_delay", "airline_id", "airline_name")
    )


def read_key_value(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``key<TAB>value`` text, as :func:`contrail.sinks.files.write_key_value` writes it."""
    return spark.read.schema(KEY_VALUE).option("sep", "\t").option("escape", '"').csv(path)
