"""Structured Streaming over files arriving in a directory.

The stream stays a DataFrame, so every batch operator in the package also
runs on it. Sinks write per task (files, keyed table), never to the driver,
except the console sink, which prints a few rows of each batch.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from contrail.operators.aggregates import mean_of_parts, sum_parts
from contrail.operators.filters import min_fields, require
from contrail.sinks.keyed import KeyedTable

BATCH_INTERVAL = "2 seconds"


def text_stream(
    spark: SparkSession,
    directory: str,
    file_glob: str | None = None,
    max_files: int | None = None,
    modified_after: str | None = None,
) -> DataFrame:
    """New text files of ``directory`` as lines in a ``value`` column; ``max_files`` bounds
    a batch, ``modified_after`` (session time) leaves older files out."""
    r = spark.readStream.format("text")
    if modified_after:
        r = r.option("modifiedAfter", modified_after)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(directory)


def table_stream(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    file_glob: str | None = None,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """New files of a columnar (or CSV/JSON) table under ``directory``."""
    r = spark.readStream.format(fmt).schema(schema)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(directory)


def _trigger(writer, interval: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval or BATCH_INTERVAL)


def print_batches(
    df: DataFrame, checkpoint: str, interval: str | None = BATCH_INTERVAL, rows: int = 20, available_now: bool = False
) -> StreamingQuery:
    """Print the first rows of every micro-batch (one batch per ``interval``)."""
    w = df.writeStream.format("console").option("numRows", rows).option("truncate", False)
    w = w.option("checkpointLocation", checkpoint).outputMode("append")
    return _trigger(w, interval, available_now).start()


def write_files(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", interval: str | None = BATCH_INTERVAL, available_now: bool = False
) -> StreamingQuery:
    """Append every micro-batch to a file table (exactly once via the checkpoint)."""
    w = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    return _trigger(w.outputMode("append"), interval, available_now).start()


def upsert_batches(
    df: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    interval: str | None = BATCH_INTERVAL,
    available_now: bool = False,
    stream: str | None = None,
) -> StreamingQuery:
    """Upsert every micro-batch into a keyed table, as a version after the newest.

    ``stream`` names the stream in the table (default: a digest of the checkpoint
    path); a batch of it that is replayed after a failure is not written twice.
    """
    name = stream or hashlib.sha1(checkpoint.encode()).hexdigest()[:12]
    w = df.writeStream.foreachBatch(lambda batch, batch_id: table.upsert(batch, batch=(name, int(batch_id))) and None)
    w = w.option("checkpointLocation", checkpoint)
    return _trigger(w, interval, available_now).start()


def upsert_aggregates(
    df: DataFrame,
    keys: list[str],
    aggregates: list[Column],
    values: list[Column],
    table: KeyedTable,
    checkpoint: str,
    interval: str | None = BATCH_INTERVAL,
    available_now: bool = False,
    stream: str | None = None,
) -> StreamingQuery:
    """Keep ``aggregates`` per key over all files that have arrived, as state of the stream, and
    upsert the keys that a batch has changed (``values`` computed from them) into a keyed table.

    The state lives in the checkpoint: a restarted stream goes on from it. A key's item is
    complete in itself, and the table's ledger knows the batches it holds, so a batch that is
    replayed after a failure changes nothing.
    """
    name = stream or hashlib.sha1(checkpoint.encode()).hexdigest()[:12]
    state = df.groupBy(*keys).agg(*aggregates)

    def take(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch.select(*keys, *values), batch=(name, int(batch_id)))

    w = state.writeStream.outputMode("update").foreachBatch(take).option("checkpointLocation", checkpoint)
    return _trigger(w, interval, available_now).start()


def keep_route_means(flights: DataFrame, table: KeyedTable, checkpoint: str, **options) -> StreamingQuery:
    """2-4 kept up to date while files arrive: (origin, dest, delay)."""
    usable = require(min_fields(flights, 9), "origin", "dest", "arr_delay")
    parts, mean = sum_parts(F.col("arr_delay"), "_v"), mean_of_parts("_v", 2).alias("delay")
    return upsert_aggregates(usable, ["origin", "dest"], parts, [mean], table, checkpoint, **options)


def keep_airport_counts(flights: DataFrame, table: KeyedTable, checkpoint: str, **options) -> StreamingQuery:
    """Flights in plus out per airport kept up to date while files arrive: (airport, flights)."""
    usable = require(min_fields(flights, 9), "origin", "dest")
    ends = usable.select(F.explode(F.array("origin", "dest")).alias("airport"))
    return upsert_aggregates(ends, ["airport"], [F.count(F.lit(1)).alias("flights")], [F.col("flights")], table, checkpoint, **options)


def tail_directory(spark: SparkSession, directory: str, checkpoint: str, interval: str = BATCH_INTERVAL,
                   timeout_s: float | None = None) -> StreamingQuery:
    """Print the new lines of files arriving in ``directory`` every ``interval``
    and block until the query stops (or ``timeout_s`` passes)."""
    q = print_batches(text_stream(spark, directory), checkpoint, interval)
    q.awaitTermination(timeout_s) if timeout_s is not None else q.awaitTermination()
    return q
