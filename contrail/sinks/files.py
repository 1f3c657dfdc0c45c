"""File sinks. Every write is distributed (each task writes its own files)
and replaces the target (``overwrite``) unless told otherwise.

A replacement is written aside, next to the target, and takes its place by renames
when the job is done: until then, and if the job fails, the previous answer stays.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from contrail.sinks.paths import exists, remove, rename_new


def replace_directory(df: DataFrame, path: str, write: Callable[[str], None]) -> None:
    """``write(aside)``, then put what it wrote in the place of ``path``.

    Between the two renames the target is missing for a moment; the previous answer is then
    next to it (``_<name>.old-...``) and is put back if the second rename fails."""
    spark, path = df.sparkSession, path.rstrip("/")
    name = path.rpartition("/")[2]
    beside = lambda tag: f"{path.removesuffix(name)}_{name}.{tag}-{uuid.uuid4().hex[:12]}"
    aside, old = beside("new"), beside("old")
    try:
        write(aside)
    except BaseException:
        remove(spark, aside)
        raise
    had = exists(spark, path)
    if had and not rename_new(spark, path, old):
        raise FileExistsError(old)
    if not rename_new(spark, aside, path):
        if had:
            rename_new(spark, old, path)
        raise FileExistsError(f"{path} was written by another job meanwhile")
    if had:
        remove(spark, old)


def _save(df: DataFrame, path: str, mode: str, write: Callable[[str, str], None]) -> None:
    if mode == "overwrite":
        replace_directory(df, path, lambda aside: write(aside, "errorifexists"))
    else:
        write(path, mode)


# Text that only the next step reads is compressed. A compressed file is read by one task, so a
# file holds at most so many rows.
TEXT_CODEC = "lz4"
FILE_ROWS = 1_000_000


def bounded_files(df: DataFrame) -> DataFrameWriter:
    """The writer of ``df`` for compressed text files of at most ``FILE_ROWS`` rows each."""
    return df.write.option("compression", TEXT_CODEC).option("maxRecordsPerFile", FILE_ROWS)


def write_delimited(df: DataFrame, path: str, sep: str = "|", mode: str = "overwrite", compressed: bool = False) -> None:
    """Delimited text without header; nulls as empty fields, dates ``yyyy-MM-dd``.
    A value that holds the separator, a quote or a line end is quoted (quotes
    doubled), and spaces at its ends are kept. ``compressed``: as :func:`bounded_files`."""
    _save(df, path, mode, lambda target, m: (
        (bounded_files(df) if compressed else df.write).mode(m)
        .option("sep", sep)
        .option("header", False)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("dateFormat", "yyyy-MM-dd")
        .csv(target)
    ))


def write_key_value(df: DataFrame, key: str, value: str, path: str, mode: str = "overwrite") -> None:
    """``key<TAB>value`` lines."""
    write_delimited(df.select(F.col(key).cast("string"), F.col(value).cast("string")), path, "\t", mode)


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None, fmt: str = "parquet"
) -> None:
    """Columnar result (Parquet by default), optionally partitioned on disk."""

    def write(target: str, m: str) -> None:
        w = df.write.mode(m).format(fmt)
        (w.partitionBy(*partition_by) if partition_by else w).save(target)

    _save(df, path, mode, write)


def materialize(df: DataFrame, path: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to ``path`` (in the shared checkpoint folder) and read it
    back: later plans start from the files, so the lineage is cut and a lost
    executor costs no recomputation of what was written. ``codec``: the Parquet compression
    (default: the session's)."""
    df.write.mode("overwrite").parquet(path, compression=codec)
    return df.sparkSession.read.parquet(path)
