"""Helpers shared by the operators: tables, words, prefix sums, shared scratch tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.session import scratch_path
from contrail.sinks.files import materialize

# A word is a run of anything but space, tab, line feed, vertical tab, form
# feed and carriage return (the same class in Java, RE2 and Python regexes).
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
COPIES = 65_536  # equal rows that one row unfolds to


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read back: cuts
    the lineage, and a lost executor costs no recomputation of what was written."""
    return materialize(df, scratch_path(df.sparkSession, "llm", name))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the next one with underscores that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def word_array(text: Column) -> Column:
    """Words in order; an empty array for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def text_hash(*columns: Column) -> Column:
    """A 52-bit hash of the columns' text forms (null: empty) from MD5, so that
    another SQL engine can compute the same number."""
    joined = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("long")


def remainder_of_id(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; null for a null id."""
    return F.crc32(doc_id.cast("string")) % n


def sample_by_hash(df: DataFrame, key: Column, size: int) -> DataFrame:
    """About ``size`` rows of ``df`` (all, if it has no more), by a hash of ``key``.

    The expected number is ``size``; the spread is that of a binomial count (a few
    times its square root). The pick depends on the keys and the number of rows only.
    """
    n = df.count()
    share = min(1.0, size / n) if n else 1.0
    return df.filter(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))


def running_offset(
    df: DataFrame, groups: list[str], order: list[str], weight: str, name: str = "offset", chunks: int = 1024
) -> DataFrame:
    """``df`` (which holds just ``groups``, ``order`` and ``weight``) with the sum of
    ``weight`` over all earlier rows of the same group in column ``name``.

    The order inside a group is (chunk, order, weight), chunk being a hash of the
    order columns. No task ever sorts a whole group: sums run inside a (group,
    chunk), and the at most ``chunks`` totals of a group are summed apart. Equal
    rows are counted before the shuffle and unfolded at the end, in two steps with the
    parts of ``COPIES`` rows dealt over the tasks between them, so a row
    repeated any number of times doesn't gather in one task or one array. Groups must
    not be null.
    """
    keyed = df.withColumn("_chunk", text_hash(*[F.col(c) for c in order]) % chunks)
    by = list(dict.fromkeys([*groups, "_chunk", *order, weight]))
    counted = keyed.groupBy(*by).agg(F.count(F.lit(1)).alias("_copies"))
    amount = F.col(weight) * F.col("_copies")
    w = Window.partitionBy(*groups, "_chunk").orderBy(*order, weight)
    inner = counted.withColumn("_within", F.sum(amount).over(w.rowsBetween(Window.unboundedPreceding, 0)) - amount)
    totals = counted.groupBy(*groups, "_chunk").agg(F.sum(amount).alias("_total"))
    v = Window.partitionBy(*groups).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*groups, "_chunk", F.coalesce(F.sum("_total").over(v), F.lit(0)).alias("_base"))
    joined = inner.join(base, [*groups, "_chunk"])
    columns = list(dict.fromkeys([*groups, *order, weight]))
    long = lambda x: F.lit(x).cast("long")
    parts = joined.select(*columns, "_within", "_base", "_copies", F.explode(F.sequence(long(0), F.floor((F.col("_copies") - 1) / COPIES))).alias("_part"))
    most = F.least(long(COPIES), F.col("_copies") - F.col("_part") * COPIES)
    copies = parts.repartition(*[F.col(c) for c in columns], F.col("_part")).select("*", F.explode(F.sequence(long(0), most - 1)).alias("_copy"))
    before = F.col("_part") * COPIES + F.col("_copy")
    return copies.select(*columns, (F.col("_base") + F.col("_within") + before * F.col(weight)).alias(name))
