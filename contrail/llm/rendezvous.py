"""Sharding by rendezvous hashing of a stable record key over weighted shards.

Every (key, shard) pair gets a uniform number u from a hash; a row goes to the
shard with the smallest ``-ln(u) / weight``. A shard's share follows its weight,
and adding a shard moves a row only if the new shard wins, so rows move only
into it. DataFrame functions only.

Defined results: a null key hashes as empty text (one fixed shard); a null text
has size 16 and a null checksum; repeated rows get the same shard and slots of
their own; an empty table gives no rows; other columns are not read by
``shard_slots`` and pass through ``with_shard`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import running_offset, shared_table, text_hash

SHARDS = 40
RECORD_OVERHEAD = 16


def rendezvous_shard(key: Column, weights: list[float], seed: str = "shard") -> Column:
    """The shard number (int) of ``key`` over ``len(weights)`` shards."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")

    def score(weight: Column, shard: Column) -> Column:
        u = (text_hash(F.lit(seed), key, shard) + F.lit(0.5)) / F.lit(float(1 << 52))
        return F.struct((-F.log(u) / weight).alias("score"), shard.alias("shard"))

    scored = F.transform(F.array(*[F.lit(float(w)) for w in weights]), score)
    return F.array_min(scored)["shard"].cast("int")


def with_shard(df: DataFrame, key: str, weights: list[float], out: str = "shard") -> DataFrame:
    """``df`` with its shard in column ``out``; a projection, nothing is moved."""
    return df.withColumn(out, rendezvous_shard(F.col(key), weights))


def shard_slots(df: DataFrame, key: str = "doc_id", text: str = "text", weights: list[float] | None = None) -> DataFrame:
    """One row per row of ``df``: key, size, text_crc32, shard, slot, grown_shard.

    ``slot`` numbers the rows of a shard from 0 without gaps; ``grown_shard`` is
    the shard when one more shard (of mean weight) is added. Only the key, the
    size and the checksum are shuffled, never the texts.
    """
    weights = weights or [1.0] * SHARDS
    grown = [*weights, sum(weights) / len(weights)]
    narrow = df.select(
        F.col(key).alias(key),
        (F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_OVERHEAD).cast("long").alias("size"),
        F.crc32(F.col(text)).alias("text_crc32"),
        F.lit(1).cast("long").alias("_one"),
    )
    sharded = shared_table(with_shard(narrow, key, weights), "shards")  # one pass over the texts
    slots = running_offset(sharded, ["shard"], [key, "size", "text_crc32"], "_one", "slot")
    return slots.select(
        key, "size", "text_crc32", "shard", "slot", rendezvous_shard(F.col(key), grown).alias("grown_shard")
    )
