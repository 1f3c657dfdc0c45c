"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector becomes a binary code (bit i: element i is positive) in as many 64-bit words as
the longest vector needs. Codes are cut into m segments of consecutive bits, m just over
bits / log2(rows), and every (segment, value) lists its codes. A
code within Hamming distance m*s + j of a query has a segment among 0..j within s
of the query's, or a later one within s - 1. So the search probes all segment
values at radius 0, 1, 2, ... from the query's, verifies the full distance of what
it meets, and a query is done once its k-th verified distance is covered.

Each round is a join of probes and index on (segment, value). An upper bound of
the k-th distance (first from a bounded sample of the rows, then from what is
verified) is part of the join condition, so rows out of reach never leave the join;
rows that a later bound rules out are dropped before the next round.

Rows of equal code are one code with its k smallest ids (more can't be among a
query's k nearest), queries of equal code are one query, so copies of one vector
may be any share of the rows.

Defined results: null or empty vectors, and those with a null id, are neither
indexed nor queries; null elements, and those past the end of a shorter vector, count
as not positive; ties go to the smaller id; a query finds itself; with
fewer than k rows all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from contrail.llm.common import sample_by_hash, shared_table

WORD_BITS = 64
K = 10
SAMPLE = 4_096
FIRST_RADIUS = 2  # the first round probes all radii up to this one


def words_for(elements: int) -> int:
    """Number of words in the code of a vector of so many elements."""
    return max(1, math.ceil(elements / WORD_BITS))


def sign_code(vector: Column, words: int = 1) -> Column:
    """The code of a vector: a struct of ``words`` longs ``w0``, ``w1``, ..., bit i of word j for element 64j + i."""

    def word(j: int) -> Column:
        own = F.slice(vector, j * WORD_BITS + 1, WORD_BITS)
        zero = F.lit(0).cast("long")
        bit = F.transform(own, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(zero))
        return F.aggregate(bit, zero, lambda a, b: a.bitwiseOR(b)).alias(f"w{j}")

    return F.struct(*[word(j) for j in range(words)])


def hamming(a: Column, b: Column, words: int) -> Column:
    total = F.bit_count(a["w0"].bitwiseXOR(b["w0"]))
    for j in range(1, words):
        total = total + F.bit_count(a[f"w{j}"].bitwiseXOR(b[f"w{j}"]))
    return total


def segments(rows: int, bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of every segment for an index of so many rows."""
    m = min(bits // 8, max(3, math.ceil(bits / math.log2(max(rows, 2)))))
    cuts = [round(j * bits / m) for j in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def segment_value(code: Column, first: int, width: int) -> Column:
    """Bits ``first`` to ``first + width - 1`` of a code as a number; a segment may reach into the next word."""
    j, at = divmod(first, WORD_BITS)
    value = F.shiftrightunsigned(code[f"w{j}"], at)
    if at + width > WORD_BITS:
        value = value.bitwiseOR(F.shiftleft(code[f"w{j + 1}"], WORD_BITS - at))
    return value.bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def masks(width: int, radius: int) -> list[int]:
    """All numbers of ``width`` bits with ``radius`` bits set."""
    return [sum(1 << b for b in bits) for bits in combinations(range(width), radius)]


def first_bounds(queries: DataFrame, sample: np.ndarray, k: int) -> DataFrame:
    """``queries`` with ``bound``: an upper bound of the k-th smallest distance, from the sampled codes (rows of words)."""
    words = sample.shape[1]

    @pandas_udf("int")
    def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for q in batch.to_numpy(dtype=np.int64):
                if len(sample) < k:
                    out.append(words * WORD_BITS)
                    continue
                distance = np.bitwise_count((sample ^ q).view(np.uint64)).sum(axis=1, dtype=np.int64)
                out.append(int(np.partition(distance, k - 1)[k - 1]))
            yield pd.Series(out, dtype="int32")

    return queries.withColumn("bound", bound("q"))


def nearest_codes(distinct: DataFrame, queries: DataFrame, rows: int, sample: np.ndarray, k: int) -> DataFrame:
    """(q, code, dist): for every query code, all codes up to its k-th distance."""
    words = sample.shape[1]
    parts = segments(rows, words * WORD_BITS)
    m = len(parts)
    split = lambda c: F.array(
        *[F.struct(F.lit(j).alias("seg"), segment_value(c, a, w).alias("val")) for j, (a, w) in enumerate(parts)]
    )
    index = shared_table(distinct.select("code", F.explode(split(F.col("code"))).alias("p")).select("p.seg", "p.val", "code"), "mih-index")
    open_queries = shared_table(first_bounds(queries, sample, k), "mih-queries")
    state, found, radius = open_queries, None, -1
    while True:
        radii = range(0, FIRST_RADIUS + 1) if radius < 0 else range(radius + 1, radius + 2)
        radius = radii[-1]
        # Segment j at radius s is needed only while m*s + j is within the bound.
        flips = F.array(
            *[
                F.array(*[F.struct(F.lit(m * s + j).alias("from_bound"), F.lit(masks(w, s)).cast("array<bigint>").alias("masks")) for s in radii if s <= w])
                for j, (_, w) in enumerate(parts)
            ]
        )
        cells = state.select("q", "bound", F.posexplode(split(F.col("q"))).alias("_j", "p")).select("q", "bound", "p.seg", "p.val")
        steps = cells.select("*", F.explode(F.get(flips, F.col("seg"))).alias("f")).filter("f.from_bound <= bound")
        probes = steps.select("q", "bound", "seg", "val", F.explode("f.masks").alias("_mask")).select(
            "q", "bound", "seg", F.col("val").bitwiseXOR(F.col("_mask")).alias("val")
        )
        i = index.select(F.col("seg").alias("_seg"), F.col("val").alias("_val"), "code")
        # Unfolded probes look small to the planner; they are not, so no broadcast.
        met = probes.hint("merge").join(
            i, (probes["seg"] == i["_seg"]) & (probes["val"] == i["_val"]) & (hamming(probes["q"], i["code"], words) <= probes["bound"])
        )
        new = met.select("q", "code", hamming(F.col("q"), F.col("code"), words).alias("dist"))
        if found is not None:  # what the bounds still allow
            new = new.unionByName(found.join(open_queries, "q").filter("dist <= bound").select("q", "code", "dist"))
        found = shared_table(new.distinct(), "mih-found")
        # The k-th verified distance, counting rows.
        ranked = found.join(distinct, "code").withColumn(
            "_upto", F.sum("copies").over(Window.partitionBy("q").orderBy("dist").rangeBetween(Window.unboundedPreceding, 0))
        )
        kth = ranked.filter(F.col("_upto") >= k).groupBy("q").agg(F.min("dist").alias("kth"))
        bounds = open_queries.join(kth, "q", "left").select("q", F.least("bound", "kth").alias("bound"))
        open_queries = shared_table(bounds, "mih-queries")
        state = open_queries.filter(F.col("bound") >= m * (radius + 1))
        if state.isEmpty():
            break
    return found.join(open_queries, "q").filter("dist <= bound").select("q", "code", "dist")


def top_k(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = K, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k nearest rows of every query row."""
    usable = df.filter(F.col(key).isNotNull() & (F.size(vector) > 0))
    words = words_for(usable.agg(F.max(F.size(vector))).first()[0] or 0)
    codes = shared_table(
        usable.select(F.col(key).alias("id"), sign_code(F.col(vector), words).alias("code"), is_query.alias("asks")), "mih-codes"
    )
    rows = codes.count()
    picked = sample_by_hash(codes, F.struct("id", "code"), sample).select("code.*").toPandas().to_numpy(dtype=np.int64)
    nth = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    members = codes.select("code", "id").withColumn("_nth", nth).filter(F.col("_nth") <= k).drop("_nth")
    distinct = shared_table(codes.groupBy("code").agg(F.count(F.lit(1)).alias("copies")), "mih-distinct")
    queries = codes.filter("asks").select(F.col("code").alias("q")).distinct()
    near = nearest_codes(distinct, queries, rows, picked, k)
    order = Window.partitionBy("q").orderBy("distance", "neighbor_id")
    best = (
        near.join(members, "code")
        .select("q", F.col("id").alias("neighbor_id"), F.col("dist").cast("int").alias("distance"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
    )
    asked = codes.filter("asks").select(F.col("id").alias("query_id"), F.col("code").alias("q"))
    return asked.join(best, "q").select("query_id", "rank", "neighbor_id", "distance")
