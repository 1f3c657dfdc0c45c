"""Similarity join on word n-grams: MinHash banding, then verification on the full sets.

1. Every text becomes the set of its hashed five-word shingles; texts with equal
   sets are one node from here on (their rows are only counted).
2. MinHash signatures are cut into bands of ``rows`` values; the number of bands
   follows from the target recall at the threshold. Rows are shuffled on
   (band, band hash).
3. In a bucket of up to ``BUCKET`` nodes, pairs whose signatures agree in clearly
   fewer places than the threshold asks for are set aside; what stays linked
   becomes star edges. A larger bucket becomes one star without that test, so
   nothing is lost there either. Connected components of the edges are the
   candidate groups: every candidate pair lies inside one.
4. A candidate group is cut into blocks of at most ``BLOCK`` nodes and about
   ``BLOCK_SHINGLES`` shingles; each pair of blocks is a task that compares the
   full shingle sets. Out come the number of links of each node and a spanning
   forest of the links, never the pairs.
5. Components of the verified links are the classes.

Every document gets ``class_id`` (the smallest key of its class) and ``links`` (the
number of other documents with similarity of at least the threshold).

Defined results: null texts and texts without a word have no shingles, so no
links, and are classes of their own; a text of fewer than five words is one
shingle; repeated rows are links of each other; a class of null keys only has a
null class_id; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import WORD, shared_table
from contrail.llm.components import connected_components

SHINGLE_WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
BAND_ROWS = 6
SKETCH = 128  # signature places that are compared inside a bucket
SLACK = 0.2  # a pair is set aside if its places agree less than threshold - SLACK
BUCKET = 512
BLOCK = 256
BLOCK_SHINGLES = 500_000
BROADCAST_ROWS = 100_000

_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def bands_for(threshold: float, rows: int, recall: float) -> int:
    """Bands needed to make a pair at the threshold a candidate with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def mixed(h: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word, from the powers of a base over its bytes."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    inside = ~_GAP[data]
    data = data[inside]
    if not len(data):
        return np.empty(0, np.uint64)
    at = np.flatnonzero(inside)
    starts = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    lengths = np.diff(starts, append=len(data))
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, dtype=np.uint64))
    return mixed(np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * powers[place], starts) + lengths.astype(np.uint64))


def shingles(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of ``text``."""
    words = word_hashes(text) if text else np.empty(0, np.uint64)
    if not len(words):
        return words
    width = min(size, len(words))
    total = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        total = total * _BASE + words[k : len(words) - width + 1 + k]
    return np.unique(mixed(total + np.uint64(width)))


def digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


class Signer:
    """MinHash signatures cut into bands."""

    def __init__(self, bands: int, rows: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        n = max(bands * rows, SKETCH)
        self.bands, self.rows = bands, rows
        self.xor = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)[:, None]
        self.odd = (rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32) | np.uint32(1))[:, None]

    def signature(self, found: np.ndarray) -> np.ndarray:
        x = (found >> np.uint64(32)).astype(np.uint32)
        out = np.full(len(self.xor), 0xFFFFFFFF, np.uint32)
        for c in range(0, len(x), 1 << 16):  # bounded memory for very long texts
            part = x[c : c + (1 << 16)]
            step = max(1, (1 << 17) // len(part))
            for k in range(0, len(out), step):
                h = part ^ self.xor[k : k + step]
                h *= self.odd[k : k + step]
                np.minimum(out[k : k + step], h.min(axis=1), out=out[k : k + step])
        return out

    def sketch(self, found: np.ndarray) -> tuple[np.ndarray, bytes]:
        """(hash of every band, low bytes of the first signature places)."""
        s = self.signature(found)
        h = np.zeros(self.bands, np.uint64)
        for k in range(self.rows):
            h = h * _BASE + s[: self.bands * self.rows].reshape(self.bands, self.rows)[:, k]
        return mixed(h).view(np.int64), (s[:SKETCH] >> np.uint32(8)).astype(np.uint8).tobytes()


def smallest_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For n points linked pairwise by i, j: the smallest point of each one's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def bucket_edges(batches: Iterator[pd.DataFrame], least: float) -> Iterator[pd.DataFrame]:
    """Star edges inside every bucket of a partition sorted by bucket."""

    def edges(rows: pd.DataFrame) -> pd.DataFrame:
        node = rows["node"].to_numpy()
        band, value = rows["band"].to_numpy(), rows["value"].to_numpy()
        sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1)
        new = np.append(True, (band[1:] != band[:-1]) | (value[1:] != value[:-1]))
        start = np.flatnonzero(new)
        last = np.repeat(np.append(start[1:], len(rows)), np.diff(start, append=len(rows))) - 1
        index, step, found = np.arange(len(rows)), 1, [(np.empty(0, int), np.empty(0, int))]
        while True:
            index = index[index + step <= last[index]]
            if not len(index):
                break
            for c in range(0, len(index), 1 << 16):
                a = index[c : c + (1 << 16)]
                alike = (sketch[a] == sketch[a + step]).mean(axis=1) >= least
                found.append((a[alike], a[alike] + step))
            step += 1
        i, j = (np.concatenate(x) for x in zip(*found))
        label = smallest_labels(len(rows), i, j)
        moved = label != np.arange(len(rows))
        return pd.DataFrame({"a": node[moved], "b": node[label[moved]]}).drop_duplicates()

    kept = None
    for batch in batches:
        rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
        if not len(rows):
            continue
        band, value = rows["band"].to_numpy(), rows["value"].to_numpy()
        open_from = int(((band == band[-1]) & (value == value[-1])).argmax())  # the last bucket may go on
        kept = rows.iloc[open_from:]
        if open_from:
            yield edges(rows.iloc[:open_from])
    if kept is not None and len(kept):
        yield edges(kept)


def block_links(rows: pd.DataFrame, threshold: Fraction) -> pd.DataFrame:
    """Links between (and inside, if they are the same) two blocks of a candidate group:
    (node, links, root), links counting documents, root the smallest node linked to it here."""
    rows = rows.drop_duplicates("node").sort_values("node")
    sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
    size = np.array([len(s) for s in sets], dtype=np.float64)
    block = rows["block"].to_numpy()
    first, second = block.min() == rows["low"].iloc[0], rows["low"].iloc[0] != rows["high"].iloc[0]
    everything, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    owner = np.repeat(np.arange(len(sets)), size.astype(int))
    use = shared[inverse]
    owner, at = owner[use], column[inverse[use]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    both = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for c in range(0, int(shared.sum()), 4096):
        lo, hi = np.searchsorted(at, [c, c + 4096])
        part = np.zeros((len(sets), 4096), dtype=np.float32)
        part[owner[lo:hi], at[lo:hi] - c] = 1
        both += part @ part.T
    union = size[:, None] + size[None, :] - both
    linked = both * threshold.denominator >= union * threshold.numerator
    np.fill_diagonal(linked, False)
    if second:  # pairs inside a block belong to the task of that block with itself
        linked &= block[:, None] != block[None, :]
    copies = rows["copies"].to_numpy()
    i, j = np.nonzero(linked)
    label = smallest_labels(len(sets), i, j)
    node = rows["node"].to_numpy()
    out = pd.DataFrame({"node": node, "links": (linked @ copies).astype(np.int64), "root": node[label]})
    return out[linked.any(axis=1)]


def sketches(df: DataFrame, key: str, text: str, signer: Signer) -> DataFrame:
    """(key, text_md5, digest, n, bands, sketch) per row of ``df``; n is the number of shingles."""
    read = df.select(F.col(key).alias("id"), F.col(text).alias("text"), F.md5(F.col(text)).alias("text_md5"))
    kind = read.schema["id"].dataType.simpleString()

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for t in batch["text"]:
                found = shingles(t)
                made.append((digest(found), len(found), *(signer.sketch(found) if len(found) else (None, None))))
            rest = pd.DataFrame(made, columns=["digest", "n", "bands", "sketch"])
            yield pd.concat([batch[["id", "text_md5"]].reset_index(drop=True), rest], axis=1)

    return read.mapInPandas(sign, f"id {kind}, text_md5 string, digest binary, n int, bands array<bigint>, sketch binary")


def join(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    rows: int = BAND_ROWS,
    recall: float = RECALL,
) -> DataFrame:
    """One row per row of ``df``: id, text_md5, n, node, class_id, links (node: null without shingles)."""
    spark = df.sparkSession
    signer = Signer(bands_for(threshold, rows, recall), rows)
    signed = shared_table(sketches(df, key, text, signer), "jaccard-sketches")  # one pass over the texts
    nodes = shared_table(
        signed.filter("n > 0")
        .groupBy("digest")
        .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"),
             F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()),
        "jaccard-nodes",
    )
    # Buckets
    banded = nodes.select("node", F.posexplode("bands").alias("band", "value"))
    buckets = banded.groupBy("band", "value").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("b")).filter("size > 1")
    members = shared_table(banded.join(buckets, ["band", "value"]).select("band", "value", "size", "node", "b"), "jaccard-members")
    stars = members.filter((F.col("size") > BUCKET) & (F.col("node") != F.col("b"))).select(F.col("node").alias("a"), "b")
    small = members.filter(F.col("size") <= BUCKET).select("band", "value", "node").join(nodes.select("node", "sketch"), "node")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_buckets = small.repartition(n, "band", "value").sortWithinPartitions("band", "value", "node")
    least = threshold - SLACK
    tested = sorted_buckets.mapInPandas(lambda it: bucket_edges(it, least), "a bigint, b bigint")
    groups = shared_table(connected_components(stars.unionByName(tested), "jaccard-candidates"), "jaccard-groups")
    # Verification on the full sets
    sized = groups.join(nodes.select("node", "least", "digest", "copies", "n"), "node")
    cut = sized.groupBy("root").agg(F.count(F.lit(1)).alias("_m"), F.sum("n").alias("_s")).select(
        "root", F.greatest(F.ceil(F.col("_m") / BLOCK), F.ceil(F.col("_s") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    wanted = shared_table(
        sized.join(cut, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "jaccard-wanted"
    )
    texts = df.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    few = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted  # the measured size decides
    fetched = texts.join(few, texts["_id"].eqNullSafe(few["least"])).select(
        "root", "node", "digest", "copies", "blocks", "block", "_text"
    )

    def with_shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t) for t in batch["_text"]]
            same = np.array([digest(s) == bytes(d) for s, d in zip(sets, batch["digest"])], dtype=bool)  # keys may repeat
            out = batch.drop(columns=["_text", "digest"]).assign(shingles=[s.tobytes() for s in sets])
            yield out[same] if len(out) else out

    full = fetched.mapInPandas(with_shingles, "root bigint, node bigint, copies bigint, blocks int, block int, shingles binary")
    paired = full.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "root", "node", "copies", "block", "shingles", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high")
    )
    exact = Fraction(threshold).limit_denominator(1000)
    linked = shared_table(
        paired.groupBy("root", "low", "high").applyInPandas(
            lambda rows: block_links(rows, exact), "node bigint, links bigint, root bigint"
        ),
        "jaccard-links",
    )
    # Classes
    classes = connected_components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")), "jaccard-classes")
    links = linked.groupBy("node").agg(F.sum("links").alias("_others"))
    judged = nodes.select("node", "digest", "least", "copies").join(links, "node", "left").join(classes, "node", "left")
    whole = judged.withColumn("root", F.coalesce("root", "node"))
    class_ids = whole.groupBy("root").agg(F.min("least").alias("class_id"))
    answer = whole.join(class_ids, "root").select(
        "digest", F.col("root").alias("node"), "class_id", (F.col("copies") - 1 + F.coalesce("_others", F.lit(0))).alias("links")
    )
    joined = signed.select("id", "text_md5", "digest", "n").filter("n > 0").join(answer, "digest")
    alone = signed.filter("n = 0").select(
        "id", "text_md5", "n", F.lit(None).cast("long").alias("node"), F.col("id").alias("class_id"), F.lit(0).cast("long").alias("links")
    )
    return joined.select("id", "text_md5", "n", "node", "class_id", "links").unionByName(alone)


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``df``: key, class_id, links."""
    return join(df, key, text, **options).select(F.col("id").alias(key), "class_id", "links")


def first_of_each_class(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``df`` with one row of each class: that of the smallest key (of equal keys, the smallest text hash)."""
    judged = shared_table(join(df, key, text, **options), "jaccard-judged")
    in_class = judged.filter("n > 0")
    place = F.struct(F.col("id").isNull().alias("late"), "id", "text_md5")  # null keys last
    chosen = in_class.groupBy("node").agg(F.min(place).alias("_best"))
    rows = in_class.join(chosen, "node").select("id", "text_md5", place.eqNullSafe(F.col("_best")).alias("_keep"))
    # Rows equal in key and text can't be told apart: all go or all but one stay.
    listed = rows.groupBy("id", "text_md5").agg(F.max("_keep").alias("_keep"), F.count(F.lit(1)).alias("_same"))
    listed = shared_table(listed.filter("not _keep or _same > 1").select(F.col("id").alias("_id"), F.col("text_md5").alias("_md5"), "_keep"), "jaccard-listed")
    # The input's columns travel as one struct, so none can clash with those made here.
    marked = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(key).alias("own_id"), F.md5(F.col(text)).alias("own_md5"))
    side = F.broadcast(listed) if listed.count() <= BROADCAST_ROWS else listed
    met = marked.join(side, marked["own_id"].eqNullSafe(side["_id"]) & (marked["own_md5"] == side["_md5"]), "left")
    found = met.filter(F.coalesce("_keep", F.lit(True)))
    if listed.filter("_keep").isEmpty():
        return found.select("row.*")
    repeated = found.filter(F.col("_keep").isNotNull()).dropDuplicates(["own_id", "own_md5"])
    return found.filter(F.col("_keep").isNull()).unionByName(repeated).select("row.*")
