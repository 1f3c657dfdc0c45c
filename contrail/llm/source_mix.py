"""Mixing sources to target weights over fixed-length blocks of words.

1. The documents of a source are laid end to end and cut into blocks of
   ``block_words`` words.
2. Targets: sources ordered by name (code points, null last) weigh 1, 2, 3, 1, ...;
   a target stops at ``max_repeats`` times its source, the excess goes to the
   others by weight (closed form of the water filling).
3. A source gets its wanted number of slots, rounded by largest remainder and
   never above ``max_repeats`` times its blocks. All slots are numbered, source after
   source, and one keyed permutation of all these numbers deals them to places: place p
   is in output shard ``p div shard_slots``. Every shard is full (the last one may be
   smaller), and its counts by source are a multinomial draw under the condition that the counts
   of a source over all shards add up to its slots exactly.
4. Slot t of a source is block
   ``perm(t mod blocks)`` of pass ``t div blocks``, perm being a swap-or-not
   permutation of the block numbers keyed by seed, source and pass. A pass takes
   every block once before the next begins, and the slots end with pass
   ``max_repeats``, so no document is taken more often than that.
5. Blocks are joined to the documents they cover by (source, block number).

All random choices are hashes of numbers, so reruns agree. DataFrame functions
only. Sources are summed before the shuffle, and positions come from
``running_offset``, so one source may hold any share of the rows.

Defined results: null or empty texts have size 0 and taken 0; a null source is a
source of its own, last in order; repeated rows each have their own place; an
empty table gives no rows; columns besides the three named ones pass through whatever
their names (``mixed_documents``), or are not looked at (``taken_words``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import GAP, WORD, running_offset, shared_table, word_count
from contrail.operators.joins import bounded_broadcast

BLOCK_WORDS = 128
SHARD_SLOTS = 65_536
MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
ROUNDS = 24
CHUNK = 4_096  # slots that one row unfolds to


def source_targets(sized: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: source, ord, source_size, target (words to take)."""
    order = Window.orderBy(F.col("source").isNull(), "source")  # one row per source from here on
    everything = Window.partitionBy()
    sources = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("ord", F.row_number().over(order).cast("int"))
        .withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("ord") - 1) % len(WEIGHTS) + 1))
        .withColumn("_cap", F.col("source_size").cast("double") * max_repeats)
    )
    # Sources fill up in order of cap per weight: the k-th is full if an even
    # level over the sources not yet full would lie above its own cap.
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), "ord")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / (
        F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    )
    filled = sources.withColumn("_full", F.col("_cap") <= level * F.col("_w"))
    rest = F.sum("source_size").over(everything) - F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0.0)).over(everything)
    open_w = F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("_w"))).over(everything)
    return filled.withColumn(
        "target", F.when(F.col("_full"), F.col("_cap")).otherwise(rest * F.col("_w") / open_w)
    ).select("source", "ord", "source_size", "target")


def permuted(position: Column, n: Column, keys: list[Column], rounds: int = ROUNDS) -> Column:
    """Where a pseudorandom permutation of 0 .. n-1 (swap-or-not rounds) sends ``position``."""

    def step(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*keys, r, F.lit("key")), n) - x, n)
        swap = F.pmod(F.xxhash64(*keys, r, F.greatest(x, other)), F.lit(2)) == 1
        return F.when(swap, other).otherwise(x)

    return F.aggregate(F.array(*[F.lit(r) for r in range(rounds)]), position.cast("long"), step)


def slot_totals(targets: DataFrame, block_words: int, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source that gets slots: ord, blocks, total (its slots), slots (those of all sources)."""
    everything = Window.partitionBy()  # one row per source
    by_part = Window.orderBy(F.desc("_part"), "ord")
    want = F.least(F.col("target") * F.col("blocks") / F.col("source_size"), (F.col("blocks") * max_repeats).cast("double"))
    return (
        targets.filter("source_size > 0")
        .withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
        .withColumn("_want", want)
        .withColumn("_whole", F.floor("_want"))
        .withColumn("_part", F.col("_want") - F.col("_whole"))
        .withColumn("_up", F.row_number().over(by_part) <= F.round(F.sum("_part").over(everything)))
        .withColumn("total", F.col("_whole") + F.col("_up").cast("long"))
        .withColumn("slots", F.sum("total").over(everything))
        .filter("total > 0")
        .select("ord", "blocks", "total", "slots")
    )


def draw_slots(totals: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """One row per slot of the mix: ord, shard, place (in the shard), repeat (pass number), block.

    ``totals``: :func:`slot_totals`.
    """
    before = Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)  # one row per source
    numbered = totals.withColumn("_before", F.coalesce(F.sum("total").over(before), F.lit(0)))
    # Few rows unfold to many: in two steps, dealt over the tasks between them.
    chunks = numbered.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / CHUNK))).alias("_chunk"))
    n = int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = F.least(F.lit(CHUNK).cast("long"), F.col("total") - F.col("_chunk") * CHUNK)
    t = F.col("_chunk") * CHUNK + F.col("_i")
    slots = (
        chunks.repartition(n, "ord", "_chunk")
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), most - 1)).alias("_i"))
        .withColumn("_t", t)
        .withColumn("repeat", F.floor(F.col("_t") / F.col("blocks")).cast("int"))
    )
    block = permuted(F.col("_t") % F.col("blocks"), F.col("blocks"), [F.lit(seed), F.col("ord"), F.col("repeat")])
    dealt = permuted(F.col("_before") + F.col("_t"), F.col("slots"), [F.lit(seed), F.lit("deal")])
    return slots.select("ord", "repeat", block.alias("block"), dealt.alias("_p")).select(
        "ord", F.floor(F.col("_p") / shard_slots).alias("shard"), (F.col("_p") % shard_slots).alias("place"), "repeat", "block"
    )


def draw_counts(targets: DataFrame, block_words: int, shard_slots: int, seed: int, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per (shard, source) with slots: ord, shard, count, first (the source's slots in earlier shards)."""
    slots = draw_slots(slot_totals(targets, block_words, max_repeats), shard_slots, seed)
    counts = slots.groupBy("ord", "shard").agg(F.count(F.lit(1)).alias("count"))
    earlier = Window.partitionBy("ord").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return counts.withColumn("first", F.coalesce(F.sum("count").over(earlier), F.lit(0)).cast("long"))


def document_blocks(sized: DataFrame, targets: DataFrame, key: str, block_words: int) -> tuple[DataFrame, DataFrame]:
    """(placed, covers): documents with their first word's position in the source, and
    one row per (document, block) with the first covered word and the number of words."""
    known = bounded_broadcast(targets, max_rows=100_000)
    placed = sized.join(known, sized["source"].eqNullSafe(known["source"])).drop(known["source"])
    columns = ["ord", "source", "source_size", "target"]
    offsets = running_offset(placed.select("ord", key, "size"), ["ord"], [key], "size", "start")
    again = offsets.join(bounded_broadcast(targets.select(*columns), max_rows=100_000), "ord")
    full = again.filter("size > 0")
    covers = full.select(
        "*",
        F.explode(
            F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words))
        ).alias("block"),
    )
    begin = F.greatest(F.col("start"), F.col("block") * block_words)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return again, covers.withColumn("from_word", begin - F.col("start")).withColumn("words", end - begin)


def mix(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    max_repeats: int = MAX_REPEATS,
    seed: int = 17,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(placed, covers, slots) of the mix; see the module's text."""
    narrow = df.select(F.col(key).alias(key), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    sized = shared_table(narrow, "mix-sizes")  # one pass over the texts
    targets = shared_table(source_targets(sized, max_repeats).coalesce(1), "mix-targets")
    placed, covers = document_blocks(sized, targets, key, block_words)
    slots = draw_slots(slot_totals(targets, block_words, max_repeats), shard_slots, seed)
    return placed, covers, slots


def taken_words(df: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """One row per row of ``df``: key, size, source_size, target, taken, and first_shard, the first
    output shard that holds words of it (null if none does)."""
    placed, covers, slots = mix(df, key=key, **options)
    times = slots.groupBy("ord", "block").agg(F.count(F.lit(1)).alias("_times"), F.min("shard").alias("_shard"))
    # Unfolded slots look small to the planner; they are not, so no broadcast.
    joined = covers.join(times.hint("merge"), ["ord", "block"], "left")
    columns = [key, "size", "source_size", "target"]
    some = joined.groupBy("ord", "start", *columns).agg(
        F.sum(F.col("words") * F.coalesce(F.col("_times"), F.lit(0))).alias("taken"), F.min("_shard").alias("first_shard")
    )
    none = placed.filter("size = 0").select(*columns, F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("first_shard"))
    return some.select(*columns, "taken", "first_shard").unionByName(none)


def mixed_documents(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix as documents: for every pass that takes words of a document, one row
    with the document's columns and, as text, the words taken in that pass.

    A pass that takes the whole document keeps its text as it is; otherwise the
    covered runs of words are kept with the white space that follows them. The
    number of words of a document over all its rows is its ``taken``.
    ``n_chars``, if there, is set anew. Rows that share key and size share what
    is taken of each other (the sum over them is right).
    """
    placed, covers, slots = mix(df, key=key, text=text, source=source, **options)
    runs = (
        covers.join(slots.select("ord", "block", "repeat").hint("merge"), ["ord", "block"])
        .groupBy("ord", "start", key, "source", "size", "repeat")
        .agg(
            F.sum("words").alias("_words"),
            F.sort_array(F.collect_list(F.struct("from_word", "words"))).alias("_runs"),  # at most the document's own blocks
        )
        .drop("ord")
    )
    # The input's columns travel as one struct, so none can clash with those made here.
    # Repeated (key, source, size) rows: number them on both sides, so that each
    # place in the source meets one row.
    full = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.col(key).alias("own_key"), F.col(source).alias("own_source"), F.col(text).alias("own_text"), word_count(F.col(text)).alias("own_size"),
    ).filter("own_size > 0")
    pieces = runs.withColumn("_nth", F.dense_rank().over(Window.partitionBy(key, "source", "size").orderBy("start")))
    marked = full.withColumn("own_nth", F.lit(1))
    repeated = runs.select(key, "source", "size", "start").distinct().groupBy(key, "source", "size").count().filter("count > 1")
    if not repeated.isEmpty():
        hashed = full.withColumn("own_hash", F.xxhash64("row"))
        marked = hashed.withColumn("own_nth", F.row_number().over(Window.partitionBy("own_key", "own_source", "own_size").orderBy("own_hash")))
    p = pieces.select(F.col(key).alias("_key"), F.col("source").alias("_src"), F.col("size").alias("_sz"), "_nth", "_words", "_runs")
    joined = marked.join(
        p,
        marked["own_key"].eqNullSafe(p["_key"]) & marked["own_source"].eqNullSafe(p["_src"])
        & (marked["own_size"] == p["_sz"]) & (marked["own_nth"] == p["_nth"]),
    )
    tokens = F.regexp_extract_all(F.col("own_text"), F.lit(f"{WORD}({GAP})?"), F.lit(0))
    cut = F.transform(
        F.array(tokens),
        lambda t: F.array_join(
            F.flatten(F.transform(F.col("_runs"), lambda r: F.slice(t, (r["from_word"] + 1).cast("int"), r["words"].cast("int")))), ""
        ),
    )[0]
    new = joined.select("row", F.when(F.col("_words") == F.col("own_size"), F.col("own_text")).otherwise(cut).alias("new_text"))
    made = {text: F.col("new_text")}
    if "n_chars" in df.columns:
        made["n_chars"] = F.length("new_text").cast(df.schema["n_chars"].dataType)
    return new.select(*[made.get(c, F.col("row").getField(c)).alias(c) for c in df.columns])
