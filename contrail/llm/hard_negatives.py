"""Hard-negative mining by exact inner-product search in STR-packed R-trees.

A row's components are scaled to whole numbers, so scores are exact integers.
For every anchor the best rows of its own label are its positives; for every
(anchor, positive) the best rows of other labels whose score lies between two
shares of the positive's score are its hard negatives.

Index: rows are dealt to tiles by sort-tile-recursive cuts (each slab is halved
at the median of the next widest coordinate). The cut values come from a bounded
sample of ``SAMPLE`` rows; every row is indexed. A tile of more than
``GROUP_ROWS`` rows is split further by a hash, so a group always fits a task.
In a task, a group's rows are STR-packed into pages of ``PAGE`` rows (by label,
then by tiles), pages into boxes of ``FANOUT``, up to one root. A box has the
least and greatest value of every coordinate, its labels' range and its least id.

Search: per coordinate, a box and an anchor give an interval of products, and the
sums of the interval ends bound the box's scores from both sides. A best-first
queue opens boxes by falling upper bound (cut off at the window's top), skips
boxes outside all score windows or without a usable label, and ends when the next
box is strictly below the k-th of every window, or as good but without a smaller
id. Anchors are streamed through every group in blocks (a query set against all
rows); a group's best k of a window are merged with a window function.

Rows of equal label and vector keep only the ids that can be returned (the
smallest of them, one more than the answer needs, the anchor's own being no
answer), cut before the shuffle, so copies of a vector may be any share of the
rows; the anchors are taken before that.

Defined results: rows with a null id, label or vector, or a null, NaN or
infinite component, take no part; a vector without elements scores 0; vectors of
different lengths have no product and never meet; equal rows count once; rows
with an anchor's own id are neither its positives nor its negatives; ties go to the
smaller id; an anchor without positives, or a positive without rows in its window,
gives no rows; an empty table gives no rows. Scores are longs; scaled components so large that
a product could leave the range of a long are an error. Columns besides the
three named ones are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import sample_by_hash, shared_table

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
WINDOW = (50, 95)  # percent of the positive's score, both ends included
SAMPLE = 65_536
TILES = 16  # at least; a power of two
GROUP_ROWS = 32_768
PAGE = 64
FANOUT = 16
BLOCK = 256  # anchors whose bounds are computed at once
LARGEST = 1 << 28  # scaled components beyond it are an error
EXACT = float(1 << 53)

FOUND = "anchor long, key long, nth int, id long, score long"


# -- packing and searching one group (numpy) ---------------------------------


def str_order(x: np.ndarray, page: int) -> np.ndarray:
    """Row order of sort-tile-recursive packing: coordinates by falling spread, slabs cut to whole pages."""
    order = np.arange(len(x))
    if len(x) <= page or not x.shape[1]:
        return order
    axes = np.argsort(-x.std(axis=0), kind="stable")
    stack = [(0, len(x), 0)]
    while stack:
        a, b, depth = stack.pop()
        pages, left = -(-(b - a) // page), len(axes) - depth
        if pages <= 1 or left <= 0:
            continue
        part = order[a:b]
        order[a:b] = part[np.argsort(x[part, axes[depth]], kind="stable")]
        slabs = int(np.ceil(round(pages ** (1.0 / left), 9)))
        step = max(1, -(-pages // slabs)) * page
        stack += [(at, min(b, at + step), depth + 1) for at in range(a, b, step)]
    return order


@dataclass
class Level:
    low: np.ndarray
    high: np.ndarray
    least_label: np.ndarray
    most_label: np.ndarray
    least_id: np.ndarray
    start: np.ndarray  # first child (a row of the group, or a box of the level below)
    end: np.ndarray


def boxes(starts: np.ndarray, n: int, low, high, least_label, most_label, least_id) -> Level:
    ends = np.append(starts[1:], n)
    return Level(
        np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts),
        np.minimum.reduceat(least_label, starts), np.maximum.reduceat(most_label, starts),
        np.minimum.reduceat(least_id, starts), starts, ends,
    )


class RTree:
    """An STR-packed R-tree over vectors of one length."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, page: int = PAGE, fanout: int = FANOUT):
        by_label = np.argsort(labels, kind="stable")
        runs = np.split(by_label, np.flatnonzero(np.diff(labels[by_label])) + 1)
        order = np.concatenate([run[str_order(x[run], page)] for run in runs])
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        n = len(order)
        level = boxes(np.arange(0, n, page), n, self.x, self.x, self.labels, self.labels, self.ids)
        self.levels = [level]
        while len(level.start) > 1:
            own = str_order((level.low + level.high) / 2.0, fanout)
            level = Level(*(getattr(level, f)[own] for f in level.__dataclass_fields__))
            self.levels[-1] = level
            m = len(level.start)
            level = boxes(np.arange(0, m, fanout), m, level.low, level.high, level.least_label, level.most_label, level.least_id)
            self.levels.append(level)

    def bounds(self, q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per level, (least, greatest) possible score of every (anchor of the block, box)."""
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        return [(up @ v.low.T + down @ v.high.T, up @ v.high.T + down @ v.low.T) for v in self.levels]

    def search(self, q, own_id: int, label: int, same: bool, windows: list[tuple[int, int]], k: int, bounds) -> list[list[tuple[int, int]]]:
        """The best k (score, id) of every window, best first. ``bounds`` are this anchor's rows of ``bounds()``."""
        best: list[list[tuple[int, int]]] = [[] for _ in windows]  # (-score, id), sorted
        live = [w for w in zip(windows, best) if w[0][0] <= w[0][1]]
        if not live:
            return best
        top = max(hi for (_, hi), _ in live)

        def useful(score_low, score_high, least_id) -> bool:
            for (lo, hi), found in live:
                if score_high < lo or score_low > hi:
                    continue
                if len(found) < k or (-min(score_high, hi), least_id) < found[-1]:
                    return True
            return False

        def meets(level: Level, i: int) -> bool:
            a, b = level.least_label[i], level.most_label[i]
            return a <= label <= b if same else not a == label == b

        root = len(self.levels) - 1
        queue = [(-min(bounds[root][1][0], top), int(self.levels[root].least_id[0]), root, 0)]
        while queue:
            negative, least_id, depth, i = heapq.heappop(queue)
            # Boxes come by falling upper bound, but windows end at different tops, so each box is tested again.
            if not useful(bounds[depth][0][i], bounds[depth][1][i], least_id):
                if all(len(f) == k and -negative < -f[-1][0] for _, f in live):
                    break
                continue
            level = self.levels[depth]
            a, b = int(level.start[i]), int(level.end[i])
            if depth:
                below, (low, high) = self.levels[depth - 1], bounds[depth - 1]
                for c in range(a, b):
                    if meets(below, c) and useful(low[c], high[c], below.least_id[c]):
                        heapq.heappush(queue, (-min(high[c], top), int(below.least_id[c]), depth - 1, c))
                continue
            scores = self.x[a:b] @ q
            usable = (self.labels[a:b] == label) == same
            usable &= self.ids[a:b] != own_id
            for (lo, hi), found in live:
                floor = max(lo, -found[-1][0]) if len(found) == k else lo
                hits = np.flatnonzero(usable & (scores >= floor) & (scores <= hi))
                if len(hits):
                    found += [(-int(scores[h]), int(self.ids[a + h])) for h in hits]
                    found.sort()
                    del found[k:]
        return [[(-s, i) for s, i in found] for found in best]


def as_matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def exact_dtype(*blocks: np.ndarray) -> type:
    """float64 (products in BLAS) where all sums stay exact, else int64."""
    most = [float(np.abs(b).max()) if b.size else 0.0 for b in blocks]
    return np.float64 if max(most) ** 2 * max(1, blocks[0].shape[1]) < EXACT else np.int64


def search_groups(batches: Iterator[pa.RecordBatch], same: bool, k: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (grp, dim, is_anchor): a group's rows first, then its anchors, in blocks."""
    grp, parts, tree, anchors = None, [], None, []

    def answer() -> Iterator[pa.RecordBatch]:
        nonlocal anchors, tree
        if not anchors or not parts:
            anchors = []
            return
        q = np.concatenate([m for m, _ in anchors])
        if tree is None:
            ids, labels, x = (np.concatenate([p[i] for p in parts]) for i in range(3))
            tree = RTree(ids, labels, x.astype(exact_dtype(x)))
        kind = exact_dtype(tree.x, q)
        if kind is np.int64 and tree.x.dtype != np.int64:
            tree = RTree(tree.ids, tree.labels, tree.x.astype(np.int64))
        q = q.astype(tree.x.dtype)
        meta = [m for _, rows in anchors for m in rows]
        anchors = []
        bounds = tree.bounds(q)
        out: dict[str, list[int]] = {"anchor": [], "key": [], "nth": [], "id": [], "score": []}
        for r, (key, own_id, label, windows) in enumerate(meta):
            own = [(low[r], high[r]) for low, high in bounds]
            for nth, found in enumerate(tree.search(q[r], own_id, label, same, windows, k, own)):
                for score, i in found:
                    for name, v in zip(out, (own_id, key, nth, i, score)):
                        out[name].append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, pa.int32() if name == "nth" else pa.int64()) for name, v in out.items()], names=list(out)
        )

    for batch in batches:
        groups = np.stack([batch["grp"].to_numpy(), batch["dim"].to_numpy(), batch["is_anchor"].to_numpy()], axis=1)
        cuts = [0, *(np.flatnonzero((np.diff(groups, axis=0) != 0).any(axis=1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            run = batch.slice(a, b - a)
            g, dim, is_anchor = groups[a].tolist()
            if (g, dim) != grp:
                yield from answer()
                grp, parts, tree = (g, dim), [], None
            x = as_matrix(run["x"], dim)
            if not is_anchor:
                parts.append((run["id"].to_numpy(), run["label"].to_numpy().astype(np.int64), x))
                continue
            windows = [[(w["lo"], w["hi"]) for w in ws] for ws in run["windows"].to_pylist()]
            rows = list(zip(run["key"].to_pylist(), run["id"].to_pylist(), run["label"].to_pylist(), windows))
            for at in range(0, len(rows), BLOCK):
                anchors.append((x[at : at + BLOCK], rows[at : at + BLOCK]))
                if sum(len(r) for _, r in anchors) >= BLOCK:
                    yield from answer()
    yield from answer()


# -- the distributed part ------------------------------------------------------


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * component), component as double; an error for values beyond ``LARGEST``."""

    def one(x: Column) -> Column:
        y = F.floor(x.cast("double") * scale)
        return F.when(F.abs(x.cast("double")) * scale > LARGEST, F.raise_error(F.lit("component too large for exact scores")).cast("long")).otherwise(y)

    return F.transform(vector, one)


def usable_rows(df: DataFrame, key: str, vector: str, label: Column, scale: int) -> DataFrame:
    """(id, label, dim, x) of the rows that take part, each once."""
    rows = df.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).alias("x"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).filter(
        F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    )
    return rows.select("id", "label", F.size("x").alias("dim"), scaled(F.col("x"), scale).alias("x")).distinct()


def tile_cuts(sample: np.ndarray, tiles: int) -> tuple[list[int], list[float]]:
    """(coordinate cut at each depth, cut value of every node of the halving tree, from node 1 on)."""
    depth = max(0, tiles.bit_length() - 1)
    if not len(sample) or not sample.shape[1]:
        return [], []
    axes = np.argsort(-sample.std(axis=0), kind="stable")[:depth].tolist()
    slabs, cuts = [np.arange(len(sample))], []
    for axis in axes:
        below = []
        for slab in slabs:
            v = sample[slab, axis]
            cut = float(np.median(v)) if len(v) else 0.0
            cuts.append(cut)
            below += [slab[v <= cut], slab[v > cut]]
        slabs = below
    return axes, cuts


def tile_of(x: Column, axes: list[int], cuts: list[float]) -> Column:
    """Number of the tile a vector falls into."""
    node = F.lit(1)
    if axes:
        table = F.array(*[F.lit(c) for c in cuts])
        for axis in axes:
            node = (node * 2 + (F.coalesce(F.get(x, F.lit(axis)), F.lit(0)).cast("double") > F.element_at(table, node)).cast("int")).cast("int")
    return node - (1 << len(axes))


def build_index(rows: DataFrame, keep: int, sample: int = SAMPLE, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, int]:
    """(rows with ``grp``, number of groups): every row in one group of bounded size.

    Of rows of equal label and vector the ``keep`` smallest ids stay.
    """
    nth = F.row_number().over(Window.partitionBy("label", "dim", "x").orderBy("id"))
    kept = shared_table(rows.withColumn("nth", nth).filter(F.col("nth") <= keep).drop("nth"), "rtree-rows")
    n = kept.count()
    picked = sample_by_hash(kept, F.struct("id", "label"), sample).select("dim", "x").toPandas()  # bounded by ``sample``
    dims = picked["dim"].mode()
    same = picked[picked["dim"] == dims.max()]["x"] if len(dims) else []
    points = np.stack([np.asarray(v, np.float64) for v in same]) if len(same) else np.empty((0, 0))
    tiles = TILES
    while tiles * group_rows < n and tiles * 16 < sample:
        tiles *= 2
    axes, cuts = tile_cuts(points, tiles)
    tiled = kept.withColumn("tile", tile_of(F.col("x"), axes, cuts))
    sizes = {r["tile"]: r["n"] for r in tiled.groupBy("tile").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per tile
    first, pieces, total = [], [], 0
    for t in range(1 << len(axes)):
        p = max(1, -(-sizes.get(t, 0) // group_rows))
        first.append(total)
        pieces.append(p)
        total += p
    # No longs as literals: a tile has at most 2^31 pieces.
    at = F.col("tile") + 1
    piece = F.pmod(F.xxhash64("id", "label"), F.element_at(F.array(*[F.lit(p) for p in pieces]), at))
    grp = F.element_at(F.array(*[F.lit(f) for f in first]), at) + piece
    return tiled.withColumn("grp", grp.cast("long")).drop("tile"), total


def best_of_groups(index: DataFrame, groups: int, anchors: DataFrame, same: bool, k: int) -> DataFrame:
    """(anchor, key, nth, id, score, rank): the best ``k`` rows of every window of every anchor, over all groups.

    ``anchors``: key, id, label, dim, x, windows (array of lo, hi).
    """
    null = "array<struct<lo:bigint,hi:bigint>>"
    rows = index.select("grp", "dim", F.lit(0).cast("long").alias("is_anchor"), F.lit(0).cast("long").alias("key"), "id", "label", "x",
                        F.array().cast(null).alias("windows"))
    asked = anchors.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("grp"),
        "dim", F.lit(1).cast("long").alias("is_anchor"), "key", "id", "label", "x", F.col("windows").cast(null).alias("windows"),
    )
    n = max(1, min(groups, 4 * int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    dealt = rows.unionByName(asked).withColumn("dim", F.col("dim").cast("long")).repartition(n, "grp")
    found = dealt.sortWithinPartitions("grp", "dim", "is_anchor").mapInArrow(lambda it: search_groups(it, same, k), FOUND)
    order = Window.partitionBy("anchor", "key", "nth").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    df: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the column ``id`` (the key as long).
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = shared_table(usable_rows(df, key, vector, label, scale), "rtree-usable")
    index, groups = build_index(rows, max(positives + 1, negatives + 1), group_rows=group_rows)
    index = shared_table(index, "rtree-index")
    anchors = shared_table(rows.filter(is_anchor).withColumn("key", F.xxhash64("id", "label", "x")), "rtree-anchors")
    whole = F.array(F.struct(F.lit(-(1 << 62)).alias("lo"), F.lit(1 << 62).alias("hi")))
    friends = shared_table(best_of_groups(index, groups, anchors.withColumn("windows", whole), True, positives), "rtree-positives")
    low, high = window
    # low * positive <= 100 * negative <= high * positive, in whole numbers.
    bounds = F.struct(
        F.ceil(F.col("score") * F.lit(low).cast("decimal(5,0)") / 100).cast("long").alias("lo"),
        F.floor(F.col("score") * F.lit(high).cast("decimal(5,0)") / 100).cast("long").alias("hi"),
    )
    asked = friends.groupBy("anchor", "key").agg(F.sort_array(F.collect_list(F.struct("rank", bounds.alias("w")))).alias("ws"))  # ``positives`` at most
    windows = asked.select(F.col("anchor").alias("id"), "key", F.transform("ws", lambda w: w["w"]).alias("windows"))
    with_windows = anchors.join(windows, ["id", "key"])
    hard = best_of_groups(index, groups, with_windows, False, negatives)
    positive = friends.select(
        "anchor", "key", (F.col("rank") - 1).alias("nth"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return (
        hard.select("anchor", "key", "nth", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(positive, ["anchor", "key", "nth"])
        .select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
