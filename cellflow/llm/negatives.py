"""Hard negatives by inner product, from an R-tree packed sort-tile-recursively.

Vectors become whole numbers, so scores are exact. Rows are dealt to tiles: the range of the coordinate that varies most is cut into slabs and
each slab by the next coordinate, at cuts taken from a bounded sample; a tile with too many rows (equal vectors, for one) is
split by a hash of the id. Cuts decide which rows share a tile and nothing else. In a tile the rows are packed into leaves by label, then
by coordinates, and leaves into nodes. The bounding box of a node gives an interval of every coordinate, and so one of
the inner product with an anchor.

An anchor keeps a queue of nodes, the largest upper bound first. A node is left out if no score window of the anchor meets its
interval, if its upper bound is strictly below the kth score found in every window that is full, or if it has no row of a wanted label. Positives
are the search with one open window among rows of the anchor's label, negatives the search with a window for each
positive score among rows of other labels. Both are exact: recall is 1.

Anchors are sent to every tile and read there in a stream, so a task holds the rows of one tile and a batch of anchors. The best of every tile
are ranked once more by anchor.

Defined cases: rows with a null id, label or vector, with a null or non-finite component, or with a length other than the most common
take no part, nor do rows with a component so large that a score might leave the range of bigints. Of rows that repeat an id, the
one with the smallest label, then the smallest vector, counts. Ties go to the smaller id. Anchors without a positive, and positives
without a negative, give no rows; an empty table gives none. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellflow.llm.common import quoted, stored

POSITIVES, NEGATIVES = 5, 3
#: A negative has from LOW to HIGH hundredths of the score of the positive; components are whole numbers of parts of one.
LOW, HIGH, SCALE = 50, 95, 256
#: Rows of the sample for cuts, rows of a tile, and tiles that cuts make; more rows make more parts of a tile.
SAMPLE, TILE, MOST_TILES = 8192, 8192, 4096
#: Anchors that one task answers in a tile.
ANCHORS = 1 << 16
#: Rows of a leaf and members of a node.
LEAF, FAN = 256, 8
#: Sums below are exact in doubles.
EXACT = 1 << 53


def largest(size: int) -> int:
    """Components up to this give scores, and hundredths of them, in the range of bigints."""
    return int(min((1 << 31) - 1, np.sqrt((1 << 56) / max(1, size))))


def tiled(order: np.ndarray, values: list[np.ndarray], leaf: int) -> list[np.ndarray]:
    """Sort-tile-recursive packing of rows into leaves: slabs by the first values, and so on."""
    if len(order) <= leaf:
        return [order] if len(order) else []
    order = order[np.argsort(values[0][order], kind="stable")]
    slabs = -(-len(order) // leaf)
    if len(values) > 1:
        slabs = int(np.ceil(slabs ** (1 / len(values))))
    out = []
    for slab in np.array_split(order, slabs):
        out += tiled(slab, values[1:], leaf) if len(values) > 1 else [slab]
    return out


class Tree:
    """Boxes of leaves and of the nodes above, level by level; the last level is the root."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        spread = vectors.var(axis=0) if len(vectors) else np.zeros(vectors.shape[1])
        axes = [vectors[:, c] for c in np.argsort(-spread, kind="stable")[:2]] or [ids]
        by_label = np.argsort(labels, kind="stable")
        names, begin, n = np.unique(labels[by_label], return_index=True, return_counts=True)
        large = n >= leaf
        leaves = [x for b, m in zip(begin[large], n[large], strict=True) for x in tiled(by_label[b:b + m], axes, leaf)]
        rest = by_label[np.repeat(~large, n)]  # labels that fill no leaf share leaves
        leaves += [x for x in np.array_split(rest, max(1, -(-len(rest) // leaf))) if len(x)]
        order = np.concatenate(leaves)
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order].astype(np.float64)
        self.whole = vectors[order].astype(np.int64)
        self.ends = np.cumsum([0, *map(len, leaves)])
        self.most = int(np.abs(self.whole).max(initial=0))
        at = self.ends[:-1]
        low, high = np.minimum.reduceat(self.whole, at, axis=0), np.maximum.reduceat(self.whole, at, axis=0)
        first, last = np.minimum.reduceat(self.labels, at), np.maximum.reduceat(self.labels, at)
        self.levels = [(low, high, first, last)]
        self.fan = fan
        while len(low) > 1:
            at = np.arange(0, len(low), fan)
            low, high = np.minimum.reduceat(low, at, axis=0), np.maximum.reduceat(high, at, axis=0)
            first, last = np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)
            self.levels.append((low, high, first, last))

    def bounds(self, anchors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per level the least and the largest possible score of every anchor (row) with every node (column)."""
        exact = self.most * int(np.abs(anchors).max(initial=0)) * anchors.shape[1] < EXACT
        kind = np.float64 if exact else np.int64
        up, down = np.maximum(anchors, 0).astype(kind), np.minimum(anchors, 0).astype(kind)
        return [
            (up @ low.T.astype(kind) + down @ high.T.astype(kind), up @ high.T.astype(kind) + down @ low.T.astype(kind))
            for low, high, _, _ in self.levels]

    def scores(self, leaf: int, anchor: np.ndarray) -> np.ndarray:
        rows = slice(self.ends[leaf], self.ends[leaf + 1])
        if self.most * int(np.abs(anchor).max(initial=0)) * len(anchor) < EXACT:
            return (self.vectors[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.whole[rows] @ anchor


class Search:
    """Best-first search of an anchor in a tree, with k rows for every window of scores."""

    def __init__(self, tree: Tree, k: int, same: bool):
        self.tree, self.k, self.same = tree, k, same

    def wanted(self, level: int, node: int, label: int) -> bool:
        _, _, first, last = self.tree.levels[level]
        return first[node] <= label <= last[node] if self.same else not first[node] == label == last[node]

    def run(self, number: int, anchor: np.ndarray, label: int, bounds, row: int, low: np.ndarray, high: np.ndarray) -> list[list[tuple[int, int]]]:
        """Per window its best (-score, id), best first."""
        tree, k = self.tree, self.k
        found: list[list[tuple[int, int]]] = [[] for _ in low]
        least = low.copy()  # what a score must reach, by window: its lower end, then the kth score
        top = len(tree.levels) - 1
        queue = [(-int(bounds[top][1][row, 0]), top, 0)]
        while queue:
            upper, level, node = heapq.heappop(queue)
            if not len(least) or -upper < least.min():
                break  # all others in the queue end lower
            reach = (-upper >= least) & (int(bounds[level][0][row, node]) <= high)
            if not reach.any() or not self.wanted(level, node, label):
                continue
            if level:
                below, above = bounds[level - 1][0][row], bounds[level - 1][1][row]
                for child in range(node * tree.fan, min((node + 1) * tree.fan, len(tree.levels[level - 1][0]))):
                    if self.wanted(level - 1, child, label) and ((above[child] >= least) & (below[child] <= high)).any():
                        heapq.heappush(queue, (-int(above[child]), level - 1, child))
                continue
            rows = slice(tree.ends[node], tree.ends[node + 1])
            score, ids = tree.scores(node, anchor), tree.ids[rows]
            fits = ((tree.labels[rows] == label) == self.same) & (score >= least.min()) & (score <= high.max()) & (ids != number)
            at = np.flatnonzero(fits)
            if not len(at):
                continue
            score, ids = score[at], ids[at]
            for w in np.flatnonzero(reach):
                mine = np.flatnonzero((score >= least[w]) & (score <= high[w]))
                if not len(mine):
                    continue
                if len(mine) > k:
                    mine = mine[np.lexsort((ids[mine], -score[mine]))[:k]]
                own = sorted([*found[w], *zip((-score[mine]).tolist(), ids[mine].tolist(), strict=True)])[:k]
                found[w] = own
                if len(own) == k:
                    least[w] = max(least[w], -own[-1][0])
        return found


#: What a tile's task reads: its rows (score null), then anchors, with the scores of their positives if they look for negatives.
TILED = "tile int, part int, block int, ask boolean, vec_id bigint, label bigint, vector binary, scores array<bigint>"
FOUND = "anchor_id bigint, wanted bigint, vec_id bigint, score bigint"


def windows(scores: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the windows of negatives, both included."""
    return np.array([-(-LOW * s // 100) for s in scores], dtype=np.int64), np.array([HIGH * s // 100 for s in scores], dtype=np.int64)


def answers(k: int, same: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of ``TILED``, sorted by tile, part, block and ask, to ``FOUND``: per anchor and positive score the best k of the tile."""

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        flat = np.frombuffer(b"".join(batch.column(6).to_pylist()), dtype="<i4")
        return flat.reshape(batch.num_rows, -1).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, search = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(4)])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                own, part = tuple(keys[:3, lo].tolist()), batch.slice(lo, hi - lo)
                if own != key:
                    key, held, search = own, [], None
                if not keys[3, lo]:
                    held.append(part)
                    continue
                if search is None and held:
                    table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    search = Search(Tree(table.column(4).to_numpy(), table.column(5).to_numpy(), matrix(table)), k, same)
                    held = []
                if search is None:
                    continue
                out: list[tuple[int, int | None, int, int]] = []
                anchors = matrix(part)
                bounds = search.tree.bounds(anchors)
                rows = zip(part.column(4).to_pylist(), part.column(5).to_pylist(), part.column(7).to_pylist(), strict=True)
                for row, (number, label, scores) in enumerate(rows):
                    if scores is None:
                        ends = np.full(1, -EXACT << 9), np.full(1, EXACT << 9)
                    else:
                        ends = windows(scores)
                        open_ = ends[0] <= ends[1]
                        scores, ends = [s for s, o in zip(scores, open_, strict=True) if o], (ends[0][open_], ends[1][open_])
                    found = search.run(number, anchors[row], label, bounds, row, *ends)
                    for w, best in enumerate(found):
                        out += [(number, None if scores is None else scores[w], i, -s) for s, i in best]
                columns = list(zip(*out, strict=True)) if out else [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor_id", "wanted", "vec_id", "score"])

    return run


@dataclass
class Tiles:
    """Cuts of two coordinates, from a sample."""

    axes: tuple[int, int]
    slabs: np.ndarray
    cuts: list[np.ndarray]

    def of(self, vectors: np.ndarray) -> np.ndarray:
        slab = np.searchsorted(self.slabs, vectors[:, self.axes[0]], side="right")
        width = len(self.cuts[0]) + 1
        out = np.zeros(len(vectors), dtype=np.int32)
        for s in np.unique(slab):
            own = slab == s
            out[own] = s * width + np.searchsorted(self.cuts[s], vectors[own, self.axes[1]], side="right")
        return out

    @property
    def count(self) -> int:
        return len(self.cuts) * (len(self.cuts[0]) + 1)


def fitted(sample: np.ndarray, total: int) -> Tiles:
    tiles = int(min(MOST_TILES, -(-total // TILE)))
    slabs = int(np.ceil(np.sqrt(tiles)))
    width = -(-tiles // slabs)
    axes = np.argsort(-sample.var(axis=0), kind="stable")[:2] if sample.shape[1] else np.zeros(0, int)
    if len(axes) < 2:
        axes = np.resize(axes, 2) if len(axes) else axes
    if not len(axes):
        return Tiles((0, 0), np.zeros(0), [np.zeros(0)])
    at = lambda values, parts: np.quantile(values, np.arange(1, parts) / parts)
    first, second = sample[:, axes[0]], sample[:, axes[1]]
    ends = at(first, slabs)
    of = np.searchsorted(ends, first, side="right")
    cuts = [at(second[of == s] if (of == s).any() else second, width) for s in range(slabs)]
    return Tiles((int(axes[0]), int(axes[1])), ends, cuts)


def usable(vectors: DataFrame, id_column: str, label: Column, vector: str) -> tuple[DataFrame, int]:
    """(vec_id, label, vector as bytes of whole numbers) of the rows that take part, and the number of components."""
    rows = vectors.select(
        F.col(quoted(id_column)).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
        F.col(quoted(vector)).cast("array<double>").alias("v")).where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    size = common["n"] if common else 0
    most = largest(size)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(batch.column(2)), size)
            with np.errstate(over="ignore", invalid="ignore"):
                numbers = np.floor(table * SCALE)
                good = (np.isfinite(table) & (np.abs(numbers) <= most)).all(axis=1)
            packed = [row.tobytes() for row in numbers[good].astype("<i4")]
            mask = pa.array(good)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(mask), batch.column(1).filter(mask), pa.array(packed, pa.binary())], ["vec_id", "label", "vector"])

    same = rows.where((F.size("v") == size) & ~F.exists("v", lambda x: x.isNull()))
    cleaned = same.mapInArrow(whole, "vec_id bigint, label bigint, vector binary")
    one = cleaned.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.label", "row.vector")
    return stored(one, "vectors"), size


def hard_negatives(
    vectors: DataFrame, anchors: str, label: Column, id_column: str = "vec_id", vector: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    anchors: SQL condition on ``vec_id`` of the rows that look for negatives.
    """
    spark = vectors.sparkSession
    rows, size = usable(vectors, id_column, label, vector)
    total = rows.count()
    result = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not total:
        return spark.createDataFrame([], result)
    sample = rows.select("vector", "vec_id").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    tiles = fitted(np.stack([np.frombuffer(r["vector"], dtype="<i4") for r in sample]).astype(np.float64), total)
    sent = spark.sparkContext.broadcast(tiles)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype="<i4").reshape(batch.num_rows, size)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sent.value.of(flat))], [*batch.schema.names, "tile"])

    base = stored(rows.mapInArrow(dealt, "vec_id bigint, label bigint, vector binary, tile int"), "tiles")
    ask = stored(rows.where(anchors), "anchors")
    blocks = -(-ask.count() // ANCHORS)
    many = {r["tile"]: -(-r["count"] // TILE) for r in base.groupBy("tile").count().collect()}  # a row for each tile
    parts = F.get(F.array(*[F.lit(many.get(t, 0)) for t in range(tiles.count)]), F.col("tile"))
    hashed = F.xxhash64("vec_id")
    placed = base.select(
        "tile", F.pmod(hashed, parts).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(max(1, blocks) - 1))).alias("block"),
        F.lit(False).alias("ask"), "vec_id", "label", "vector", F.lit(None).cast("array<bigint>").alias("scores"))

    def searched(asking: DataFrame, k: int, same: bool) -> DataFrame:
        """The k best of all tiles, by anchor and positive score, with their ``rank``."""
        to_tiles = asking.withColumn("tile", F.explode(F.array(*[F.lit(t) for t in sorted(many)]))).withColumn(
            "part", F.explode(F.sequence(F.lit(0), parts - 1)))
        to_tiles = to_tiles.select(
            "tile", F.col("part").cast("int").alias("part"), F.pmod(hashed, F.lit(max(1, blocks))).cast("int").alias("block"), F.lit(True).alias("ask"),
            "vec_id", "label", "vector", "scores")
        order = ["tile", "part", "block", "ask"]
        found = placed.unionByName(to_tiles).repartition(*order[:3]).sortWithinPartitions(*order).mapInArrow(answers(k, same), FOUND)
        best = Window.partitionBy("anchor_id", "wanted").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    close = stored(searched(ask.withColumn("scores", F.lit(None).cast("array<bigint>")), positives, True), "positives").select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    scores = close.groupBy("anchor_id").agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))
    far = stored(searched(ask.join(scores, F.col("vec_id") == F.col("anchor_id")), negatives, False), "negatives").select(
        "anchor_id", F.col("wanted").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return close.join(far, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
