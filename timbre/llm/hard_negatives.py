"""Hard negatives: vantage-point trees over norm-augmented vectors, walked nearest first inside a distance annulus.

The components of a vector are stored as floor(256 x), so inner products (scores)
and squared distances are whole numbers. With one more component,
sqrt(M - |x|^2) for rows and 0 for anchors, where M is the tree's greatest
squared norm, all rows lie on a sphere, and so does an anchor once it is
stretched by c to the norm sqrt(M), which changes no order: its squared distance
from a row x is 2 M - 2 c q.x. Higher scores are nearer, and a window of scores is
an annulus of distances. A walk keeps nodes (by the least distance that their rows may have)
and rows (by distance, then id) in one heap and yields rows in order; nodes
outside the annulus are never opened.

Rows are dealt to shards by a hash of the id, each with a tree of its own; all
anchors, in blocks, ask every shard for their first k rows, and the first k of
those are the answer. A shard and a block of anchors are both bounded, whatever
the tables hold, so no vector or label makes a task larger than others. The
answer is exact.

Edge cases: rows with a null id, label or vector, or with a null or non-finite
component take no part; nor do rows whose stored squared norm is above 2^52,
whose scores no double holds exactly. Vectors shorter than the longest have zeros
for what they lack. Rows of equal score are ranked by the id; rows that repeat
an id are rows of their own (but never each other's positives), and repeated
anchors of equal label and vector are one anchor. An empty table gives no rows.
Only the three columns are read, so others can't clash.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timbre.llm.common import fresh_path, narrow


@dataclass(frozen=True)
class MineRule:
    """What is mined, and the sizes of a shard, a block of anchors and a leaf (which don't change the result)."""

    scale: int = 256
    anchor_every: int = 100
    relabel_every: int = 7
    labels: int = 10
    positives: int = 5
    negatives: int = 10
    least_percent: int = 30
    most_percent: int = 90
    shard_rows: int = 8192
    block_anchors: int = 4096
    leaf_rows: int = 256


MAX_NORM = 1 << 52
HITS = pa.schema([("anchor", pa.int64()), ("win", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


class VantageTree:
    """Rows in leaf order with the nodes of a vantage-point tree over their augmented vectors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaf_rows: int):
        order = np.lexsort((labels, ids))
        self.ids, self.labels, x = ids[order], labels[order], vectors[order]
        norms = (x * x).sum(axis=1)
        self.most = float(norms.max())  # M
        wide = np.column_stack([x, np.sqrt(self.most - norms)])
        # A node is (first, last, vantage, least and greatest distance of its rows from the vantage of the split above it, inner, outer).
        self.vantage, self.nodes, place = [], [], np.arange(len(x))
        todo = [(0, len(x), -1, 0.0, math.inf)]
        while todo:
            first, last, parent, least, most = todo.pop()
            me = len(self.nodes)
            self.nodes.append([first, last, parent, least, most, -1, []])
            if parent >= 0:
                self.nodes[parent][6].append(me)
            if last - first <= leaf_rows:
                continue
            rows = place[first:last]
            center = wide[rows].mean(axis=0)
            chosen = rows[np.argmax(((wide[rows] - center) ** 2).sum(axis=1))]  # far out, so that shells are thin
            gaps = np.sqrt(((wide[rows] - wide[chosen]) ** 2).sum(axis=1))
            by = np.argsort(gaps, kind="stable")
            place[first:last], gaps = rows[by], gaps[by]
            half = (last - first) // 2
            self.nodes[me][5] = len(self.vantage)
            self.vantage.append(wide[chosen])
            todo.append((first + half, last, me, gaps[half], gaps[-1]))
            todo.append((first, first + half, me, gaps[0], gaps[half - 1]))
        self.ids, self.labels, self.x = self.ids[place], self.labels[place], x[place]
        self.vantage = np.array(self.vantage).reshape(-1, wide.shape[1])

    def stretches(self, anchors: np.ndarray) -> np.ndarray:
        """What each anchor is stretched by; a null vector by nothing."""
        norms = np.sqrt((anchors * anchors).sum(axis=1))
        return np.divide(math.sqrt(self.most), norms, out=np.ones(len(norms)), where=norms > 0)

    def gaps(self, anchors: np.ndarray) -> np.ndarray:
        """Distances of stretched anchors (rows) from all vantage points (columns)."""
        q = (anchors * anchors).sum(axis=1)
        v = (self.vantage * self.vantage).sum(axis=1)
        return np.sqrt(np.maximum(0.0, q[:, None] + v[None, :] - 2 * anchors @ self.vantage[:, :-1].T))


class Walk:
    """Nearest-first walks of one anchor over the rows that ``fits`` takes; a leaf is scored once for all of its windows."""

    def __init__(self, tree: VantageTree, anchor: np.ndarray, stretch: float, gaps: np.ndarray, fits: Callable[[slice], np.ndarray]):
        self.tree, self.anchor, self.stretch, self.gaps, self.fits, self.leaves = tree, anchor, float(stretch), gaps.tolist(), fits, {}
        self.total = tree.most + stretch * stretch * float(anchor @ anchor)
        self.slack = 1e-6 * (1.0 + math.sqrt(self.total))  # far above rounding, far below what a node spans

    def square(self, score: float) -> float:
        """The squared distance of a row of that score."""
        return max(0.0, self.total - 2 * self.stretch * score)

    def leaf(self, node: int) -> tuple[list[float], list[int]]:
        """Negated scores and ids of a leaf's fitting rows, nearest first."""
        if node not in self.leaves:
            first, last = self.tree.nodes[node][:2]
            keep = self.fits(slice(first, last))
            less, ids = -(self.tree.x[first:last] @ self.anchor)[keep], self.tree.ids[first:last][keep]
            by = np.lexsort((ids, less))
            self.leaves[node] = less[by].tolist(), ids[by].tolist()
        return self.leaves[node]

    def nearest(self, least: float, most: float) -> Iterator[tuple[int, int]]:
        """(id, score) of rows with a score in [least, most], highest scores first, then by id."""
        inner = math.sqrt(self.square(most)) - self.slack if most < math.inf else 0.0
        outer = math.sqrt(self.square(least)) + self.slack if least > -math.inf else math.inf
        # (squared distance, 0, node, its least and greatest distance) or (squared distance, 1, -score, id, number, place in the leaf, its end, leaf).
        heap: list = [(0.0, 0, 0, 0.0, math.inf)]
        number, pop, push = count(), heapq.heappop, heapq.heappush
        while heap:
            _, is_row, node, near, *rest = pop(heap)
            if is_row:
                yield near, int(-node)
                _, at, end, leaf = rest
                at += 1
            elif (vantage := self.tree.nodes[node][5]) < 0:
                leaf = self.leaf(node)
                at, end = bisect_left(leaf[0], -most), bisect_right(leaf[0], -least)
            else:
                gap, (wide,) = self.gaps[vantage], rest
                for child in self.tree.nodes[node][6]:
                    low, high = self.tree.nodes[child][3:5]
                    lower, upper = max(near, gap - high - self.slack, low - gap - self.slack), min(wide, gap + high + self.slack)
                    if lower <= outer and upper >= inner:
                        push(heap, (max(lower, inner, 0.0) ** 2, 0, child, lower, upper))
                continue
            if at < end:
                push(heap, (self.square(-leaf[0][at]), 1, leaf[0][at], leaf[1][at], next(number), at, end, leaf))


def first_of(walk: Iterator[tuple[int, int]], k: int) -> list[tuple[int, int]]:
    return list(islice(walk, k))


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    raw = b"".join(v.as_py() for v in column)
    return np.frombuffer(raw, "<i4").reshape(-1, dims).astype(np.float64)


def shard_hits(rows: pa.Table, anchors: pa.Table, dims: int, rule: MineRule, windows: bool) -> pa.Table:
    """First rows of one shard for a block of anchors: of their label, or (``windows``) of other labels inside each window of scores."""
    if not rows.num_rows or not anchors.num_rows:
        return HITS.empty_table()
    tree = VantageTree(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), matrix(rows["vector"], dims), rule.leaf_rows)
    asked = matrix(anchors["vector"], dims)
    stretches, hits = tree.stretches(asked), []
    gaps = tree.gaps(asked * stretches[:, None])
    names = zip(anchors["anchor"].to_pylist(), anchors["vec_id"].to_pylist(), anchors["label"].to_pylist(), anchors["scores"].to_pylist())
    for n, (anchor, vec_id, label, scores) in enumerate(names):
        if windows:
            walk = Walk(tree, asked[n], stretches[n], gaps[n], lambda s: tree.labels[s] != label)
            for win in sorted(set(scores)):
                least, most = -(-rule.least_percent * win // 100), rule.most_percent * win // 100
                if least <= most:
                    found = first_of(walk.nearest(least, most), rule.negatives)
                    hits += [(anchor, at, i, s) for at, own in enumerate(scores) if own == win for i, s in found]
        else:
            walk = Walk(tree, asked[n], stretches[n], gaps[n], lambda s: (tree.labels[s] == label) & (tree.ids[s] != vec_id))
            hits += [(anchor, 0, i, s) for i, s in first_of(walk.nearest(-math.inf, math.inf), rule.positives)]
    return pa.Table.from_pylist([dict(zip(HITS.names, h)) for h in hits], HITS)


def stored_rows(vectors: DataFrame, rule: MineRule) -> DataFrame:
    """vec_id, label and the stored vector (whole numbers, 4 bytes each) of the rows that take part, and its squared norm."""
    rows = narrow(vectors, vec_id="vec_id", label="label", embedding="embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    moved = F.when(F.col("vec_id") % rule.relabel_every == 0, (F.col("label") + 1) % rule.labels).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * rule.scale).cast("double"))
    rows = rows.select(F.col("vec_id").cast("long"), moved.cast("long").alias("label"), whole.alias("whole"))
    return rows.where(F.aggregate("whole", F.lit(0.0), lambda a, x: a + x * x) <= MAX_NORM)


def packed(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [np.asarray(v.as_py(), "<i4") for v in batch.column(2)]
        vectors = [np.pad(v, (0, dims - len(v))).tobytes() for v in vectors]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(vectors, pa.binary())], names=["vec_id", "label", "vector"])


def ask_shards(rows: DataFrame, anchors: DataFrame, dims: int, shards: int, blocks: int, rule: MineRule, windows: bool) -> DataFrame:
    """Hits of all anchors in all shards: shards times blocks of anchors are the tasks' groups."""
    pair = F.col("shard") * blocks + F.col("block")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(shards))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("pair", pair)
    asked = anchors.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks))).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("pair", pair)
    hits = partial(shard_hits, dims=dims, rule=rule, windows=windows)
    return rows.drop("shard", "block").groupBy("pair").cogroup(asked.drop("shard", "block").groupBy("pair")).applyInArrow(lambda r, a: hits(r, a), "anchor long, win int, vec_id long, score long")


def best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "win").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, rule: MineRule = MineRule()) -> DataFrame:
    """For each anchor and positive the first rows of other labels whose score lies in the window that the positive's score sets."""
    spark = vectors.sparkSession
    rows = stored_rows(vectors, rule)
    dims = rows.agg(F.max(F.size("whole"))).first()[0] or 0
    path = fresh_path(spark, "vectors")
    rows.mapInArrow(partial(packed, dims=dims), "vec_id long, label long, vector binary").write.parquet(path)
    rows = spark.read.parquet(path)
    anchors = rows.where(F.col("vec_id") % rule.anchor_every == 0).distinct()
    path = fresh_path(spark, "anchors")
    anchors.withColumn("anchor", F.monotonically_increasing_id()).write.parquet(path)
    anchors = spark.read.parquet(path)
    shards, blocks = max(1, -(-rows.count() // rule.shard_rows)), max(1, -(-anchors.count() // rule.block_anchors))
    empty = F.array().cast("array<long>")
    positives = best(ask_shards(rows, anchors.withColumn("scores", empty), dims, shards, blocks, rule, False), rule.positives)
    path = fresh_path(spark, "positives")
    positives.select("anchor", (F.col("rank") - 1).alias("win"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).write.parquet(path)
    positives = spark.read.parquet(path)
    listed = positives.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("win", "positive_score"))), lambda p: p["positive_score"]).alias("scores"))  # MineRule.positives at most
    found = best(ask_shards(rows, anchors.join(listed, "anchor"), dims, shards, blocks, rule, True), rule.negatives)
    names = anchors.select("anchor", F.col("vec_id").alias("anchor_id"))
    found = found.join(positives, ["anchor", "win"]).join(names, "anchor")
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
