"""Nearest neighbours by a forest of random-projection trees.

Trees are fitted on a bounded sample: every inner node splits at right angles to the line between
two random vectors, moved to the means of their sides in a few rounds. All rows are then dealt to the leaves they fall
into, one per tree. A query walks all trees through one shared priority queue, ordered by how
far it lies on the wrong side of the splits on the way, and takes leaves until they hold enough
rows. Candidates of those leaves are ranked by exact distance; leaves report their nearest few,
and the reports are merged.

Neighbouring leaves of a tree form blocks of bounded size, in which vectors meet queries; a larger
leaf is cut into several blocks, so one with a third of all rows is many small groups. A block
reports once for each query that visits any of its leaves. Only the trees and the numbers of rows in their leaves, both
bounded by the sample, are sent to all tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathloom.storage import freeze

TREES = 12
LEAF = 256  # sampled rows per leaf at most
SAMPLE = 50_000  # rows that the trees are fitted on at most
SEARCH = 6_000  # rows that the leaves of a query hold at least, and as a share of all rows;
SEARCH_SHARE = 0.9  # trees overlap, so they hold fewer different ones
MEANS_ROWS, MEANS_ROUNDS = 200, 6
NEAREST = 10
BLOCK_ROWS = 16_384
SEED = 11


class Forest:
    """Trees as arrays: direction and offset per inner node, children, numbers of leaves."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = SEED):
        self.directions, self.offsets, self.children = [], [], []  # a child below zero is leaf -1 - child
        self.roots, self.leaves, self.first_leaves = [], 0, []
        rng = np.random.default_rng(seed)
        for _ in range(trees):
            self.first_leaves.append(self.leaves)
            self.roots.append(self._grow(vectors, np.arange(len(vectors)), leaf, rng))
        width = vectors.shape[1] if vectors.ndim == 2 else 0
        self.directions = np.array(self.directions, np.float64).reshape(-1, width)
        self.offsets = np.array(self.offsets, np.float64)

    def _grow(self, vectors: np.ndarray, rows: np.ndarray, leaf: int, rng: np.random.Generator) -> int:
        if len(rows) > leaf:
            for _ in range(5):
                drawn = vectors[rng.choice(rows, min(len(rows), MEANS_ROWS), replace=False)]
                a, b = drawn[0], drawn[1]
                for _ in range(MEANS_ROUNDS):
                    side = drawn @ (a - b) >= (a + b) @ (a - b) / 2
                    if side.all() or not side.any():
                        break
                    a, b = drawn[side].mean(axis=0), drawn[~side].mean(axis=0)
                norm = np.linalg.norm(a - b)
                if not norm > 0:
                    continue
                direction = (a - b) / norm
                offset = float((a + b) @ direction / 2)
                left = vectors[rows] @ direction < offset
                if len(rows) < 20 * left.sum() < 19 * len(rows):
                    node = len(self.offsets)
                    self.directions.append(direction)
                    self.offsets.append(offset)
                    self.children.append([0, 0])
                    self.children[node] = [self._grow(vectors, rows[left], leaf, rng), self._grow(vectors, rows[~left], leaf, rng)]
                    return node
        self.leaves += 1
        return -self.leaves

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree: (rows, trees)."""
        found = np.empty((len(vectors), len(self.roots)), np.int32)
        for tree, root in enumerate(self.roots):
            todo = [(root, np.arange(len(vectors)))]
            while todo:
                node, rows = todo.pop()
                if node < 0:
                    found[rows, tree] = -1 - node
                elif len(rows):
                    left = vectors[rows] @ self.directions[node] < self.offsets[node]
                    todo += [(self.children[node][0], rows[left]), (self.children[node][1], rows[~left])]
        return found

    def search(self, vector: np.ndarray, sizes: dict[int, int], least: int) -> list[int]:
        """Leaves in order of the shared queue until they hold at least ``least`` rows."""
        queue = [(0.0, root) for root in self.roots]
        heapq.heapify(queue)
        found, held = [], 0
        while queue and held < least:
            far, node = heapq.heappop(queue)
            if node < 0:
                if size := sizes.get(-1 - node, 0):
                    found.append(-1 - node)
                    held += size
                continue
            side = float(vector @ self.directions[node]) - self.offsets[node]
            near, other = self.children[node] if side < 0 else self.children[node][::-1]
            heapq.heappush(queue, (far, near))
            heapq.heappush(queue, (max(far, abs(side)), other))
        return found


def leaf_blocks(sizes: dict[int, int], first_leaves: list[int], block_rows: int = BLOCK_ROWS) -> dict[int, tuple[int, int]]:
    """The first block of every leaf and the number of its blocks. Leaves next to each other in
    one tree share a block while they fit; a larger leaf has blocks of its own."""
    found, block, room, starts = {}, -1, 0, set(first_leaves)
    for leaf in range(max(sizes, default=-1) + 1):
        room = 0 if leaf in starts else room
        rows = sizes.get(leaf, 0)
        parts = -(-rows // block_rows)
        if parts > 1:
            found[leaf], block, room = (block + 1, parts), block + parts, 0
        elif parts:
            block, room = (block, room - rows) if rows <= room else (block + 1, block_rows - rows)
            found[leaf] = (block, 1)
    return found


def usable(vector: Column) -> Column:
    """Whether a vector takes part: no nulls, only finite numbers, not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _leaves(forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(forest.value.leaves_of(_matrix(batch.column("vector"))).ravel())], names=["leaf"])

    return run


def _index(forest, blocks):
    """A row (block, leaf, vec_id, vector) for every tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, places = forest.value, blocks.value
        for batch in batches:
            leaves = own.leaves_of(_matrix(batch.column("vector"))).ravel()
            rows = np.repeat(np.arange(batch.num_rows), len(own.roots))
            ids = batch.column("vec_id").to_numpy()[rows]
            first, parts = np.array([places[x] for x in leaves.tolist()], np.int64).reshape(-1, 2).T
            with np.errstate(over="ignore"):
                mixed = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((first + mixed % parts).astype(np.int32)), pa.array(leaves), pa.array(ids), batch.column("vector").take(pa.array(rows))],
                                             names=["block", "leaf", "vec_id", "vector"])

    return run


def _visits(forest, sizes, blocks, least: int):
    """A row (block, leaves, vec_id, vector) for every block that a query visits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, places = forest.value, blocks.value
        for batch in batches:
            block, leaves, at = [], [], []
            for number, vector in enumerate(_matrix(batch.column("vector"))):
                met: dict[int, list[int]] = {}
                for leaf in own.search(vector, sizes.value, least):
                    first, parts = places[leaf]
                    for part in range(first, first + parts):
                        met.setdefault(part, []).append(leaf)
                block += met
                leaves += met.values()
                at += [number] * len(met)
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(leaves, pa.list_(pa.int32())), batch.column("vec_id").take(take),
                                              batch.column("vector").take(take)], names=["block", "leaves", "vec_id", "vector"])

    return run


def _rank(nearest: int):
    """The nearest rows of one block for every query that visits it."""
    def run(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if rows.num_rows and queries.num_rows:
            ids = rows.column("vec_id").to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, leaf, vectors = ids[order], rows.column("leaf").to_numpy()[order], _matrix(rows.column("vector").combine_chunks())[order]
            least = leaf.min()
            asked = zip(queries.column("vec_id").to_pylist(), queries.column("leaves").to_pylist(), _matrix(queries.column("vector").combine_chunks()))
            for query, leaves, vector in asked:
                visited = np.zeros(leaf.max() - least + 1, bool)
                visited[np.array([x - least for x in leaves if least <= x <= leaf.max()], np.int64)] = True
                seen = np.flatnonzero(visited[leaf - least] & (ids != query))
                far = np.sqrt(((vectors[seen] - vector) ** 2).sum(axis=1))
                best = np.argsort(far, kind="stable")[:nearest]  # ties: the smaller id
                out["query_id"] += [query] * len(best)
                out["vec_id"] += ids[seen[best]].tolist()
                out["score"] += far[best].tolist()
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()),
                         "score": pa.array(out["score"], pa.float64())})

    return run


def nearest_neighbours(vectors: DataFrame, is_query: Column, nearest: int = NEAREST, vec_id: str = "vec_id", vector: str = "embedding",
                       trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, search: int = SEARCH) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row with ``is_query`` (a condition on the
    id column) its nearest rows found, its own id left out, by Euclidean distance in double
    precision; ties go to the smaller id.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do
    rows with a null id; all others have the same length. Repeated rows of one id are one
    candidate if equal, and each may be found otherwise under its best distance. With at most
    ``search`` rows in all, every row is compared. An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    found = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"),
                           F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = freeze(found.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).distinct())
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # of equal vectors only the smallest ids can be among the nearest; cut before the shuffle, too
    copies = Window.partitionBy("vector").orderBy("vec_id")
    few = freeze(rows.select("vec_id", "vector").distinct().withColumn("n", F.row_number().over(copies)).where(F.col("n") <= nearest + 1).drop("n"))
    total = few.count()
    share = F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample / total))
    drawn = few if total <= sample else few.where(share)
    fitted = np.array([r.vector for r in drawn.orderBy("vec_id").limit(2 * sample).collect()], np.float64)
    forest = spark.sparkContext.broadcast(Forest(fitted, trees, leaf))
    per_leaf = few.mapInArrow(_leaves(forest), "leaf int").groupBy("leaf").count().collect()  # as many as leaves of the sample
    counts = {r["leaf"]: r["count"] for r in per_leaf}
    sizes = spark.sparkContext.broadcast(counts)
    blocks = spark.sparkContext.broadcast(leaf_blocks(counts, forest.value.first_leaves))
    least = trees * total if total <= search else max(search, round(SEARCH_SHARE * total), trees * (nearest + 1))

    kind = few.schema["vector"].dataType.simpleString()
    index = few.mapInArrow(_index(forest, blocks), f"block int, leaf int, vec_id long, vector {kind}")
    visits = rows.where("is_query").select("vec_id", "vector").mapInArrow(
        _visits(forest, sizes, blocks, least), f"block int, leaves array<int>, vec_id long, vector {kind}")
    reports = index.groupBy("block").cogroup(visits.groupBy("block")).applyInArrow(_rank(nearest), "query_id long, vec_id long, score double")
    merged = reports.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")
