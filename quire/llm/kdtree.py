"""Exact top-k by inner product over KD-trees, one tree per shard of the candidates.

A tree splits its vectors at the median of the widest dimension and keeps tight bounding boxes. A query visits boxes in the
order of the largest inner product that any point of the box could have, and stops when that bound is below its k-th best
score. The k-th best is carried from tree to tree within a task, and every search starts from the k-th best that a first
pass over a few vectors gave, so later trees open few boxes where the data allow it.

Components become floor(1024 * x), x as double. Vectors that are null or hold null or non-finite components take no part.
Vectors meet only those of their own dimension. Ties go to the smaller id. A query is compared with every row but its own:
other rows with its id count as own. Candidate rows that repeat an id are candidates each; query rows
that repeat an id are one query, the first vector in order of its components. Null ids take no part. Empty tables give no
rows. Scores must fit a long; otherwise the search fails. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import stored

SCALE = 1024
SHARD, LEAF = 4096, 64
QUERY_BLOCK = 4096
K = 10
TREES = "shard long, dim int, ids binary, vectors binary, boxes binary, nodes binary"


def whole_vectors(values: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Usable rows of a column by dimension: their places and their vectors of whole numbers."""
    offsets = values.offsets.to_numpy().astype(np.int64)
    given = values.values.to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        flat = np.floor(SCALE * given)
    bad, large = (np.concatenate([[0], np.cumsum(which)]) for which in (~np.isfinite(given), ~(np.abs(flat) < 2.0**62)))
    usable = (bad[offsets[1:]] == bad[offsets[:-1]]) & values.is_valid().to_numpy(zero_copy_only=False)
    if (usable & (large[offsets[1:]] != large[offsets[:-1]])).any():
        raise OverflowError("a finite component of a vector is too large for a whole number of 62 bits")
    sizes = np.diff(offsets)
    for size in np.unique(sizes[usable]):
        rows = np.nonzero(usable & (sizes == size))[0]
        yield rows, flat[offsets[rows][:, None] + np.arange(size)].astype(np.int64)


def build_tree(vectors: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, boxes, nodes): a permutation in which leaves are runs, low and high corners, and (from, to, left, right)."""
    order = np.arange(len(vectors))
    nodes, boxes = [[0, len(vectors), -1, -1]], []
    at = 0
    while at < len(nodes):
        low, high = nodes[at][:2]
        own = vectors[order[low:high]]
        corners = np.stack([own.min(axis=0), own.max(axis=0)])
        boxes.append(corners)
        if high - low > leaf and (spread := corners[1] - corners[0]).size and spread.max() > 0:
            middle = (high - low) // 2
            order[low:high] = order[low:high][np.argpartition(own[:, spread.argmax()], middle)]
            nodes[at][2:] = [len(nodes), len(nodes) + 1]
            nodes += [[low, low + middle, -1, -1], [low + middle, high, -1, -1]]
        at += 1
    return order, np.stack(boxes), np.array(nodes, np.int64)


def build_trees(frame: DataFrame, id_column: str, vector_column: str, shard: int = SHARD, leaf: int = LEAF) -> DataFrame:
    """The stored trees: one row per shard of at most `shard` vectors of one dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        number = TaskContext.get().partitionId() << 32

        def tree(dim: int, ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            order, boxes, nodes = build_tree(vectors, leaf)
            number += 1
            values = [number, dim, ids[order].tobytes(), vectors[order].tobytes(), boxes.tobytes(), nodes.tobytes()]
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], ["shard", "dim", "ids", "vectors", "boxes", "nodes"])

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for rows, vectors in whole_vectors(batch.column(1)):
                dim = vectors.shape[1]
                waiting.setdefault(dim, []).append((ids[rows], vectors))
                if sum(len(i) for i, _ in waiting[dim]) >= shard:
                    held_ids, held = (np.concatenate(x) for x in zip(*waiting.pop(dim)))
                    for at in range(0, len(held_ids), shard):
                        if len(held_ids) - at < shard:
                            waiting[dim] = [(held_ids[at:], held[at:])]
                        else:
                            yield tree(dim, held_ids[at : at + shard], held[at : at + shard])
        for dim, parts in waiting.items():
            yield tree(dim, *(np.concatenate(x) for x in zip(*parts)))

    rows = frame.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v")).where("id is not null")
    return stored(rows.mapInArrow(run, TREES), "kd-trees")


class _Queries:
    """A block of queries of one dimension with their best candidates so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        self.most = int(np.abs(vectors).max(initial=0))
        self.floor: np.ndarray | None = None

    def products(self, points: np.ndarray) -> np.ndarray:
        """Exact inner products of all queries (rows) with the points."""
        return _exact(self.vectors, points, self.most)


def _exact(a: np.ndarray, b: np.ndarray, most: int | None = None) -> np.ndarray:
    reach = (int(np.abs(a).max(initial=0)) if most is None else most) * int(np.abs(b).max(initial=0)) * max(1, a.shape[-1])
    if reach < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if reach < 2**63:
        return a @ b.T
    scores = a.astype(object) @ b.T.astype(object)
    if any(abs(x) >= 2**63 for x in np.ravel(scores)):
        raise OverflowError("a score does not fit a long")
    return scores.astype(np.int64)


def _bounds(queries: _Queries, boxes: np.ndarray) -> np.ndarray:
    """For each query and box the largest inner product with a point of the box."""
    up, down = np.maximum(queries.vectors, 0), np.minimum(queries.vectors, 0)
    reach = queries.most * int(np.abs(boxes).max(initial=0)) * max(1, boxes.shape[-1])
    kind = np.float64 if reach < 2**52 else object
    return up.astype(kind) @ boxes[:, 1].T.astype(kind) + down.astype(kind) @ boxes[:, 0].T.astype(kind)


def search_tree(queries: _Queries, best: list[list[tuple[int, int]]], ids: np.ndarray, vectors: np.ndarray, boxes: np.ndarray, nodes: np.ndarray) -> int:
    """Improve each query's heap of (score, -id) by one tree; returns the number of leaves opened."""
    bounds, opened = _bounds(queries, boxes), 0
    for q, heap in enumerate(best):
        floor = queries.floor[q]
        own, ahead = bounds[q], [(-bounds[q][0], 0)]
        while ahead:
            reach, node = heapq.heappop(ahead)
            # An equal bound may still win by a smaller id.
            if -reach < floor or (len(heap) == queries.k and -reach < heap[0][0]):
                break
            low, high, left, right = nodes[node]
            if left >= 0:
                heapq.heappush(ahead, (-own[left], int(left)))
                heapq.heappush(ahead, (-own[right], int(right)))
                continue
            opened += 1
            scores = _exact(queries.vectors[q : q + 1], vectors[low:high], queries.most)[0]
            least = heap[0][0] if len(heap) == queries.k else floor
            for at in np.nonzero(scores >= least)[0].tolist():
                found = (int(scores[at]), -int(ids[low + at]))
                if -found[1] == queries.ids[q]:
                    continue
                if len(heap) < queries.k:
                    heapq.heappush(heap, found)
                elif found > heap[0]:
                    heapq.heapreplace(heap, found)
    return opened


def _seed(queries: _Queries, sample: tuple[np.ndarray, np.ndarray]) -> None:
    """A first lower bound of each k-th best score, from a sample of candidates; without k others there is none."""
    ids, vectors = sample
    floors = np.full(len(queries.ids), -(2**63), np.int64)
    if len(ids) > queries.k:
        scores = queries.products(vectors)
        scores[queries.ids[:, None] == ids[None, :]] = -(2**63)
        # With one row taken away for the query's own, the k-th best of the sample is a bound for the k-th best of all.
        floors = -np.partition(-scores.astype(np.float64), queries.k - 1, axis=1)[:, queries.k - 1]
        floors = np.where(np.abs(floors) < 2**53, floors, -(2.0**63)).astype(np.float64)
    queries.floor = floors


def _block(trees: DataFrame, queries: _Queries) -> DataFrame:
    dim = queries.vectors.shape[1]
    schema = ["query_id", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in queries.ids]
        for batch in batches:
            for at in range(batch.num_rows):
                raw = [np.frombuffer(batch.column(i)[at].as_buffer(), "<i8") for i in range(4)]
                nodes = raw[3].reshape(-1, 4)
                search_tree(queries, best, raw[0], raw[1].reshape(len(raw[0]), dim), raw[2].reshape(len(nodes), 2, dim), nodes)
        found = [(int(q), -i, score) for q, heap in zip(queries.ids, best) for score, i in heap]
        columns = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], schema)

    same = trees.where(F.col("dim") == dim).select("ids", "vectors", "boxes", "nodes")
    return same.mapInArrow(run, "query_id long, vec_id long, score long")


def _sampled(trees: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of one shard, with distinct ids."""
    row = trees.where(F.col("dim") == dim).select("ids", "vectors").first()
    if row is None:
        return np.zeros(0, np.int64), np.zeros((0, dim), np.int64)
    every = np.frombuffer(row[0], "<i8")
    ids, first = np.unique(every, return_index=True)
    return ids, np.frombuffer(row[1], "<i8").reshape(len(every), dim)[first]


def _query_blocks(rows: Iterable, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The query rows in blocks of bounded size, by dimension, in the order of their ids."""
    rows, last = iter(rows), None
    while block := list(islice(rows, size)):
        kept = []
        for row in block:
            if row[0] != last:
                kept.append(row)
            last = row[0]
        if kept:
            ids = np.array([row[0] for row in kept], np.int64)
            for places, vectors in whole_vectors(pa.array([row[1] for row in kept], pa.list_(pa.float64()))):
                yield ids[places], vectors


def top_k(
    frame: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = K,
    query_block: int = QUERY_BLOCK,
    shard: int = SHARD,
    leaf: int = LEAF,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest inner product for each row that is a query.

    The queries come to the driver in blocks of at most `query_block`; each block is one pass over all trees, and a pass
    leaves at most k rows per query and task.
    """
    trees = build_trees(frame, id_column, vector_column, shard, leaf)
    value, vector = F.col(id_column).cast("long"), F.col(vector_column).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    queries = frame.where(is_query).select(value.alias("id"), vector.alias("v"), finite.alias("finite")).where("id is not null and finite")
    passes = []
    for ids, vectors in _query_blocks(queries.orderBy("id", "v").toLocalIterator(), query_block):
        block = _Queries(ids, vectors, k)
        _seed(block, _sampled(trees, vectors.shape[1]))
        passes.append(stored(_block(trees, block), "kd-answers"))
    found = frame.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    for one in passes:
        found = found.unionByName(one)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
