"""Exact nearest vectors by cosine, searched block by block around pivots."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.session import stored_once

PIVOTS = 128
BLOCK_ROWS = 16_384
# Queries that meet a block in one task; more go to the block in several parts.
QUERY_ROWS = 16_384
# Scores are compared in twelve digits, so that equal vectors tie wherever they are multiplied.
DIGITS, SLACK = 12, 1e-9
NEAR = "query_id bigint, vector_id bigint, score double"


class Blocks(NamedTuple):
    """A row for each block: its number, its pivot, how many vectors, and the widest angle to the pivot."""

    number: np.ndarray
    pivot: np.ndarray
    rows: np.ndarray
    width: np.ndarray
    pivots: np.ndarray


def _units(column: pa.ListArray) -> np.ndarray:
    values = np.stack(column.to_numpy(zero_copy_only=False)).astype(np.float64)
    return values / np.linalg.norm(values, axis=1)[:, None]


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def _usable(df: DataFrame, key: str, embedding: str, name: str) -> DataFrame:
    """(name, embedding): without missing and zero vectors."""
    whole = F.col(embedding).isNotNull() & F.exists(embedding, lambda x: x != 0) & ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x))
    return df.where(whole).select(F.col(key).cast("bigint").alias(name), F.col(embedding).cast("array<double>").alias("embedding"))


def _placed(vectors: DataFrame, pivots: np.ndarray, block_rows: int) -> DataFrame:
    """(block, pivot, angle, vector_id, embedding): each vector with its nearest pivot; a pivot with many is cut by hash."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cosine = _units(batch.column(1)) @ pivots.T
            best = cosine.argmax(axis=1)
            angle = _angle(cosine[np.arange(len(best)), best])
            yield pa.RecordBatch.from_arrays([pa.array(best.astype(np.int32)), pa.array(angle), *batch.columns], ["pivot", "angle", "vector_id", "embedding"])

    near = vectors.mapInArrow(nearest, "pivot int, angle double, vector_id bigint, embedding array<double>")
    near = stored_once(near, "vectors-by-pivot")
    # A row for each pivot.
    counted = near.groupBy("pivot").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("vector_id", "embedding"), F.col("parts"))
    block = F.col("pivot").cast("bigint") * 1_000_000_000 + part
    return near.join(F.broadcast(counted), "pivot").withColumn("block", block).drop("parts")


def _best(ids: np.ndarray, found: np.ndarray, scores: np.ndarray, k: int) -> pa.Table:
    """The k best of each row of scores; a score of -inf is none."""
    rows = np.repeat(np.arange(len(ids)), scores.shape[1])
    columns = np.tile(np.arange(scores.shape[1]), len(ids))
    flat = scores.ravel()
    if scores.shape[1] > k:
        floor = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        use = flat >= np.repeat(floor, scores.shape[1])
        rows, columns, flat = rows[use], columns[use], flat[use]
    order = np.lexsort((found[columns], -flat, rows))
    rows, columns, flat = rows[order], columns[order], flat[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    use = (place < k) & np.isfinite(flat)
    return pa.table({"query_id": pa.array(ids[rows[use]]), "vector_id": pa.array(found[columns[use]]), "score": pa.array(flat[use])})


def _searched(placed: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """NEAR: the k best of each block for each query that asks it. asked: (block, query_id, unit)."""

    def run(block: pa.Table, queries: pa.Table) -> pa.Table:
        if not block.num_rows or not queries.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vector_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        points, found = _units(block.column("embedding").combine_chunks()), block.column("vector_id").to_numpy()
        ids, units = queries.column("query_id").to_numpy(), np.stack(queries.column("unit").to_numpy())
        parts = []
        step = max(1, (1 << 23) // len(found))
        for low in range(0, len(ids), step):
            own = ids[low : low + step]
            scores = np.round(units[low : low + step] @ points.T, DIGITS)
            scores[own[:, None] == found[None, :]] = -np.inf
            parts.append(_best(own, found, scores, k))
        return pa.concat_tables(parts)

    # A block that very many queries ask is met by them in parts.
    many = asked.groupBy("block").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("parts"))
    dealt = asked.join(many, "block").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")))
    copies = placed.join(many, "block").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts").cast("bigint") - 1)))
    return copies.select("block", "part", "vector_id", "embedding").groupBy("block", "part").cogroup(
        dealt.select("block", "part", "query_id", "unit").groupBy("block", "part")
    ).applyInArrow(run, NEAR)


def _asking(queries: DataFrame, blocks: Blocks, k: int, first: bool) -> DataFrame:
    """(block, query_id, unit). First: the nearest blocks that hold more than k vectors. Then, with a k-th score at hand: all others
    whose ball may hold a better one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                units = _units(some.column(1))
                away = _angle(units @ blocks.pivots.T)[:, blocks.pivot]
                least = np.maximum(away - blocks.width, 0)
                order = np.argsort(least, axis=1, kind="stable")
                enough = np.cumsum(blocks.rows[order], axis=1) - blocks.rows[order] <= k
                home = np.zeros_like(enough)
                np.put_along_axis(home, order, enough, axis=1)
                if first:
                    use = home
                else:
                    floor = some.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
                    use = ~home & (np.cos(least) >= np.where(np.isnan(floor), -2, floor)[:, None] - SLACK)
                row, column = np.nonzero(use)
                unit = pa.FixedSizeListArray.from_arrays(pa.array(units[row].ravel()), units.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(blocks.number[column]), some.column(0).take(pa.array(row)), unit], ["block", "query_id", "unit"])

    return queries.mapInArrow(run, "block bigint, query_id bigint, unit array<double>")


class CosineSearch:
    """The k nearest vectors of every query, itself left out; equal scores are ordered by id.

    Pivots are a sample of fixed size. Each vector lies in the block of its nearest pivot, and a block is a ball around it. Queries stay
    a distributed table: each one first meets the nearest blocks that hold k vectors, which gives a floor for its k-th
    score, and then only the blocks whose ball may hold a better one. A block and its queries are multiplied as matrices.
    The driver sees a row for each block. Zero and missing vectors, or those with missing components, are near to nothing and left
    out. All vectors have one dimension.
    """

    def __init__(self, vectors: DataFrame, queries: DataFrame, k: int, vector_id: str = "vec_id", query_id: str = "query_id",
                 embedding: str = "embedding", pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS) -> None:
        self.spark, self.k, self.names = vectors.sparkSession, k, (query_id, vector_id)
        usable = _usable(vectors, vector_id, embedding, "vector_id")
        self.queries = stored_once(_usable(queries, query_id, embedding, "query_id"), "vector-queries")
        sample = usable.orderBy(F.xxhash64("vector_id", "embedding")).limit(pivots).collect()
        self.empty = not sample
        if self.empty:
            return
        chosen = np.array([row.embedding for row in sample], np.float64)
        chosen = chosen / np.linalg.norm(chosen, axis=1)[:, None]
        self.placed = stored_once(_placed(usable, chosen, block_rows), "vector-blocks")
        known = self.placed.groupBy("block").agg(F.first("pivot").alias("pivot"), F.count("*").alias("n"), F.max("angle").alias("width")).orderBy("block").collect()
        columns = [np.array([row[c] for row in known]) for c in ("block", "pivot", "n", "width")]
        self.blocks = Blocks(*columns, chosen)
        asked = stored_once(_asking(self.queries, self.blocks, k, True), "vector-first-blocks")
        self.home = stored_once(_searched(self.placed, asked, k), "vector-first-scores")
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vector_id"))
        floor = self.home.withColumn("place", place).where(F.col("place") == k).select("query_id", F.col("score").alias("floor"))
        rest = _asking(self.queries.join(floor, "query_id", "left"), self.blocks, k, False)
        self.rest, self.first = stored_once(rest, "vector-other-blocks"), asked

    def result(self) -> DataFrame:
        """(query_id, vector_id, place, score), score as decimal(9,6)."""
        query_id, vector_id = self.names
        near = self.spark.createDataFrame([], NEAR) if self.empty else self.home.unionByName(_searched(self.placed, self.rest, self.k))
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vector_id"))
        return near.withColumn("place", place).where(F.col("place") <= self.k).select(
            F.col("query_id").alias(query_id), F.col("vector_id").alias(vector_id), "place", F.col("score").cast("decimal(9,6)").alias("score")
        )

    def skipped(self) -> DataFrame:
        """(queries, blocks, searched, skipped): pairs of a query and a block that were multiplied, and that were not."""
        queries = self.queries.agg(F.count("*").alias("queries"))
        if self.empty:
            return queries.select("queries", *[F.lit(0).cast("bigint").alias(c) for c in ("blocks", "searched", "skipped")])
        searched = self.first.select("block").unionByName(self.rest.select("block")).count()
        blocks = F.lit(len(self.blocks.number)).cast("bigint")
        done = F.lit(searched).cast("bigint")
        return queries.select("queries", blocks.alias("blocks"), done.alias("searched"), (F.col("queries") * blocks - done).alias("skipped"))


def cosine_topk(vectors: DataFrame, queries: DataFrame, k: int, vector_id: str = "vec_id", query_id: str = "query_id", embedding: str = "embedding",
                pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    return CosineSearch(vectors, queries, k, vector_id, query_id, embedding, pivots, block_rows).result()
