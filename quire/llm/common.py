"""Shared pieces: scratch tables, word patterns and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quire.session import discard, scratch_folder, shuffles_removed

# A word is a run of digits, small letters and anything beyond ASCII, after A-Z became a-z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame once to the shared scratch folder and read it back: later steps neither recompute nor lose it."""
    folder = scratch_folder(frame.sparkSession, label)
    with shuffles_removed(frame.sparkSession):
        frame.write.option("compression", "zstd").parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def fresh_name(frame: DataFrame, name: str) -> str:
    """The name, lengthened until the frame has no such column."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def in_pieces(batches: Iterator[pa.RecordBatch], column: int, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Batches cut to so many bytes of a text or binary column, or to one row where it has more."""
    for batch in batches:
        sizes = np.array([len(v.as_buffer()) if v.is_valid else 0 for v in batch.column(column)], np.int64)
        group = np.cumsum(sizes) // most
        bounds = [0, *(np.nonzero(np.diff(group))[0] + 1).tolist(), batch.num_rows] if batch.num_rows else []
        for low, high in zip(bounds, bounds[1:]):
            yield batch.slice(low, high - low)


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


# Edges that a task takes at once: a few edges are not dealt over many tasks, whose files would outweigh them. Up to WITHIN edges, one
# task's few megabytes, are connected without rounds.
EDGES, WITHIN = 20_000, 1 << 18


def connected_components(edges: DataFrame) -> DataFrame:
    """Undirected edges (a, b) of longs to (node, component), the component being its smallest node.

    Alternates the two star operations of Kiveris et al. (2014): every node points to the smallest node it knows, until
    nothing changes. Each round is written to the scratch folder, counted by the way, and the one before deleted. Edges grow never beyond
    their number; a hub with most of the edges is a skewed side of a plain join, which adaptive execution splits. Few edges need
    no rounds: each round is several jobs, whose plans and task states the driver holds, however little they do.
    """
    edges, found = _stored_edges(_ordered(edges))
    if found[0] <= WITHIN:
        nodes = stored(edges.coalesce(1).mapInArrow(_within, "node long, component long"), "components")
        discard(edges)
        return nodes
    seen = None
    while found != seen:
        seen, tasks = found, 1 + found[0] // EDGES
        before = edges
        edges, found = _stored_edges(_small_star(_large_star(edges, tasks), tasks))
        discard(before)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()


def _stored_edges(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, stored, and their number and a sum of their hashes."""
    seen = Observation()
    marked = edges.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("mark"))
    return stored(marked, "edges"), (seen.get["n"], seen.get["mark"])


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components of all edges of the batches."""
    sides = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches if batch.num_rows]
    if sides:
        a, b = (np.concatenate(side) for side in zip(*sides))
        nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = merged(np.arange(len(nodes)), place[: len(a)], place[len(a) :])
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], ["node", "component"])


def merged(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The labels, each the smallest place of its group, once the pairs (i, j) are linked too."""
    i, j = label[i], label[j]
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _ordered(edges: DataFrame) -> DataFrame:
    """The larger end first, no loops, each edge once."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(tasks)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.coalesce(tasks).distinct().coalesce(tasks)


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(moved.unionByName(least.select("a", F.col("m").alias("b"))).coalesce(tasks)).coalesce(tasks)


def row_key() -> list[Column]:
    """What tells a row of documents from others: whether it has a doc_id, the doc_id, and a hash of its text."""
    number = F.col("doc_id").cast("long")
    return [number.isNull().alias("no_id"), F.coalesce(number, F.lit(0)).alias("doc"), F.xxhash64("text").alias("mark")]


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id and text are not among those of rejected (doc_id, mark), mark being the text's hash.

    A number of rejected rows has no bound, so they are never broadcast, however few they look: the plan is one at all sizes.
    """
    key = [fresh_name(docs, f"row_{name}") for name in ("no_id", "doc", "mark")]
    keyed = docs.select("*", *[c.alias(name) for name, c in zip(key, row_key())])
    number = F.col("doc_id").cast("long")
    columns = number.isNull(), F.coalesce(number, F.lit(0)), F.col("mark")
    names = rejected.select(*[c.alias(name) for name, c in zip(key, columns)]).distinct().hint("merge")
    return keyed.join(names, key, "left_anti").select(docs.columns)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
