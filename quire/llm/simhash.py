"""SimHash near-duplicates: exact tiled comparison of 64-bit fingerprints.

Fingerprints become tiles by the population counts of their four 16-bit parts. The difference of two such vectors is never
larger than the Hamming distance, so tile pairs whose counts differ beyond the radius are skipped without losing a link.
The other pairs are compared with exclusive-or and bit counts in numpy, in tiles of bounded size.

Nulls and empty texts have fingerprint zero and link like any other. Rows that repeat each get a row. Rows without a doc_id
are linked, but name no component: a component of such rows only has a null id. Other columns of the input are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import connected_components, merged, stored, utf8

SEED = 42
SHINGLE = 3
RADIUS = 2
PARTS, PART_BITS, FIELD = 4, 16, 5
TILE = 2048


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority of the bits of all shingle hashes; words are what ASCII white space separates."""
    words = utf8(text).lower().split()
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(end + 1 for end in ends)]
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(joined, SEED)]
    else:
        hashes = [digest(joined[start:end], SEED) for start, end in zip(starts, ends[shingle - 1 :])]
    counts = np.zeros(64, np.int64)
    values = np.array(hashes, "<u8")
    for block in range(0, len(values), 1 << 16):
        bits = np.unpackbits(values[block : block + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): one row per document, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(text, shingle) for text in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def _tile(fp: Column) -> Column:
    """The population counts of the parts, five bits each."""
    tile = F.lit(0)
    for part in range(PARTS):
        bits = F.bit_count(F.shiftrightunsigned(fp, part * PART_BITS).bitwiseAND(F.lit((1 << PART_BITS) - 1)))
        tile = tile + bits * F.lit(1 << (FIELD * part))
    return tile.cast("int")


def _neighbours(radius: int) -> list[int]:
    """Differences of tile numbers to the tiles within the radius, one of each opposite pair, and zero."""
    steps = [
        sum(step << (FIELD * part) if step >= 0 else -(-step << (FIELD * part)) for part, step in enumerate(vector))
        for vector in itertools.product(range(-radius, radius + 1), repeat=PARTS)
        if sum(map(abs, vector)) <= radius
    ]
    return sorted(step for step in set(steps) if step >= 0)


def links(fingerprints: DataFrame, radius: int = RADIUS, tile_rows: int = TILE) -> DataFrame:
    """Edges (a, b) that connect exactly what pairs of distinct fingerprints within the radius connect.

    Each tile pair gives a spanning forest of its links, so a dense group costs no more edges than rows.
    """
    if radius >= 1 << (FIELD - 1):
        raise ValueError("the radius must be below 16")
    tiled = fingerprints.select("fp").distinct().withColumn("tile", _tile(F.col("fp")))
    # At most 17 ** 4 rows of two numbers, whatever the input.
    parts = F.ceil(F.count("*") / F.lit(tile_rows)).cast("int").alias("parts")
    sizes = stored(tiled.groupBy("tile").agg(parts), "tile-sizes")
    chunk = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("chunk")
    tiles = stored(
        tiled.join(F.broadcast(sizes), "tile").select("tile", chunk, "fp")
        .groupBy("tile", "chunk").agg(F.collect_list("fp").alias("fps")),
        "tiles",
    )
    near = F.explode(F.array(*[F.col("tile") + F.lit(step) for step in _neighbours(radius)])).alias("to_tile")
    sent = (
        tiles.select("tile", "chunk", "fps", near)
        .join(F.broadcast(sizes.select(F.col("tile").alias("to_tile"), "parts")), "to_tile")
        .withColumn("to_chunk", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .where("to_tile <> tile or to_chunk >= chunk")
    )
    right = tiles.select(F.col("tile").alias("to_tile"), F.col("chunk").alias("to_chunk"), F.col("fps").alias("to_fps"))
    pairs = sent.join(right, ["to_tile", "to_chunk"]).select("fps", "to_fps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_forest(*_lists(batch, row), radius) for row in range(batch.num_rows)]
            if found:
                a, b = (np.concatenate(side) for side in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _lists(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
    left, right = (batch.column(i)[row].values.to_numpy() for i in (0, 1))
    return left, right


def _forest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each linked fingerprint of a tile pair to the first one of its local component."""
    step = max(1, (1 << 20) // max(1, len(right)))
    rows, columns = [], []
    for at in range(0, len(left), step):
        near = np.bitwise_count((left[at : at + step, None] ^ right[None, :]).view(np.uint64)) <= radius
        i, j = np.nonzero(near)
        rows.append(i + at)
        columns.append(j)
    i, j = np.concatenate(rows), np.concatenate(columns)
    values, place = np.unique(np.concatenate([left[i], right[j]]), return_inverse=True)
    i, j = place[: len(i)], place[len(i) :]
    label = merged(np.arange(len(values)), i, j)
    ends = np.nonzero(label != np.arange(len(values)))[0]
    return values[ends], values[label[ends]]


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, tile_rows: int = TILE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document; component_id is the smallest doc_id reachable by links."""
    marked = stored(with_fingerprints(docs, shingle), "fingerprints")
    own = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    nodes = connected_components(links(marked, radius, tile_rows)).withColumnRenamed("node", "fp")
    grouped = stored(own.join(nodes, "fp", "left"), "fingerprint-classes")
    roots = grouped.where("component is not null").groupBy("component").agg(F.min("first_id").alias("root_id"))
    classes = grouped.join(roots, "component", "left").select("fp", F.coalesce("root_id", "first_id").alias("component_id"))
    text = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return marked.join(classes, "fp").select("doc_id", text, "component_id")
