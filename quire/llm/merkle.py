"""A Merkle manifest of a dataset as a persistent tree: every tampered row is a version that copies only its leaf's ancestors.

Each row is a leaf. Leaves of a source stand in order of doc_id; every 16 consecutive nodes become one until one is left, the
source's subroot, and the subroots in order of sources become the root by the same rule. Positions come from a range shuffle of
digests and one count for each range, so a source of any size is dealt over all tasks.

The tree is cut into aligned blocks of three levels, 4,096 nodes each. A task grows the nodes of a block; the blocks' roots are the nodes of
the next round. From the last round down, each block learns the siblings above it. A tampered leaf's version then copies the
leaf's ancestors within its block, against the block's own nodes, and goes on with copies of the ancestors above it; every other
node is the first version's. Neither the driver nor a task ever holds a tree, only one block and a path.

A digest is a lowercase hex sha256; a node's is that of its children's digests one after another. A leaf's is that of the fields one
after another, each `-` if null, else its length in UTF-8 bytes, a colon and its value. Null sources come first, then sources by bytes; null
doc_ids come first, rows with equal doc_id are ordered by leaf, and equal rows are interchangeable. A row whose doc_id is null, and a null text, are
never tampered with by `lower_case_tampering`. Texts may be of any length and empty. An empty table has no root and gives no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import LOWER, UPPER, stored

ARITY, LEVELS = 16, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Where a partition's rows begin among the numbers of monotonically_increasing_id.
PART_BITS = 33
AUDIT = "doc_id long, source string, leaf string, subroot string, root string, proof_sha256 string, tampered boolean, copied array<string>, verified boolean"
HEX = 64


def _digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def steps(place: int, total: int) -> list[tuple[int, int]]:
    """For each level above a node, bottom up: its place among the children of its parent, and how many these are."""
    found = []
    while total > 1:
        found.append((place % ARITY, min(ARITY, total - place // ARITY * ARITY)))
        place, total = place // ARITY, -(-total // ARITY)
    return found


def grown(nodes: list[bytes], total: int, levels: int = LEVELS) -> list[list[bytes]]:
    """The nodes of a block by level, its leaves first; total: the nodes of the whole tree in the block's lowest level."""
    found = [nodes]
    while len(found) <= levels and total > 1:
        below, total = found[-1], -(-total // ARITY)
        found.append([_digest(b"".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
    return found


def siblings(tree: list[list[bytes]], place: int) -> list[bytes]:
    """The siblings of a node and of its ancestors within the block, one bytes object for each level."""
    found = []
    for nodes in tree[:-1]:
        low = place // ARITY * ARITY
        found.append(b"".join(nodes[low:place] + nodes[place + 1 : low + ARITY]))
        place //= ARITY
    return found


def copied(node: bytes, places: list[tuple[int, int]], path: list[bytes]) -> list[bytes]:
    """The nodes that a version copies above a changed node, bottom up; what is not on the path is shared."""
    found = []
    for (at, _), beside in zip(places, path):
        node = _digest(beside[: at * HEX] + node + beside[at * HEX :])
        found.append(node)
    return found


def _split(path: bytes, places: list[tuple[int, int]]) -> list[bytes]:
    found, at = [], 0
    for _, count in places:
        found.append(path[at : at + (count - 1) * HEX])
        at += (count - 1) * HEX
    return found


def leaf_digest(values: dict[str, Column], fields: tuple[str, ...] = FIELDS) -> Column:
    marked = []
    for name in fields:
        value = values.get(name, F.col(name)).cast("string")
        marked.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*marked).cast("binary"), 256)


def lower_case_tampering() -> Column:
    """The digest of a row whose text has lost its capitals A-Z, for the fifth of rows that a checksum of doc_id picks; else null."""
    picked = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0) & F.col("text").isNotNull()
    return F.when(picked, leaf_digest({"text": F.translate(F.col("text"), UPPER, LOWER)}))


def _leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """A row for each document: its tree, its digests, raw, and a number that tells it from equal rows."""
    # Null sources come before all others.
    tree = F.when(F.col("source").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("source")))
    return docs.select(
        tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), F.unhex(leaf_digest({})).alias("digest"),
        F.unhex(tampered).alias("changed"), F.monotonically_increasing_id().alias("row"),
    )


def _placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """nodes with `place`, from 0 in the order within their tree, and `total`, the nodes of their tree. Nodes are a stored table."""
    ordered = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ordered = stored(ordered.withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    ordered = ordered.withColumn("part", F.shiftright("at", PART_BITS))
    # One row for each range and tree in it; a window sees a tree's rows, at most as many as there are ranges.
    own = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = ordered.groupBy("tree", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    spans = spans.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(own).alias("total"))
    return ordered.join(spans, ["tree", "part"]).withColumn("place", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _blocks(nodes: DataFrame, levels: int, more: tuple[str, ...] = ()) -> DataFrame:
    """Aligned blocks of (tree, place, total, digest): a row holds at most 16 ** levels nodes in order."""
    packed = F.sort_array(F.collect_list(F.struct("place", "digest", *more)))
    block = F.floor(F.col("place") / F.lit(ARITY**levels)).alias("block")
    grouped = nodes.groupBy("tree", block).agg(F.first("total").alias("total"), packed.alias("nodes"))
    return grouped.select("tree", "block", "total", *[F.col("nodes")[c].alias(c) for c in ("digest", *more)])


def _hexes(cells: pa.Scalar) -> list[bytes]:
    return [value.hex().encode() for value in cells.as_py()]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Row by row, so that no more than one block is unpacked."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i] for name in batch.schema.names}


def _tops(blocks: DataFrame, levels: int) -> DataFrame:
    """The blocks' roots as nodes of the next round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            total = row["total"].as_py()
            top = grown(_hexes(row["digest"]), total, levels)[-1][0]
            values = [row["tree"].as_py(), row["block"].as_py(), -(-total // ARITY**levels), bytes.fromhex(top.decode())]
            yield pa.RecordBatch.from_pydict(dict(zip(("tree", "place", "total", "digest"), ([v] for v in values))))

    return blocks.select("tree", "block", "total", "digest").mapInArrow(run, "tree string, place long, total long, digest binary")


class Forest:
    """Blocks by round, lowest first, and the trees' roots (tree, digest)."""

    def __init__(self, nodes: DataFrame, levels: int, more: tuple[str, ...] = ()) -> None:
        self.levels = levels
        self.rounds = [stored(_blocks(nodes, levels, more), "merkle-blocks")]
        tops = stored(_tops(self.rounds[0], levels), "merkle-tops")
        done = [tops.where("total = 1")]
        while not (rest := tops.where("total > 1")).isEmpty():
            self.rounds.append(stored(_blocks(rest, levels), "merkle-blocks"))
            tops = stored(_tops(self.rounds[-1], levels), "merkle-tops")
            done.append(tops.where("total = 1"))
        self.done = [frame.select("tree", "place", "digest") for frame in done]

    def roots(self) -> DataFrame:
        found = self.done[0]
        for frame in self.done[1:]:
            found = found.unionByName(frame)
        return found.select("tree", "digest")

    def paths(self, above: DataFrame) -> DataFrame:
        """(tree, place, path) of the lowest blocks' roots: their siblings up to the tree's root, and then `above` (tree, path)."""
        levels = self.levels

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                total, nodes, path = row["total"].as_py(), _hexes(row["digest"]), row["path"].as_py()
                base, tree = row["block"].as_py() * ARITY**levels, grown(nodes, total, levels)
                yield pa.RecordBatch.from_pydict({
                    "tree": [row["tree"].as_py()] * len(nodes), "place": list(range(base, base + len(nodes))),
                    "path": [b"".join(siblings(tree, i)) + path for i in range(len(nodes))],
                })

        known = None
        for blocks, done in zip(self.rounds[:0:-1], self.done[:0:-1]):
            ends = done.join(above, "tree").select("tree", "place", "path")
            parents = (ends if known is None else ends.unionByName(known)).withColumnRenamed("place", "block")
            known = stored(blocks.join(parents, ["tree", "block"]).mapInArrow(run, "tree string, place long, path binary"), "merkle-paths")
        ends = self.done[0].join(above, "tree").select("tree", "place", "path")
        return ends if known is None else ends.unionByName(known)


def audit(docs: DataFrame, tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """AUDIT of every row of docs (FIELDS): its proof, checked against the version in which it alone is tampered with.

    tampered: a column of docs, the hex digest of the changed row or null; `copied` are the nodes of the row's version, from its leaf to the root
    that it leads to. proof_sha256 is a hash of the siblings level by level, left to right.
    """
    leaves = stored(_leaves(docs, lower_case_tampering() if tampered is None else tampered), "merkle-leaves")
    trees = Forest(_placed(leaves, ["doc_id", "digest", "row"]), levels, ("doc_id", "changed"))
    # The subroots are the leaves of one more tree.
    subroots = stored(trees.roots().select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest"), "merkle-subroots")
    over = Forest(_placed(subroots, ["of"]), levels, ("of",))
    top = over.roots().select("tree", F.col("digest").alias("root"))
    above = _source_paths(over, top, levels)
    known = trees.paths(above.select("tree", "path")).withColumnRenamed("place", "block")
    blocks = trees.rounds[0].join(known, ["tree", "block"]).join(above.drop("path"), "tree")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            tree_name, base, total = row["tree"].as_py(), row["block"].as_py() * ARITY**levels, row["total"].as_py()
            nodes, changed = _hexes(row["digest"]), row["changed"].as_py()
            tree, root = grown(nodes, total, levels), row["root"].as_py().hex()
            own, rest = len(tree) - 1, steps(base, total)[len(tree) - 1 :] + steps(row["source_place"].as_py(), row["sources"].as_py())
            path = _split(row["path"].as_py(), rest)
            out = []
            for i, doc_id in enumerate(row["doc_id"].as_py()):
                beside = siblings(tree, i)
                start = nodes[i] if changed[i] is None else changed[i].hex().encode()
                version = [start, *copied(start, steps(base + i, total)[:own] + rest, beside + path)]
                proof = hashlib.sha256(b"".join(beside) + b"".join(path)).hexdigest()
                hexes = [node.decode() for node in version]
                out.append((doc_id, tree_name[1:] if tree_name[0] == "1" else None, nodes[i].decode(), row["subroot"].as_py().hex(), root, proof, changed[i] is not None, hexes, hexes[-1] == root))
            names = [field.split()[0] for field in AUDIT.split(", ")]
            kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.list_(pa.string()), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return blocks.mapInArrow(run, AUDIT)


def _source_paths(over: Forest, top: DataFrame, levels: int) -> DataFrame:
    """(tree, path, subroot, root, source_place, sources) of each source's tree."""
    known = over.paths(top.select("tree", F.lit(b"").alias("path"))).withColumnRenamed("place", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            total, nodes, raw = row["total"].as_py(), _hexes(row["digest"]), row["digest"].as_py()
            base, tree = row["block"].as_py() * ARITY**levels, grown(nodes, total, levels)
            yield pa.RecordBatch.from_pydict({
                "tree": row["of"].as_py(), "path": [b"".join(siblings(tree, i)) + row["path"].as_py() for i in range(len(nodes))],
                "subroot": raw, "root": [row["root"].as_py()] * len(nodes),
                "source_place": list(range(base, base + len(nodes))), "sources": [total] * len(nodes),
            })

    schema = "tree string, path binary, subroot binary, root binary, source_place long, sources long"
    joined = over.rounds[0].join(known, ["tree", "block"]).join(top, "tree")
    return stored(joined.mapInArrow(run, schema), "merkle-sources")
