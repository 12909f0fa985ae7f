"""Exact duplicates by a content sort: sampled splitters deal texts out by range, equal texts become neighbours, neighbours are compared.

Texts are equal if they are identical once ASCII white space is deleted. A task first reduces the equal texts of a batch to their best
row, so that copies are not shuffled with their text. What is left is ordered by content: the first bytes, then a digest of all
bytes, so that a splitter has a bounded size whatever the texts; then the most code points, the smallest doc_id and the row.
Spark samples splitters of this order, shuffles by range and sorts each range externally. As doc_id and row belong to the order, a
group of any size is cut over as many ranges as it fills. Each text is then compared with its neighbour, all bytes of both; a run of equal
neighbours that goes on beyond its range is joined with the next range's first run by a comparison of the two texts at the border.

Of a group the row with the most code points in its original text stays, then the smallest doc_id (null last), then any one of rows that
are alike in all three. Null counts as empty, and empty texts and texts of white space alone are one group. Texts may be of
any length; one text must fit a task's memory. An empty table gives no rows. Other columns are ignored, whatever their names; `keep_one` passes them on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from quire.llm.common import fresh_name, in_pieces, stored

SPACE = b" \t\n\r\x0b\x0c"
HEAD = 64
# Rows put out at once.
BLOCK = 8192
ROWS = "row long, doc_id long, ref long, chars long, n long, head binary, digest binary, text binary"
# A row for each text of a range, then one for the range itself: how many runs it has, and the text at either end.
RUNS = "part int, run long, ref long, size long, keep_id long, keep_row long, digest binary, runs long, first binary, last binary"
ENDS = "part int, run long, total long, keep_id long, keep_row long"


def _normalised(rows: DataFrame) -> DataFrame:
    """ROWS of (row, doc_id, text): `ref` is the best row with the same text in the batch, and only that one carries the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, 2):
            row, ids, texts = batch.column(0).to_numpy(), batch.column(1), batch.column(2)
            chars = pc.fill_null(pc.utf8_length(texts), 0).to_numpy().astype(np.int64)
            raw = [b"" if text is None else text.translate(None, SPACE) for text in texts.cast(pa.binary()).to_pylist()]
            known: dict[bytes, int] = {}
            slot = np.array([known.setdefault(text, len(known)) for text in raw], np.int64)
            no_id, doc = ids.is_null().to_numpy(zero_copy_only=False), pc.fill_null(ids, 0).to_numpy()
            order = np.lexsort((row, doc, no_id, -chars, slot))
            best = order[np.append(True, np.diff(slot[order]) != 0)] if len(order) else order
            stands = np.zeros(len(row), bool)
            stands[best] = True
            alike = np.bincount(slot, minlength=len(known))
            texts_out = [text if stand else None for text, stand in zip(raw, stands.tolist())]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), ids, pa.array(row[best[slot]]), pa.array(chars), pa.array(alike[slot], mask=~stands),
                pa.array([text and text[:HEAD] for text in texts_out], pa.binary()),
                pa.array([None if text is None else hashlib.sha256(text).digest() for text in texts_out], pa.binary()),
                pa.array(texts_out, pa.binary()),
            ], [field.split()[0] for field in ROWS.split(", ")])

    return rows.mapInArrow(run, ROWS)


class _Runs:
    """Rows of one range, gathered run by run."""

    def __init__(self, part: int) -> None:
        self.part, self.number, self.waiting, self.refs = part, -1, [], []
        self.text = self.first = None

    def begin(self, text: bytes, digest: bytes, doc_id: int | None, row: int) -> None:
        self.number += 1
        self.text, self.digest, self.keep, self.size = text, digest, (doc_id, row), 0
        if self.number == 0:
            self.first = text

    def end(self) -> None:
        self.waiting += [(self.part, self.number, ref, self.size, *self.keep, self.digest, None, None, None) for ref in self.refs]
        self.refs = []

    def put_out(self) -> pa.RecordBatch:
        names = [field.split()[0] for field in RUNS.split(", ")]
        kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
        columns = [pa.array(c, kinds[field.split()[1]]) for c, field in zip(zip(*self.waiting), RUNS.split(", "))]
        self.waiting = []
        return pa.RecordBatch.from_arrays(columns, names)


def _neighbours(reps: DataFrame) -> DataFrame:
    """RUNS of the texts in order of content; a run's first row is its best, as the order goes on with what decides."""
    order = ["head", "digest", F.desc("chars"), F.asc_nulls_last("doc_id"), "row"]
    ranged = reps.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs(TaskContext.get().partitionId())
        for batch in in_pieces(batches, 4):
            for row, doc_id, n, digest, text in zip(*(column.to_pylist() for column in batch.columns)):
                if text != runs.text:
                    runs.end()
                    if len(runs.waiting) >= BLOCK:
                        yield runs.put_out()
                    runs.begin(text, digest, doc_id, row)
                runs.refs.append(row)
                runs.size += n
        runs.end()
        if runs.number >= 0:
            runs.waiting.append((runs.part, None, None, None, None, None, None, runs.number + 1, runs.first, runs.text))
            yield runs.put_out()

    return ranged.select("row", "doc_id", "n", "digest", "text").mapInArrow(run, RUNS)


def _across_ranges(runs: DataFrame) -> DataFrame:
    """(part, run, total, keep_id, keep_row) of first and last runs, as parts of runs over several ranges.

    The driver sees two short rows for each range, never a text; the texts at borders are compared by a join.
    """
    spark = runs.sparkSession
    borders = runs.where("runs is not null").select("part", "runs", "first", "last")
    ends = runs.where("run is not null").drop("runs").join(F.broadcast(borders.select("part", "runs")), "part").where("run = 0 or run = runs - 1")
    known = {(r.part, r.run): r for r in ends.groupBy("part", "run").agg(*(F.first(c).alias(c) for c in ("size", "keep_id", "keep_row", "runs"))).collect()}
    parts = sorted({part for part, _ in known})
    pairs = spark.createDataFrame(list(zip(parts, parts[1:])), "part int, next int")
    after = borders.select(F.col("part").alias("next"), F.col("first").alias("text"))
    met = {r.next for r in borders.join(pairs, "part").join(after, "next").where("last = text").select("next").collect()}
    chains: list[list[Row]] = []
    for part, run in sorted(known):
        if run == 0 and part in met:
            chains[-1].append(known[part, run])
        else:
            chains.append([known[part, run]])
    rows = [(r.part, r.run, sum(x.size for x in chain), chain[0].keep_id, chain[0].keep_row) for chain in chains if len(chain) > 1 for r in chain]
    return spark.createDataFrame(rows, ENDS)


def _classes(rows: DataFrame) -> DataFrame:
    """(row, doc_id, keep_id, group_size, kept, digest) of (row, doc_id, text), whose row numbers are distinct."""
    known = stored(_normalised(rows), "content-rows")
    runs = stored(_neighbours(known.where("text is not null")), "content-runs")
    # Two rows at most for each range.
    ends = F.broadcast(_across_ranges(runs).select("part", "run", "total", *(F.col(c).alias(f"all_{c}") for c in ("keep_id", "keep_row"))))
    found = runs.where("ref is not null").join(ends, ["part", "run"], "left")
    whole = F.col("total").isNotNull()
    found = found.select(
        "ref", "digest", F.coalesce("total", "size").alias("group_size"),
        *(F.when(whole, F.col(f"all_{c}")).otherwise(F.col(c)).alias(c) for c in ("keep_id", "keep_row")),
    )
    return known.select("row", "doc_id", "ref").join(found, "ref").select(
        "row", "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest"
    )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of docs (doc_id, text)."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _classes(rows).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    row = fresh_name(docs, "row")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "content-documents")
    found = _classes(numbered.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return numbered.join(found.where("kept").select(F.col("row").alias(row)).hint("merge"), row, "left_semi").select(docs.columns)
