"""Benchmark decontamination with a positional inverted index over the training documents.

The index is sharded by document: a segment holds a few million words of whole documents, and for each of its terms the
sorted word positions, counted through the segment with a gap between documents. It is written to the shared scratch folder.
A search takes the benchmark in blocks of bounded size. It finds how often each test term occurs in all segments, starts from
the postings of a window's rarest term and intersects them with the other terms' postings, each moved by its offset. No term,
however frequent, is gathered in one place: a segment's share of its postings is all that a task sees.

Words are lower-cased (A-Z only) runs of digits, letters and non-ASCII characters. Null and empty texts have no words and no
hits. Items without words match nothing; items without an id hit words, but are not listed; repeated item rows count once.
Repeated document rows get a row each, null ids included. An empty benchmark leaves all documents clean, and an empty table of
documents gives no rows. Texts and items may be of any length. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import WORD, stored, utf8, without

WINDOW = 10
NEAR = 20
SEGMENT_WORDS = 2_000_000
BLOCK_ITEMS, BLOCK_WORDS = 5_000, 500_000
CANDIDATES = 2_000_000

_word = re.compile(WORD.encode("ascii"))
INDEX_SCHEMA = "segment long, doc_ids array<long>, marks array<long>, lengths binary, terms binary, counts binary, steps binary"
FOUND_SCHEMA = "segment long, place int, doc_id long, mark long, n_words long, spans array<struct<start:int,end:int>>, items array<long>, near_items array<long>"


def words_of(text: str | None) -> list[bytes]:
    return _word.findall(utf8(text).lower())


class _Segment:
    """Postings of the documents added so far."""

    def __init__(self) -> None:
        self.ids: defaultdict[bytes, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.doc_ids: list[int | None] = []
        self.marks: list[int] = []
        self.streams: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, mark: int, words: list[bytes]) -> None:
        self.doc_ids.append(doc_id)
        self.marks.append(mark)
        self.streams.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def row(self, segment: int) -> pa.RecordBatch:
        lengths = np.array([len(s) for s in self.streams], "<i4")
        starts = _starts(lengths)
        stream = np.concatenate(self.streams) if self.streams else np.zeros(0, np.int32)
        positions = np.arange(len(stream), dtype=np.int64) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)
        order = np.argsort(stream, kind="stable")
        counts = np.bincount(stream, minlength=len(self.ids)).astype("<i4")
        listed = positions[order]
        steps = np.diff(listed, prepend=0)
        firsts = np.cumsum(counts) - counts
        steps[firsts] = listed[firsts]
        values = [segment, self.doc_ids, self.marks, lengths.tobytes(), b" ".join(self.ids), counts.tobytes(), steps.astype("<i4").tobytes()]
        kinds = [pa.int64(), *[pa.list_(pa.int64())] * 2, *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(values, kinds)], ["segment", "doc_ids", "marks", "lengths", "terms", "counts", "steps"]
        )


def _starts(lengths: np.ndarray) -> np.ndarray:
    """First positions of documents that follow one another with one free position between them."""
    return np.cumsum(lengths.astype(np.int64) + 1) - lengths - 1


def build_index(docs: DataFrame, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The stored index: one row per segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, segment = TaskContext.get().partitionId() << 32, _Segment()
        for batch in batches:
            for doc_id, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = words_of(text.as_py())
                if segment.doc_ids and segment.size + len(words) > segment_words:
                    yield segment.row(number)
                    number, segment = number + 1, _Segment()
                segment.add(doc_id, mark, words)
        if segment.doc_ids:
            yield segment.row(number)

    return stored(docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), "text").mapInArrow(run, INDEX_SCHEMA), "positional-index")


class _Windows:
    """The test windows of a block of items: term numbers, padded with -1, in order of rarity once counts are known."""

    def __init__(self, items: Iterable[tuple[int | None, str | None]], window: int) -> None:
        ids: defaultdict[bytes, int] = defaultdict()
        ids.default_factory = ids.__len__
        rows, owners = {}, []
        for item, text in items:
            numbers = [ids[word] for word in words_of(text)]
            for at in range(max(1, len(numbers) - window + 1) if numbers else 0):
                rows.setdefault(tuple(numbers[at : at + window]), set()).add(item)
        self.ids = dict(ids)
        self.sizes = np.array([len(row) for row in rows], np.int64)
        self.terms = np.full((len(rows), window), -1, np.int64)
        for at, row in enumerate(rows):
            self.terms[at, : len(row)] = row
        for at, items_of in enumerate(rows.values()):
            owners += [(at, item) for item in items_of if item is not None]
        self.owner_row = np.array([at for at, _ in owners], np.int64)
        self.owner_item = np.array([item for _, item in owners], np.int64)
        self.order = np.zeros_like(self.terms)

    def by_rarity(self, frequency: np.ndarray) -> None:
        keys = np.where(self.terms < 0, np.iinfo(np.int64).max, frequency[self.terms] if len(frequency) else 0)
        self.order = np.argsort(keys, axis=1, kind="stable")

    def items(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row given, its items: indexes into the rows, item ids."""
        first, last = np.searchsorted(self.owner_row, rows), np.searchsorted(self.owner_row, rows, "right")
        at = np.repeat(np.arange(len(rows)), last - first)
        within = np.arange(len(at)) - np.repeat(np.cumsum(last - first) - (last - first), last - first)
        return at, self.owner_item[first[at] + within]


def _frequencies(index: DataFrame, ids: dict[bytes, int]) -> np.ndarray:
    """How often each test term occurs in all documents; one row per test term comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            for terms, counts in zip(batch.column(0), batch.column(1)):
                found = np.frombuffer(counts.as_buffer(), "<i4")
                for at, word in enumerate(terms.as_py().split(b" ")):
                    if word in ids:
                        total[ids[word]] += found[at]
        seen = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["term", "n"])

    frequency = np.zeros(len(ids), np.int64)
    if ids:
        for row in index.select("terms", "counts").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
            frequency[row.term] = row.n
    return frequency


class _Postings:
    """A segment's postings of the test terms as one sorted array of term * 2**32 + position."""

    def __init__(self, terms: bytes, counts: np.ndarray, steps: np.ndarray, ids: dict[bytes, int]) -> None:
        words, lasts = terms.split(b" "), np.cumsum(counts, dtype=np.int64)
        used = sorted((ids[word], at) for at, word in enumerate(words) if word in ids) if len(counts) else []
        lists = [np.cumsum(steps[lasts[at] - counts[at] : lasts[at]], dtype=np.int64) + (term << 32) for term, at in used]
        self.keys = np.concatenate(lists) if lists else np.zeros(0, np.int64)

    def range(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.searchsorted(self.keys, terms << 32), np.searchsorted(self.keys, (terms + 1) << 32)

    def has(self, terms: np.ndarray, positions: np.ndarray) -> np.ndarray:
        wanted = (terms << 32) + positions
        at = np.searchsorted(self.keys, wanted)
        return (positions >= 0) & (self.keys[np.minimum(at, len(self.keys) - 1)] == wanted)

    def nth_from(self, terms: np.ndarray, positions: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th position (from 0) of a term at or after the given one; far away if there is none."""
        at = np.searchsorted(self.keys, (terms << 32) + np.maximum(positions, 0)) + n
        key = self.keys[np.minimum(at, len(self.keys) - 1)]
        return np.where((at < len(self.keys)) & (key >> 32 == terms), key & 0xFFFFFFFF, np.int64(1) << 40)

    def anchors(self, windows: _Windows, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All positions of the rarest term of each window: indexes of windows, positions."""
        first, last = self.range(windows.terms[rows, windows.order[rows, 0]])
        at = np.repeat(np.arange(len(rows)), last - first)
        within = np.arange(len(at)) - np.repeat(np.cumsum(last - first) - (last - first), last - first)
        return rows[at], self.keys[first[at] + within] & 0xFFFFFFFF


def _blocks(postings: _Postings, windows: _Windows) -> Iterator[np.ndarray]:
    """Windows in runs whose rarest terms have a bounded number of positions together."""
    rows = np.arange(len(windows.sizes))
    if not len(rows) or not len(postings.keys):
        return
    first, last = postings.range(windows.terms[rows, windows.order[:, 0]])
    rows, count = rows[last > first], (last - first)[last > first]
    group = np.cumsum(count) // CANDIDATES
    for number in np.unique(group):
        yield rows[group == number]


def phrases(postings: _Postings, windows: _Windows) -> tuple[np.ndarray, np.ndarray]:
    """All exact occurrences: window rows and their first positions."""
    found = []
    for rows in _blocks(postings, windows):
        row, start = postings.anchors(windows, rows)
        start = start - windows.order[row, 0]
        for step in range(1, windows.terms.shape[1]):
            offset = windows.order[row, step]
            term = windows.terms[row, offset]
            keep = (term < 0) | postings.has(np.maximum(term, 0), start + offset)
            row, start = row[keep], start[keep]
        keep = start >= 0
        found.append((row[keep], start[keep]))
    return _joined(found)


def proximities(postings: _Postings, windows: _Windows, within: int, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of all words of a window, in any order, inside `within` words of a document: rows, positions of the rarest."""
    found = []
    ends = starts + lengths
    size = windows.terms.shape[1]
    # How many times a term came before in the window's order: its n-th copy needs an n-th position.
    ordered = np.take_along_axis(windows.terms, windows.order, axis=1)
    copies = np.stack([(ordered[:, :step] == ordered[:, step : step + 1]).sum(axis=1) for step in range(size)], axis=1)
    for rows in _blocks(postings, windows):
        row, anchor = postings.anchors(windows, rows)
        doc = np.searchsorted(starts, anchor, "right") - 1
        for step in range(1, size):
            term = ordered[row, step]
            low = np.maximum(anchor - within + 1, starts[doc])
            reach = postings.nth_from(np.maximum(term, 0), low, copies[row, step])
            keep = (term < 0) | (reach < np.minimum(anchor + within, ends[doc]))
            row, anchor, doc = row[keep], anchor[keep], doc[keep]
        fits = np.zeros(len(row), bool)
        for back in range(within):
            low = anchor - back
            inside = low >= starts[doc]
            for step in range(size):
                term = ordered[row, step]
                reach = postings.nth_from(np.maximum(term, 0), low, copies[row, step])
                inside &= (term < 0) | (reach < np.minimum(low + within, ends[doc]))
            fits |= inside
        found.append((row[fits], anchor[fits]))
    return _joined(found)


def _joined(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, places = zip(*found)
    return np.concatenate(rows), np.concatenate(places)


def _items_by_doc(windows: _Windows, row: np.ndarray, doc: np.ndarray) -> dict[int, list[int]]:
    at, item = windows.items(row)
    found: dict[int, list[int]] = {}
    if len(at):
        pairs = np.unique(np.stack([doc[at], item], axis=1), axis=0)
        for place, value in pairs.tolist():
            found.setdefault(place, []).append(value)
    return found


def _search_block(index: DataFrame, windows: _Windows, within: int) -> DataFrame:
    windows.by_rarity(_frequencies(index, windows.ids))
    ids = windows.ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                segment, doc_ids, marks, lengths, terms, counts, steps = (batch.column(i)[at] for i in range(7))
                size = np.frombuffer(lengths.as_buffer(), "<i4").astype(np.int64)
                first = _starts(size)
                postings = _Postings(terms.as_py(), *(np.frombuffer(x.as_buffer(), "<i4") for x in (counts, steps)), ids)
                row, start = phrases(postings, windows)
                doc = np.searchsorted(first, start, "right") - 1
                items = _items_by_doc(windows, row, doc)
                row_near, place = proximities(postings, windows, within, first, size)
                near = _items_by_doc(windows, row_near, np.searchsorted(first, place, "right") - 1)
                spans = _spans(doc, start - first[doc], windows.sizes[row])
                n = len(size)
                yield pa.RecordBatch.from_pylist(
                    [
                        {"segment": segment.as_py(), "place": i, "doc_id": doc_id, "mark": mark, "n_words": words, "spans": spans.get(i, []), "items": items.get(i, []), "near_items": near.get(i, [])}
                        for i, doc_id, mark, words in zip(range(n), doc_ids.as_py(), marks.as_py(), size.tolist())
                    ],
                    schema=_found_type(),
                )

    return index.mapInArrow(run, FOUND_SCHEMA)


def _found_type() -> pa.Schema:
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    return pa.schema([("segment", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(span)), ("items", pa.list_(pa.int64())), ("near_items", pa.list_(pa.int64()))])


def _spans(doc: np.ndarray, start: np.ndarray, size: np.ndarray) -> dict[int, list[dict[str, int]]]:
    """Maximal runs of hit words by document."""
    order = np.lexsort((start, doc))
    found: dict[int, list[dict[str, int]]] = {}
    for place, low, high in zip(doc[order].tolist(), start[order].tolist(), (start + size)[order].tolist()):
        runs = found.setdefault(place, [])
        if runs and low <= runs[-1]["end"]:
            runs[-1]["end"] = max(runs[-1]["end"], high)
        else:
            runs.append({"start": low, "end": high})
    return found


def _item_blocks(rows: Iterable[tuple[int | None, str | None]], block_items: int) -> Iterator[list[tuple[int | None, str | None]]]:
    block, words = [], 0
    for item, text in rows:
        own = len(words_of(text))
        if block and (len(block) >= block_items or words + own > BLOCK_WORDS):
            yield block
            block, words = [], 0
        block.append((item, text))
        words += own
    if block:
        yield block


def search(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, within: int = NEAR, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Per indexed document: doc_id, mark (a hash of its text), n_words, spans (runs of hit word places), items and near_items (item
    ids, ascending).

    The benchmark comes to the driver in blocks of at most `block_items` items and about BLOCK_WORDS words, each searched in a
    pass over the index; one longer item is a block of its own.
    """
    rows = benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator()
    passes = [_search_block(index, _Windows([], window), within)]
    for block in _item_blocks(((row[0], row[1]) for row in rows), block_items):
        passes.append(_search_block(index, _Windows(block, window), within))
    if len(passes) < 3:
        return passes[-1].drop("segment", "place")
    every = passes[1]
    for one in passes[2:]:
        every = every.unionByName(one)
    gather = lambda name: F.array_sort(F.array_distinct(F.flatten(F.collect_list(name)))).alias(name)
    return every.groupBy("segment", "place").agg(
        F.first("doc_id").alias("doc_id"), F.first("mark").alias("mark"), F.first("n_words").alias("n_words"), gather("spans"), gather("items"), gather("near_items")
    ).drop("segment", "place")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """`search` over an index of docs, with n_hit, n_items and contaminated (a word lies inside an exact match)."""
    found = search(build_index(docs), benchmark, **options)
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["end"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["end"], s["start"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    return found.withColumn("n_hit", covered).withColumn("n_items", F.size("items").cast("long")).withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """The documents without any word inside an exact match; a row is known by its doc_id, which may be null, and a hash of its text."""
    return without(docs, decontaminate(docs, benchmark, **options).where("contaminated"))
