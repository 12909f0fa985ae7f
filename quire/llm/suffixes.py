"""Removal of repeated byte strings with a distributed, hash-compared suffix sort.

A byte goes if it lies in a string of `length` bytes that also starts earlier: in a document with a smaller doc_id, or further
ahead in the same one. Every such string, a window, is decided exactly, in three steps.

1. Runs. The smallest hash among a window's grams names its anchor, and consecutive windows share one. Equal windows have equal
   grams at equal distances, so only runs with the same gram can match. Equal whole runs are resolved here: all but the first go.
2. Suffix sort. Where a gram has different runs, the suffixes that begin at their windows are sorted by mergesort. Two suffixes
   are compared by a binary search for their common extension over prefix polynomial hashes; neighbours that agree in `length`
   bytes are verified byte by byte, and a gram whose hashes collide is sorted again by its bytes.
3. The removed intervals of a document come together and its remaining bytes are joined.

A task reduces what it sends to the first of equal runs or windows. Grams that a sample shows in very many documents are dealt
out by run, and by as many groups of windows as they need, instead of by gram, so no task gathers them; any choice of such grams
gives the same result.

Null texts are empty. Rows with equal doc_id are ordered by a hash of their text; equal rows are one document and each get its
result. Null doc_ids come before all others. Texts shorter than `length` keep every byte. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stored, utf8

LENGTH, GRAM = 100, 32
SLICE = 1 << 19
PLACE_BITS = 20
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
HOT_SAMPLE, HOT_GRAMS = 0.02, 10_000
# A gram is hot if it alone would make up this part of a bucket.
HOT_PART = 0.25
SENT = "bucket int, docs binary, keys binary, marks binary, owners binary, starts binary, counts binary"
CUTS = "doc long, mark long, kind int, starts binary, ends binary, keys binary"
PIECES = "bucket int, docs binary, texts binary, keys binary, owners binary, starts binary, counts binary"


class Hashes:
    """Polynomial prefix hashes modulo 2**64: any substring's hash in constant time."""

    def __init__(self, text: np.ndarray, base: int) -> None:
        inverse = pow(base, -1, 1 << 64)
        powers = np.full(len(text) + 1, base, np.uint64)
        self.inverse = np.full(len(text) + 1, inverse, np.uint64)
        powers[0] = self.inverse[0] = 1
        powers, self.inverse = np.cumprod(powers), np.cumprod(self.inverse)
        self.prefix = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers[:-1], out=self.prefix[1:])

    def of(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self.prefix[start + size] - self.prefix[start]) * self.inverse[start]

    def every(self, size: int) -> np.ndarray:
        """Of all substrings of one size."""
        return (self.prefix[size:] - self.prefix[:-size]) * self.inverse[: len(self.prefix) - size]


def _mixed(values: np.ndarray) -> np.ndarray:
    """Spread a polynomial hash over all bits."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def _runs(text: np.ndarray, valid: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with a common anchor: first window, number of windows, hash of the gram, hash of the run's bytes.

    valid[i] is the document of the window that begins at i, or -1.
    """
    first = Hashes(text, BASES[0])
    grams = _mixed(first.every(gram))
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width, reach = 1, length - gram + 1
    while width * 2 <= reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < reach:
        least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
    anchor = (least & low).astype(np.int64)
    valid = valid[: len(anchor)]
    change = np.ones(len(anchor), bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
    begins = np.nonzero(change)[0]
    counts = np.diff(np.append(begins, len(anchor)))
    use = valid[begins] >= 0
    begins, counts = begins[use], counts[use]
    second = Hashes(text, BASES[1])
    marks = _mixed(second.of(begins, counts + length - 1) + counts.astype(np.uint64))
    return begins, counts, grams[anchor[begins]], marks


class _Docs:
    """Texts of a batch as byte arrays, in slices of bounded size."""

    def __init__(self, texts: list[str | None]) -> None:
        self.texts = [np.frombuffer(utf8(text), np.uint8) for text in texts]

    def slices(self, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(bytes, document of the window at each place or -1, place of each byte in its document)."""
        held, size = [], 0
        for number, text in enumerate(self.texts):
            for at in range(0, max(0, len(text) - length + 1), SLICE):
                windows = min(SLICE, len(text) - length + 1 - at)
                part = text[at : at + windows + length - 1]
                if held and size + len(part) > SLICE:
                    yield self._joined(held, length)
                    held, size = [], 0
                held.append((number, at, part))
                size += len(part)
        if held:
            yield self._joined(held, length)

    @staticmethod
    def _joined(held: list[tuple[int, int, np.ndarray]], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        text = np.concatenate([part for _, _, part in held])
        owner = np.concatenate([np.where(np.arange(len(part)) <= len(part) - length, number, -1) for number, _, part in held])
        place = np.concatenate([np.arange(at, at + len(part)) for _, at, part in held])
        return text, owner, place


def _identified(docs: DataFrame) -> DataFrame:
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", doc.alias("doc"), F.xxhash64("text").alias("mark"))


def _entries(texts: list[str | None], length: int, gram: int) -> list[np.ndarray]:
    """Runs of all texts: gram hash, run hash, document, start, windows."""
    parts = []
    for text, owner, place in _Docs(texts).slices(length):
        begins, counts, keys, marks = _runs(text, owner, length, gram)
        parts.append((keys, marks, owner[begins].astype(np.int64), place[begins].astype(np.int64), counts.astype(np.int64)))
    if not parts:
        return [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)] * 3
    return [np.concatenate(column) for column in zip(*parts)]


def _hot_grams(docs: DataFrame, buckets: int, length: int, gram: int) -> dict[int, int]:
    """Grams with a large part of all runs in a sample, at most HOT_GRAMS, and into how many parts each is split.

    Only a hint how to deal out the work.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts = np.unique(_entries(batch.column(0).to_pylist(), length, gram)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], ["key", "n"])

    sampled = docs.select("text").sample(HOT_SAMPLE, seed=1)
    sums = stored(sampled.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "suffix-sample")
    total = sums.agg(F.sum("n")).first()[0] or 0
    hot = sums.where(F.col("n") >= max(2, HOT_PART * total / buckets))
    rows = hot.orderBy(F.desc("n"), "key").limit(HOT_GRAMS).collect()
    return {row.key & (2**64 - 1): 1 + math.ceil(row.n * buckets / total / HOT_PART) for row in rows}


def _within(values: np.ndarray, members: np.ndarray) -> np.ndarray:
    if not len(members):
        return np.zeros(len(values), bool)
    return members[np.minimum(np.searchsorted(members, values), len(members) - 1)] == values


def _firsts(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): rows sorted by keys, the last one the most significant; first marks where the two most significant change."""
    order = np.lexsort(keys)
    first = np.ones(len(order), bool)
    a, b = keys[-1][order], keys[-2][order]
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, first


def _heads(order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each sorted row the first row of its class."""
    return order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))] if len(order) else order


def _distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (doc, mark) pairs, and the place of each row's pair among them."""
    order, first = _firsts(ids[:, 1], ids[:, 0])
    place = np.empty(len(ids), np.int64)
    place[order] = np.cumsum(first) - 1
    return ids[order[first]], place


def _cut_rows(ids: np.ndarray, owners: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray, kind: int) -> pa.RecordBatch:
    """A row per document with its intervals; ids: (doc, mark) of each owner."""
    order = np.lexsort((starts, owners))
    owners, starts, ends, keys = owners[order], starts[order].astype("<i8"), ends[order].astype("<i8"), keys[order]
    at = np.nonzero(np.append(True, owners[1:] != owners[:-1]))[0] if len(owners) else np.zeros(0, np.int64)
    bounds = np.append(at, len(owners))
    own = ids[owners[at]] if len(at) else np.zeros((0, 2), np.int64)
    split = lambda values: pa.array([values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(own[:, 0]), pa.array(own[:, 1]), pa.array(np.full(len(at), kind, np.int32)), split(starts), split(ends), split(keys)],
        ["doc", "mark", "kind", "starts", "ends", "keys"],
    )


DROPPED, COMPARED = 0, 1


def _ids(batch: pa.RecordBatch, doc: str = "doc", mark: str = "mark") -> np.ndarray:
    return np.stack([batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in (doc, mark)], axis=1)


def find_runs(docs: DataFrame, hot_parts: dict[int, int], buckets: int, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Step 1: per document, intervals that go (DROPPED) and runs to be compared with others (starts, ends, grams)."""
    hot = np.array(sorted(hot_parts), np.uint64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            ids = _ids(batch)
            keys, marks, owners, starts, counts = _entries(batch.column("text").to_pylist(), length, gram)
            _, rank = _distinct(ids)
            order, first = _firsts(starts, rank[owners], marks, keys)
            bucket = (_mixed(np.where(_within(keys, hot), keys ^ marks, keys)) % np.uint64(buckets)).astype(np.int64)
            keep = order[first]
            again = order[~first]
            # A repeat of the very same document and place is that document once more.
            head = _heads(order, first)[~first]
            again = again[(rank[owners[again]] != rank[owners[head]]) | (starts[again] != starts[head])]
            for number_of, chosen in _by_bucket(bucket, keep):
                yield _sent(number_of, ids, keys, marks, owners, starts, counts, chosen)
            if len(again):
                yield _sent((shift + number) % buckets, ids, keys, marks, owners, starts, -counts, again)

    def resolve(group: pa.Table) -> pa.Table:
        ids, keys, marks, owners, starts, counts = _gathered(group)
        dropped = counts < 0
        out = [_cut_rows(ids, owners[dropped], starts[dropped], starts[dropped] - counts[dropped] + length - 1, keys[dropped], DROPPED)]
        keys, marks, owners, starts, counts = (x[~dropped] for x in (keys, marks, owners, starts, counts))
        hotness = _within(keys, hot)
        _, place, seen = np.unique(keys, return_inverse=True, return_counts=True)
        use = (seen[place] > 1) | hotness
        keys, marks, owners, starts, counts, hotness = (x[use] for x in (keys, marks, owners, starts, counts, hotness))
        order, first = _firsts(starts, ids[owners, 1], ids[owners, 0], marks, keys)
        head = _heads(order, first)
        same = (owners[order] == owners[head]) & (starts[order] == starts[head]) & ~first
        again = order[~first & ~same]
        out.append(_cut_rows(ids, owners[again], starts[again], starts[again] + counts[again] + length - 1, keys[again], DROPPED))
        keep = order[first]
        _, place, seen = np.unique(keys[keep], return_inverse=True, return_counts=True)
        chosen = keep[(seen[place] > 1) | hotness[keep]]
        out.append(_cut_rows(ids, owners[chosen], starts[chosen], starts[chosen] + counts[chosen] + length - 1, keys[chosen], COMPARED))
        return pa.Table.from_batches(out)

    sent = docs.select("doc", "mark", "text").mapInArrow(send, SENT)
    return stored(sent.groupBy("bucket").applyInArrow(resolve, CUTS), "suffix-runs")


def _by_bucket(bucket: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    rows = rows[np.argsort(bucket[rows], kind="stable")]
    numbers, at = np.unique(bucket[rows], return_index=True)
    for number, low, high in zip(numbers.tolist(), at, np.append(at[1:], len(rows))):
        yield number, rows[low:high]


def _sent(
    bucket: int, ids: np.ndarray, keys: np.ndarray, marks: np.ndarray, owners: np.ndarray, starts: np.ndarray, counts: np.ndarray, rows: np.ndarray
) -> pa.RecordBatch:
    used, owner = np.unique(owners[rows], return_inverse=True)
    values = [ids[used].astype("<i8"), keys[rows], marks[rows], owner.astype("<i4"), starts[rows].astype("<i4"), counts[rows].astype("<i4")]
    names = ["bucket", "docs", "keys", "marks", "owners", "starts", "counts"]
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in values)], names)


def _merged_ids(columns: list[pa.Scalar], sizes: list[int], owners: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All documents once, and each row's document."""
    ids = np.concatenate([np.frombuffer(docs.as_buffer(), "<i8").reshape(-1, 2) for docs in columns])
    base = np.cumsum([0, *sizes[:-1]])
    every, place = _distinct(ids)
    return every, place[np.concatenate([own + at for own, at in zip(owners, base)])]


def _gathered(group: pa.Table) -> tuple[np.ndarray, ...]:
    def column(name: str, kind: str) -> list[np.ndarray]:
        return [np.frombuffer(value.as_buffer(), kind) for value in group.column(name)]

    docs = list(group.column("docs"))
    ids, owners = _merged_ids(docs, [len(d.as_py()) // 16 for d in docs], column("owners", "<i4"))
    keys, marks = (np.concatenate(column(name, "<u8")) for name in ("keys", "marks"))
    starts, counts = (np.concatenate(column(name, "<i4")).astype(np.int64) for name in ("starts", "counts"))
    return ids, keys, marks, owners, starts, counts


def common_extension(hashes: Hashes, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Bytes in which the suffixes at a and b agree, at most depth, by binary search over hash equality."""
    found = np.zeros(len(a), np.int64)
    step = 1 << (depth.bit_length() - 1)
    while step:
        tried = np.nonzero(found + step <= depth)[0]
        at = found[tried]
        same = hashes.of(a[tried] + at, step) == hashes.of(b[tried] + at, step)
        found[tried[same]] += step
        step >>= 1
    return found


def suffix_sort(text: np.ndarray, hashes: Hashes, starts: np.ndarray, segment: np.ndarray, depth: int) -> np.ndarray:
    """Stable order of suffixes by their first `depth` bytes within each segment; segments are contiguous.

    Bottom-up mergesort of all segments at once: an element's place is its place in its run and, by binary search, its rank
    in the neighbouring run.
    """
    order = np.arange(len(starts))
    if not len(starts):
        return order
    begins = np.nonzero(np.append(True, segment[1:] != segment[:-1]))[0]
    sizes = np.diff(np.append(begins, len(starts)))
    base, size = np.repeat(begins, sizes), np.repeat(sizes, sizes)
    width = 1
    while width < sizes.max():
        slots = np.nonzero(size > width)[0]
        within = slots - base[slots]
        run = within // width
        other = (run ^ 1) * width
        other_at = base[slots] + other
        low, high = np.zeros(len(slots), np.int64), np.clip(size[slots] - other, 0, width)
        own = starts[order[slots]]
        while (open_ := np.nonzero(low < high)[0]).size:
            middle = (low[open_] + high[open_]) // 2
            rival = starts[order[other_at[open_] + middle]]
            reach = common_extension(hashes, own[open_], rival, depth)
            equal = reach >= depth
            last = np.minimum(reach, depth - 1)
            before = np.where(equal, run[open_] % 2 == 1, text[rival + last] < text[own[open_] + last])
            low[open_[before]] = middle[before] + 1
            high[open_[~before]] = middle[~before]
        placed = order.copy()
        placed[base[slots] + (run // 2) * 2 * width + within % width + low] = order[slots]
        order = placed
        width *= 2
    return order


def equal_classes(text: np.ndarray, starts: np.ndarray, segment: np.ndarray, depth: int) -> np.ndarray:
    """A class number for each suffix: equal numbers for equal first `depth` bytes within a segment. Verified byte by byte."""
    hashes = Hashes(text, BASES[0])
    order = suffix_sort(text, hashes, starts, segment, depth)
    same = np.zeros(len(order), bool)
    left, right = order[:-1], order[1:]
    near = np.nonzero(segment[left] == segment[right])[0]
    near = near[common_extension(hashes, starts[left[near]], starts[right[near]], depth) >= depth]
    broken = []
    for at in range(0, len(near), 1 << 16):
        part = near[at : at + (1 << 16)]
        a, b = (text[starts[x[part]][:, None] + np.arange(depth)] for x in (left, right))
        equal = (a == b).all(axis=1)
        same[part[equal] + 1] = True
        broken.append(segment[left[part[~equal]]])
    classes = np.empty(len(order), np.int64)
    classes[order] = np.cumsum(~same)
    for number in np.unique(np.concatenate(broken)) if broken else ():
        rows = np.nonzero(segment == number)[0]
        names: dict[bytes, int] = {}
        for row in rows:
            classes[row] = -1 - int(rows[0]) - names.setdefault(text[starts[row] : starts[row] + depth].tobytes(), len(names))
    return classes


def _pieces(raw: bytes, low: int, high: int, key: int, owner: int, length: int, parts: int) -> list[tuple]:
    """What a run sends: (number to deal by, gram, document, start, windows, bytes), whole or, in parts, by window."""
    if parts < 2:
        return [(key, key, owner, low, high - low - length + 1, raw[low:high])]
    marks = Hashes(np.frombuffer(raw, np.uint8)[low:high], BASES[1]).every(length).tolist()
    # Equal windows have equal hashes and so the same part.
    dealt = [(key + (mark >> 32) % parts) & (2**64 - 1) for mark in marks]
    return [(number, key, owner, low + at, 1, raw[low + at : low + at + length]) for at, number in enumerate(dealt)]


def compare_runs(docs: DataFrame, runs: DataFrame, hot_parts: dict[int, int], buckets: int, length: int = LENGTH) -> DataFrame:
    """Step 2: per document, the intervals of windows that also start earlier, among the runs to be compared."""
    open_runs = runs.where(F.col("kind") != DROPPED).groupBy("doc", "mark").agg(F.collect_list(F.struct("kind", "starts", "ends", "keys")).alias("runs"))
    joined = docs.select("doc", "mark", "text").join(open_runs, ["doc", "mark"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, pieces = _ids(batch), []
            seen: set[tuple[int, int]] = set()
            for owner, (text, lists) in enumerate(zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist())):
                # Equal rows are one document.
                if (name := tuple(ids[owner])) in seen:
                    continue
                seen.add(name)
                raw = utf8(text)
                for one in lists:
                    starts, ends, keys = (np.frombuffer(one[n], "<i8").tolist() for n in ("starts", "ends", "keys"))
                    for low, high, key in zip(starts, ends, keys):
                        gram = key & (2**64 - 1)
                        pieces += _pieces(raw, low, high, gram, owner, length, hot_parts.get(gram, 1))
            if not pieces:
                continue
            dealt, keys, owners, starts, counts, texts = (list(column) for column in zip(*pieces))
            bucket = (_mixed(np.array(dealt, np.uint64)) % np.uint64(buckets)).astype(np.int64)
            keys, owners = np.array(keys, np.uint64), np.array(owners, np.int64)
            starts, counts = np.array(starts, "<i4"), np.array(counts, "<i4")
            for number, rows in _by_bucket(bucket, np.arange(len(texts))):
                used, owner = np.unique(owners[rows], return_inverse=True)
                values = [
                    ids[used].astype("<i8").tobytes(), b"".join(texts[i] for i in rows), keys[rows].tobytes(),
                    owner.astype("<i4").tobytes(), starts[rows].tobytes(), counts[rows].tobytes(),
                ]
                columns = [pa.array([number], pa.int32()), *(pa.array([v], pa.binary()) for v in values)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "docs", "texts", "keys", "owners", "starts", "counts"])

    def resolve(group: pa.Table) -> pa.Table:
        column = lambda name, kind: [np.frombuffer(v.as_buffer(), kind) for v in group.column(name)]
        docs_of = list(group.column("docs"))
        ids, owners = _merged_ids(docs_of, [len(d.as_py()) // 16 for d in docs_of], column("owners", "<i4"))
        text = np.concatenate(column("texts", np.uint8))
        keys = np.concatenate(column("keys", "<u8"))
        starts, counts = (np.concatenate(column(name, "<i4")).astype(np.int64) for name in ("starts", "counts"))
        sizes = counts + length - 1
        piece_at = np.cumsum(sizes) - sizes
        piece = np.repeat(np.arange(len(counts)), counts)
        step = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts)
        at, place, owner = piece_at[piece] + step, starts[piece] + step, owners[piece]
        # A window whose hash is alone among the runs of its gram has no equal; only the others are sorted.
        marks = Hashes(text, BASES[1]).of(at, length) ^ keys[piece]
        _, name, seen = np.unique(marks, return_inverse=True, return_counts=True)
        use = np.nonzero(seen[name] > 1)[0]
        use = use[np.argsort(keys[piece[use]], kind="stable")]
        at, place, owner = at[use], place[use], owner[use]
        segment = np.cumsum(np.append(0, np.diff(keys[piece[use]]) != 0)) if len(use) else np.zeros(0, np.int64)
        classes = equal_classes(text, at, segment, length)
        order, first = _firsts(place, ids[owner, 1], ids[owner, 0], classes, segment)
        head = _heads(order, first)[~first]
        again = order[~first]
        again = again[(owner[again] != owner[head]) | (place[again] != place[head])]
        low, high, own = _intervals(owner[again], place[again], length)
        return pa.Table.from_batches([_cut_rows(ids, own, low, high, np.zeros(len(low), np.uint64), DROPPED)])

    sent = joined.mapInArrow(send, PIECES)
    return sent.groupBy("bucket").applyInArrow(resolve, CUTS)


def _intervals(owners: np.ndarray, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive windows as byte intervals: starts, ends, owners."""
    order = np.lexsort((places, owners))
    owners, places = owners[order], places[order]
    change = np.append(True, (owners[1:] != owners[:-1]) | (places[1:] != places[:-1] + 1)) if len(order) else np.zeros(0, bool)
    at = np.nonzero(change)[0]
    lasts = np.append(at[1:], len(order)) - 1 if len(at) else at
    return places[at], places[lasts] + length, owners[at]


def _cut(text: bytes, intervals: list[tuple[bytes, bytes]]) -> tuple[list[dict[str, int]], bytes]:
    """Maximal removed runs, touching ones joined, and what is left."""
    pairs = np.array(sorted(p for a, b in intervals for p in zip(np.frombuffer(a, "<i8").tolist(), np.frombuffer(b, "<i8").tolist())))
    spans: list[dict[str, int]] = []
    for low, high in pairs.tolist():
        if spans and low <= spans[-1]["end"]:
            spans[-1]["end"] = max(spans[-1]["end"], high)
        else:
            spans.append({"start": low, "end": high})
    edges = [0, *(x for s in spans for x in (s["start"], s["end"])), len(text)]
    return spans, b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _bucket_count(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, buckets: int | None = None) -> DataFrame:
    """Per document: doc_id, n_bytes, spans (removed byte runs) and kept (the remaining bytes)."""
    known = _identified(docs)
    buckets = buckets or _bucket_count(docs)
    hot_parts = _hot_grams(known, buckets, length, gram)
    runs = find_runs(known, hot_parts, buckets, length, gram)
    cuts = runs.where(F.col("kind") == DROPPED).unionByName(compare_runs(known, runs, hot_parts, buckets, length))
    cuts = stored(cuts.select("doc", "mark", "starts", "ends"), "suffix-cuts")
    gathered = cuts.groupBy("doc", "mark").agg(F.collect_list(F.struct("starts", "ends")).alias("cuts"))
    whole = known.join(gathered, ["doc", "mark"], "left").select("doc_id", "text", "cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            texts = [utf8(text) for text in batch.column(1).to_pylist()]
            found = [_cut(text, [(c["starts"], c["ends"]) for c in cuts] if cuts else []) for text, cuts in zip(texts, batch.column(2).to_pylist())]
            sizes, kept = pa.array([len(t) for t in texts], pa.int64()), pa.array([k for _, k in found], pa.binary())
            spans = pa.array([s for s, _ in found], pa.list_(span))
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, spans, kept], ["doc_id", "n_bytes", "spans", "kept"])

    return whole.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def removed(spans: Column) -> Column:
    """Bytes in the removed runs."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
