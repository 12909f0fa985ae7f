"""Line dedup by an exact set-similarity join: lines whose word sets have a Jaccard similarity of 0.8 or more.

A line goes if an earlier line (a smaller doc_id, or further up in the same document) is that similar, judged on the input.
Words are ordered by rarity, so that similar sets must share one of their first words; every set is listed under these prefix
words only. Under a word, pairs pass the length filter, the positional filter and a bitmap of the sets; the pairs that are left leave the
task as a spanning forest of names. Each set in such a forest is sent once more, as its line's text, to the block of its component. There a
pair is verified by all words, known by 64-bit hashes, and counted under its first common word; a component of more than MEMBERS sets
or LARGE words is verified under its prefix words, bucket by bucket. Equal sets are reduced to the first one before any pair
is formed. Of the verified pairs, counts and a spanning forest leave the task; connected components of these are the classes of lines.

Rarity comes from a table of counters over all words, of fixed size: words that share a counter only look more frequent. Any
order is right as long as all lines use the same. Words with very high counts are dealt out by set size too.

Words are lower-cased (A-Z only) runs of digits, letters and non-ASCII characters. Lines are what line feeds separate; a line
without words is never removed. Null texts have no lines. Rows with equal doc_id are ordered by a hash of their text; equal rows
are one document and each get its result. Null doc_ids come first. An empty table gives no rows. Other columns, whatever their names, are
passed on by `kept_lines` and ignored by `dedup_lines`. Texts and lines may be of any length; the words of one text must fit a task's memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import connected_components, discard, fresh_name, merged, stored, utf8
from quire.llm.suffixes import BASES

SLOT_BITS, SLICES = 22, 16
# What a counter's byte stands for: counts up to 64, then steps of a tenth.
LEVELS = np.minimum(np.append(np.arange(64), np.floor(64 * 1.095 ** np.arange(192))), 2**31 - 1).astype(np.int32)
# A word is hot if it has this part of a bucket's words.
HOT_PART = 0.125
# Pairs formed at once: a task holds some 150 bytes of each.
PAIRS = 1 << 18
# Words looked up at once, and sets and words of a component from which on it is verified bucket by bucket.
VERIFIED, MEMBERS, LARGE = 1 << 20, 1 << 9, 1 << 18
DROPPED, SETS, LISTED, REPEATED = range(4)
# Sets of at most NARROW words have bitmaps of 96 bits, those of more than WIDE of 256, others of 128.
NARROW, WIDE = 64, 128
# Bytes of a listed set's name and of a word's key. Both only choose what meets: sets that share them are told apart when they are verified.
NAME, KEY = 5, 3

SLICE, PIECE = 1 << 20, 1 << 22
# Bits that tell which lines may be wanted, 64 to a row of a broadcast table.
WANTED_BITS = 25
# The bytes of a word, once A-Z are lower-cased.
IN_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
SENT = "bucket int, kind int, docs binary, owners binary, lines binary, sets binary, sizes binary, keys binary, bitmaps binary, places binary"
FOUND = "kind int, bucket int, doc long, mark long, line int, size int, name long, joined long"
LINKS = "doc long, mark long, line int, name long, links long, gone boolean, joined long"


def _word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and line of every word, in order; the texts go through in slices of bounded size."""
    parts, held, size = [], [], 0
    for number, text in enumerate(raw):
        held.append(number)
        size += len(text) + 1
        if size >= SLICE or number == len(raw) - 1:
            bytes_of = np.frombuffer(b"\n".join([*(raw[n].lower() for n in held), b""]), np.uint8)
            inside = IN_WORD[bytes_of]
            first = np.nonzero(inside & np.append(True, ~inside[:-1]))[0]
            end = np.nonzero(inside & np.append(~inside[1:], True))[0] + 1
            powers, inverse = _powers(max(5, 1 + 4 * len(bytes_of) // SLICE) * SLICE // 4)
            prefix = np.zeros(len(bytes_of) + 1, np.uint64)
            np.cumsum((bytes_of.astype(np.uint64) + np.uint64(1)) * powers[: len(bytes_of)], out=prefix[1:])
            hashes = (prefix[end] - prefix[first]) * inverse[first] + (end - first).astype(np.uint64)
            starts = np.cumsum([0, *(len(raw[n]) + 1 for n in held[:-1])])
            own = np.searchsorted(starts, first, "right") - 1
            feeds = np.cumsum(bytes_of == 10)
            before = np.append(0, feeds)[starts]
            parts.append((_mixed(hashes), np.array(held)[own], feeds[first] - before[own]))
            held, size = [], 0
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(column) for column in zip(*parts))


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the base of word hashes and its inverse, which most slices of text share."""
    powers, inverse = np.full(n, BASES[0], np.uint64), np.full(n, pow(BASES[0], -1, 1 << 64), np.uint64)
    powers[0] = inverse[0] = 1
    return np.cumprod(powers), np.cumprod(inverse)


def _pieces(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches cut to PIECE bytes of text, or to one row where it has more."""
    for batch in batches:
        sizes = np.array([len(v.as_buffer()) if v.is_valid else 0 for v in batch.column(column)], np.int64)
        group = np.cumsum(sizes) // PIECE
        bounds = [0, *(np.nonzero(np.diff(group))[0] + 1).tolist(), batch.num_rows] if batch.num_rows else []
        for low, high in zip(bounds, bounds[1:]):
            yield batch.slice(low, high - low)


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)


def _seen(counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """How often each hash occurs in all texts, by its counter."""
    return LEVELS[counts[_slots(hashes)]]


def _line_sets(raw: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per line with words: text, line number, first place and number of its distinct words; and these words by rarity:
    hashes and counts."""
    hashes, owner, line = _word_hashes(raw)
    unique, place = np.unique(hashes, return_inverse=True)
    seen = _seen(counts, unique)
    by_rank = np.lexsort((unique, seen))
    rank = np.empty(len(by_rank), np.int64)
    rank[by_rank] = np.arange(len(by_rank))
    group = np.cumsum(np.append(0, (np.diff(owner) != 0) | (np.diff(line) != 0))) if len(owner) else owner
    first = np.nonzero(np.append(True, np.diff(group) != 0))[0] if len(group) else group
    packed = np.sort((group << 32) | rank[place])
    packed = packed[np.append(True, np.diff(packed) != 0)] if len(packed) else packed
    begins = np.nonzero(np.append(True, np.diff(packed >> 32) != 0))[0] if len(packed) else packed
    words = by_rank[packed & 0xFFFFFFFF]
    return owner[first], line[first], begins, np.diff(np.append(begins, len(packed))), unique[words], seen[words]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def word_counts(docs: DataFrame) -> np.ndarray:
    """Counters of all words of all texts."""
    return counted(docs, lambda raw: _word_hashes(raw)[0])


def counted(docs: DataFrame, hashes_of: Callable[[list[bytes]], np.ndarray]) -> np.ndarray:
    """Counters of all hashes of all texts, 2 ** SLOT_BITS of them: that, and no more, comes to the driver.

    A counter is one byte, its count's place among LEVELS: what occurs once is told from what occurs twice, and the order of
    rarity is that of the levels.
    """
    width = (1 << SLOT_BITS) // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in _pieces(batches, 0):
            np.add.at(total, _slots(hashes_of([utf8(text) for text in batch.column(0).to_pylist()])), 1)
        for part in range(SLICES):
            own = total[part * width : (part + 1) * width]
            used = np.nonzero(own)[0]
            if len(used):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), *(pa.array([_planes(v).tobytes()], pa.binary()) for v in (np.diff(used, prepend=0), np.minimum(own[used], LEVELS[-1])))],
                    ["part", "slots", "counts"],
                )

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for slots, counts in zip(group.column("slots"), group.column("counts")):
            steps, more = (_whole(np.frombuffer(v.as_buffer(), np.uint8)) for v in (slots, counts))
            total[np.cumsum(steps)] += more
        used = (np.searchsorted(LEVELS, total, "right") - 1).astype(np.uint8).tobytes()
        return pa.table({"part": pa.array([group.column("part")[0].as_py()], pa.int32()), "counts": pa.array([used], pa.binary())})

    sums = docs.select("text").mapInArrow(count, "part int, slots binary, counts binary").groupBy("part").applyInArrow(add, "part int, counts binary")
    total = np.zeros(1 << SLOT_BITS, np.uint8)
    for row in sums.collect():
        total[row.part * width : (row.part + 1) * width] = np.frombuffer(row.counts, np.uint8)
    return total


def _prefix(size: np.ndarray) -> np.ndarray:
    """So many of the rarest words: a set that shares none of them cannot reach the similarity. Up to three words, only equal sets can."""
    return np.where(size > 3, size - (4 * size + 4) // 5 + 1, 0)


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers 0, 0, 1, ... and 0, 1, 0, ...: each index so often, and the how-manieth."""
    at = np.repeat(np.arange(len(counts)), counts)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)


def _size_class(size: np.ndarray) -> np.ndarray:
    """Similar sets are in one class or in neighbouring ones."""
    return np.floor(np.log(np.maximum(size, 1)) / np.log(1.25) + 1e-9).astype(np.int64)


class _Listing(NamedTuple):
    """Sets under their prefix words: set, key of the group, place of the word, the word before it (or 0), and whether a visitor."""

    row: np.ndarray
    keys: np.ndarray
    places: np.ndarray
    lasts: np.ndarray
    visitor: np.ndarray


def _hot_count(counts: np.ndarray, buckets: int) -> int:
    whole = int(np.bincount(counts, minlength=len(LEVELS)) @ LEVELS.astype(np.int64))
    return max(2, int(HOT_PART * whole / buckets))


def _listed(tokens: np.ndarray, seen: np.ndarray, begins: np.ndarray, sizes: np.ndarray, hot_count: int, more: np.ndarray | int = 0) -> _Listing:
    """List sets, given as runs of word hashes in order of rarity, under their prefix words and so many more.

    Under a word with more than hot_count occurrences only sets of similar size meet: in its own size class a set
    meets all, and in the class above it is a visitor, which meets only the owners.
    """
    row, place = _spread(_prefix(sizes) + more)
    at = begins[row] + place
    # A word seen once in all texts has no partner.
    use = seen[at] > 1
    row, place, at = row[use], place[use], at[use]
    key, last = tokens[at], np.where(place > 0, tokens[np.maximum(at - 1, 0)], np.uint64(0))
    hot = seen[at] > hot_count
    level = _size_class(sizes[row]).astype(np.uint64)
    own = np.where(hot, key ^ _mixed(level + np.uint64(1)), key)
    above = (key ^ _mixed(level + np.uint64(2)))[hot]
    visitor = np.append(np.zeros(len(row), np.int64), np.ones(len(above), np.int64))
    return _Listing(np.append(row, row[hot]), np.append(own, above), np.append(place, place[hot]), np.append(last, last[hot]), visitor)


def _bitmaps(tokens: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Four words of 64 bits per set in which each of its tokens flips one bit, and which `_apart` compares.

    The last two words are folded into the first two, and kept for sets of more than WIDE tokens only; of sets of at most NARROW
    tokens the second word is folded into its lower half.
    """
    bit, word = np.uint64(1) << ((tokens >> np.uint64(56)) & np.uint64(63)), tokens >> np.uint64(62)
    one, two, three, four = (np.bitwise_xor.reduceat(np.where(word == np.uint64(k), bit, np.uint64(0)), begins) for k in range(4))
    wide, two_four = sizes > WIDE, two ^ four
    return np.stack([one ^ three, np.where(sizes > NARROW, two_four, _folded(two_four)), np.where(wide, three, np.uint64(0)), np.where(wide, four, np.uint64(0))], axis=1)


def _folded(word: np.ndarray) -> np.ndarray:
    return (word ^ (word >> np.uint64(32))) & np.uint64(0xFFFFFFFF)


def _apart(one: np.ndarray, two: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Bits in which bitmaps differ: two sets differ in at least as many tokens. size: of the smaller set."""
    bits = one ^ two
    if bits.shape[1] == 4:
        narrow, wide = size <= NARROW, size > WIDE
        bits[narrow, 1] = _folded(bits[narrow, 1])
        bits[wide, :2] ^= bits[wide, 2:]
        bits[~wide, 2:] = 0
    return np.bitwise_count(bits).sum(axis=1, dtype=np.int64)


def _flat(bitmaps: np.ndarray) -> np.ndarray:
    """Word by word, the second one by halves: what small sets lack are runs of zeros."""
    one, two, *rest = (np.ascontiguousarray(word) for word in bitmaps.T)
    return np.concatenate([one, np.ascontiguousarray(two.view("<u4").reshape(-1, 2).T).ravel().view("<u8"), *rest])


def _unflat(words: np.ndarray) -> np.ndarray:
    one, two, *rest = words.reshape(4, -1)
    return np.stack([one, np.ascontiguousarray(two.view("<u4").reshape(2, -1).T).ravel().view("<u8"), *rest], axis=1)


def _names(tokens: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return _mixed(np.add.reduceat(tokens, begins) + sizes.astype(np.uint64))


def _send(docs: DataFrame, shared: Broadcast, hot_count: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = TaskContext.get().partitionId()
        for number, batch in enumerate(_pieces(batches, 2)):
            ids = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1)], axis=1)
            owner, line, begins, sizes, token, seen = _line_sets([utf8(text) for text in batch.column(2).to_pylist()], shared.value)
            if not len(owner):
                continue
            names, bitmaps = _names(token, begins, sizes), _bitmaps(token, begins, sizes)
            order = np.lexsort((line, ids[owner, 1], ids[owner, 0], names))
            first = np.append(True, names[order][1:] != names[order][:-1])
            head = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
            repeats = ~first & ((ids[owner[order]] != ids[owner[head]]).any(axis=1) | (line[order] != line[head]))
            again, rows = order[repeats], order[first]
            repeated = np.zeros(len(names), np.int64)
            repeated[head[repeats]] = 1
            if len(again):
                yield _lines((shift + number) % buckets, DROPPED, ids, owner[again], line[again], names[again], sizes[again])
            for bucket, own in _by_bucket(names[rows], buckets):
                own = rows[own]
                yield _lines(bucket, SETS, ids, owner[own], line[own], names[own], sizes[own] * 2 + repeated[own])
            rows = rows[np.argsort(sizes[rows], kind="stable")]
            found = _listed(token, seen, begins[rows], sizes[rows], hot_count)
            for bucket, own in _by_bucket(found.keys, buckets):
                r = rows[found.row[own]]
                places = found.places[own] * 2 + found.visitor[own]
                yield _row(bucket, LISTED, sets=_cut(names[r], NAME), sizes=_planes(sizes[r]), keys=_cut(found.keys[own] >> np.uint64(40), KEY), bitmaps=_flat(bitmaps[r]), places=_planes(places))

    return docs.select("doc", "mark", "text").mapInArrow(run, SENT)


def _by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    bucket = (_mixed(keys) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    numbers, at = np.unique(bucket[order], return_index=True)
    for number, low, high in zip(numbers.tolist(), at, np.append(at[1:], len(order))):
        yield number, order[low:high]


def _row(bucket: int, kind: int, **columns: np.ndarray) -> pa.RecordBatch:
    names = [field.split()[0] for field in SENT.split(", ")]
    values = [columns[name].tobytes() if name in columns else None for name in names[2:]]
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([kind], pa.int32()), *(pa.array([v], pa.binary()) for v in values)], names)


def _lines(bucket: int, kind: int, ids: np.ndarray, owners: np.ndarray, lines: np.ndarray, sets: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    used, owner = np.unique(owners, return_inverse=True)
    return _row(bucket, kind, docs=ids[used].astype("<i8"), owners=_planes(owner), lines=_planes(lines), sets=sets, sizes=_planes(sizes))


def _planes(values: np.ndarray) -> np.ndarray:
    """Numbers of 32 bits, all lowest bytes first: of small numbers the rest are runs of zeros, which the shuffle compresses."""
    return np.ascontiguousarray(values.astype("<i4").view(np.uint8).reshape(-1, 4).T)


def _whole(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()


def _cut(values: np.ndarray, n: int) -> np.ndarray:
    """The lowest n bytes of each."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]


def _uncut(cut: np.ndarray, n: int) -> np.ndarray:
    values = np.zeros((len(cut) // n, 8), np.uint8)
    values[:, :n] = cut.reshape(-1, n)
    return values.view("<u8").ravel()


class _Group:
    """The rows of one kind in a bucket, as arrays."""

    def __init__(self, group: pa.Table, kind: int) -> None:
        self.group, self.rows = group, np.nonzero(group.column("kind").to_numpy() == kind)[0].tolist()

    def parts(self, name: str, form: str) -> list[np.ndarray]:
        column = self.group.column(name)
        return [np.frombuffer(column[row].as_buffer(), form) for row in self.rows]

    def column(self, name: str, form: str) -> np.ndarray:
        return np.concatenate([np.zeros(0, form), *self.parts(name, form)])

    def numbers(self, name: str) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int64), *(_whole(part) for part in self.parts(name, np.uint8))])

    def where(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least significant first: line, mark, doc."""
        docs = self.parts("docs", "<i8")
        base = np.cumsum([0, *(len(d) // 2 for d in docs)])
        owner = np.concatenate([np.zeros(0, np.int64), *(_whole(own) + at for own, at in zip(self.parts("owners", np.uint8), base))])
        ids = np.concatenate([np.zeros(0, np.int64), *docs]).reshape(-1, 2)
        return self.numbers("lines"), ids[owner, 1], ids[owner, 0]


def _candidates(tokens: np.ndarray, lasts: np.ndarray | None, sizes: np.ndarray, places: np.ndarray, visitor: np.ndarray, bitmaps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows under a common word that pass the length, positional and bitmap filters.

    A pair with the same word before, if that is known, is formed under that word.
    """
    order = np.lexsort((sizes, tokens))
    size, place, bitmap, guest = sizes[order], places[order], bitmaps[order], visitor[order]
    last = None if lasts is None else lasts[order]
    group = np.cumsum(np.append(0, np.diff(tokens[order]) != 0)) if len(order) else np.zeros(0, np.int64)
    key = (group << 32) | size
    to_last = np.searchsorted(key, (group << 32) | np.minimum(5 * size // 4, 2**31), "right")
    counts = to_last - np.arange(len(order)) - 1
    ends = np.cumsum(counts)
    at = 0
    while at < len(order):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        one, step = _spread(counts[at:to])
        one = one + at
        two = one + 1 + step
        most = np.minimum(place[one], place[two]) + np.minimum(size[one] - place[one], size[two] - place[two])
        both = size[one] + size[two]
        least = (4 * both + 8) // 9
        keep = (most >= least) & (guest[one] + guest[two] < 2)
        if last is not None:
            keep &= (last[one] != last[two]) | (place[one] == 0) | (place[two] == 0)
        one, two, spare = one[keep], two[keep], (both - 2 * least)[keep]
        near = _apart(bitmap[one], bitmap[two], size[one]) <= spare
        yield order[one[near]], order[two[near]]
        at = to


def _found(kind: int, bucket: int, doc: np.ndarray, mark: np.ndarray, line: np.ndarray, size: np.ndarray, name: np.ndarray) -> pa.RecordBatch:
    kinds, buckets = (pa.array(np.full(len(doc), v, np.int32)) for v in (kind, bucket))
    values = [pa.array(doc, pa.int64()), pa.array(mark, pa.int64()), pa.array(line, pa.int32()), pa.array(size, pa.int32()), pa.array(name.view(np.int64)), pa.nulls(len(doc), pa.int64())]
    return pa.RecordBatch.from_arrays([kinds, buckets, *values], [field.split()[0] for field in FOUND.split(", ")])


def _resolve(group: pa.Table) -> pa.Table:
    """Lines that repeat a word set (DROPPED), first lines of such sets (REPEATED) and of all others (SETS), and names that connect sets
    which may be similar (LISTED)."""
    bucket = group.column("bucket")[0].as_py()
    gone = _Group(group, DROPPED)
    line, mark, doc = gone.where()
    out = [_found(DROPPED, bucket, doc, mark, line, gone.numbers("sizes"), gone.column("sets", "<u8"))]
    own = _Group(group, SETS)
    line, mark, doc = own.where()
    sets, sizes = own.column("sets", "<u8"), own.numbers("sizes")
    order = np.lexsort((line, mark, doc, sets))
    if len(order):
        first = np.append(True, sets[order][1:] != sets[order][:-1])
        head = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
        again = ~first & ((doc[order] != doc[head]) | (mark[order] != mark[head]) | (line[order] != line[head]))
        repeated = np.maximum.reduceat(again | (sizes[order] & 1).astype(bool), np.nonzero(first)[0])
        heads = order[first]
        for kind, rows in ((DROPPED, order[again]), (REPEATED, heads[repeated]), (SETS, heads[~repeated])):
            out.append(_found(kind, bucket, doc[rows], mark[rows], line[rows], sizes[rows] >> 1, sets[rows]))
    a, b = _may_be_similar(_Group(group, LISTED))
    none = pa.nulls(len(a), pa.int64())
    kinds, buckets = (pa.array(np.full(len(a), v, np.int32)) for v in (LISTED, bucket))
    numbers = pa.nulls(len(a), pa.int32())
    out.append(pa.RecordBatch.from_arrays([kinds, buckets, none, none, numbers, numbers, pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], out[0].schema.names))
    return pa.Table.from_batches(out)


def _may_be_similar(some: _Group) -> tuple[np.ndarray, np.ndarray]:
    """Edges between the names of listed sets that connect all pairs which pass the filters under a word."""
    cut = {name: _uncut(some.column(name, np.uint8), n) for name, n in (("sets", NAME), ("keys", KEY))}
    both, places, sizes = cut["keys"] << np.uint64(8 * NAME) | cut["sets"], some.numbers("places"), some.numbers("sizes")
    bitmaps = np.concatenate([np.zeros((0, 4), np.uint64), *(_unflat(part) for part in some.parts("bitmaps", "<u8"))])
    # Of equal sets under a word one stands for all; another word or set with the same bytes has another place or bitmap.
    order = np.argsort(both)
    both, place, bitmap = both[order], places[order], bitmaps[order]
    fresh = np.append(True, (np.diff(both) != 0) | (np.diff(place) != 0) | (bitmap[1:] != bitmap[:-1]).any(axis=1)) if len(order) else np.zeros(0, bool)
    order = order[fresh]
    keys = cut["keys"][order]
    # A word of one set only makes no pair.
    alike = np.diff(keys) == 0
    order = order[np.append(False, alike) | np.append(alike, False)] if len(order) else order
    keys, sets, places, sizes, bitmaps = (column[order] for column in (cut["keys"], cut["sets"], places, sizes, bitmaps))
    names, row = np.unique(sets, return_inverse=True)
    label = np.arange(len(names))
    for a, b in _candidates(keys, None, sizes, places >> 1, places & 1, bitmaps):
        label = merged(label, row[a], row[b])
    ends = np.nonzero(label != np.arange(len(label)))[0]
    return names[ends], names[label[ends]]


def _routes(found: DataFrame, buckets: int) -> DataFrame:
    """(doc, mark, line, owner, bucket): the first line of each set that may be similar to another one, and where it is verified: an owner,
    which is a large component or null, and a bucket."""
    edges = found.where(F.col("kind") == LISTED).select("bucket", F.col("name").alias("a"), F.col("joined").alias("b"))
    nodes = connected_components(edges.select("a", "b")).withColumnRenamed("node", "name")
    heads = found.where(F.col("kind").isin(SETS, REPEATED)).withColumn("name", F.col("name").bitwiseAND(F.lit((1 << 8 * NAME) - 1)))
    heads = _near(heads.select("name", "doc", "mark", "line", "size"), nodes, "name")
    known = stored(nodes.join(heads, "name"), "line-components")
    large = known.groupBy("component").agg(F.count("*").alias("sets"), F.sum("size").alias("words")).where((F.col("sets") > MEMBERS) | (F.col("words") > LARGE)).select("component")
    none, block = F.lit(None).cast("long").alias("owner"), F.pmod(F.xxhash64("component"), F.lit(buckets)).cast("int").alias("bucket")
    small = known.join(large, "component", "left_anti").select("doc", "mark", "line", none, block)
    spread = known.join(large, "component", "left_semi")
    ends = _near(edges.select("bucket", F.explode(F.array("a", "b")).alias("name")), spread, "name").distinct()
    spread = spread.join(ends, "name")
    return small.unionByName(spread.select("doc", "mark", "line", F.col("component").alias("owner"), "bucket"))


def _near(frame: DataFrame, wanted: DataFrame, *key: str) -> DataFrame:
    """The rows of a frame whose key may be in wanted; others stay where they are.

    2 ** WANTED_BITS bits, at most 2 ** (WANTED_BITS - 6) rows of them, are broadcast: some 20 MB, whatever the input.
    """
    slot = F.pmod(F.xxhash64(*key), F.lit(1 << WANTED_BITS))
    word, bit = F.shiftright(slot, 6), F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    bits = wanted.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    return frame.withColumn("word", word).join(F.broadcast(bits), "word").where(F.col("bits").bitwiseAND(bit) != 0).select(frame.columns)


def _wanted_lines(docs: DataFrame, routes: DataFrame) -> DataFrame:
    """(owner, bucket, doc, mark, line, text): the routed lines' texts."""
    key = ["doc", "mark", "line"]
    lines = _near(docs.select("doc", "mark", F.posexplode(F.split("text", "\n")).alias("line", "text")), routes, *key)
    return lines.select(*key, F.col("text").cast("binary").alias("text")).join(routes, key)


def _verified(docs: DataFrame, routes: DataFrame, shared: Broadcast, hot_count: int, buckets: int) -> DataFrame:
    """Per set, by its first line: verified links formed in a block or a bucket, and whether an earlier line is similar."""

    def run(group: pa.Table) -> pa.Table:
        bucket, whole = group.column("bucket")[0].as_py(), group.column("owner")[0].as_py() is None
        where = np.stack([group.column(name).to_numpy() for name in ("doc", "mark")], axis=1)
        line = group.column("line").to_numpy()
        # Equal rows of the table send the same line again.
        order = np.lexsort((line, where[:, 1], where[:, 0]))
        order = order[np.append(True, (np.diff(where[order], axis=0) != 0).any(axis=1) | (np.diff(line[order]) != 0))]
        where, line = where[order], line[order]
        texts = group.column("text").take(pa.array(order)).to_pylist()
        _, _, begins, sizes, tokens, seen = _line_sets(texts, shared.value)
        bitmaps = _bitmaps(tokens, begins, sizes)
        # A whole component meets here: under all its words, none of them hot.
        listed = _listed(tokens, np.minimum(seen, len(tokens) + 1) if whole else seen, begins, sizes, len(tokens) + 1 if whole else hot_count)
        here = np.arange(len(listed.row)) if whole else np.nonzero((_mixed(listed.keys) % np.uint64(buckets)).astype(np.int64) == bucket)[0]
        row, place = listed.row[here], listed.places[here]
        _, word = np.unique(tokens, return_inverse=True)
        at, step = _spread(sizes)
        member = np.sort((at << 32) | word)
        links, gone, label = np.zeros(len(line), np.int64), np.zeros(len(line), bool), np.arange(len(line))
        for a, b in _candidates(listed.keys[here], listed.lasts[here], sizes[row], place, listed.visitor[here], bitmaps[row]):
            low, ends = 0, np.cumsum(sizes[row[a]])
            while low < len(a):
                high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + VERIFIED, "right")))
                one, two = row[a[low:high]], row[b[low:high]]
                at, step = _spread(sizes[one])
                wanted_key = (two[at] << 32) | word[begins[one[at]] + step]
                hit = member[np.minimum(np.searchsorted(member, wanted_key), len(member) - 1)] == wanted_key
                shared_words = np.bincount(at, hit, len(one)).astype(np.int64)
                # Rarest first: the pair belongs to the first word that both have.
                rows_hit, first = np.unique(at[hit], return_index=True)
                begin = np.full(len(one), -1)
                begin[rows_hit] = step[hit][first]
                keep = (begin == place[a[low:high]]) & (10 * shared_words >= 8 * (sizes[one] + sizes[two] - shared_words))
                one, two = one[keep], two[keep]
                np.add.at(links, one, 1)
                np.add.at(links, two, 1)
                label = merged(label, one, two)
                # Rows are in the order of lines.
                gone[np.maximum(one, two)] = True
                low = high
        use = np.nonzero(links)[0]
        names = _names(tokens, begins, sizes).view(np.int64)
        return pa.table({
            "doc": where[use, 0], "mark": where[use, 1], "line": line[use].astype(np.int32), "name": names[use],
            "links": links[use], "gone": gone[use], "joined": names[label[use]],
        })

    return _wanted_lines(docs, routes).groupBy("owner", "bucket").applyInArrow(run, LINKS)


def similar_lines(docs: DataFrame, buckets: int) -> DataFrame:
    """(doc, mark, line, name, links, gone, first): lines that repeat a word set, or whose set is similar to another one.

    links: the different sets that this one is similar to; first: the first line (doc, mark, line) of all sets that links lead to. gone: an
    earlier line has the same set or a similar one.
    """
    counts = word_counts(docs)
    hot_count = _hot_count(counts, buckets)
    # A table of fixed size, sent once: every executor and each of its Python workers hold it as often as it is broadcast.
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    del counts
    found = stored(_send(docs, shared, hot_count, buckets).groupBy("bucket").applyInArrow(_resolve, FOUND), "line-candidates")
    routes = stored(_routes(found, buckets), "line-routes")
    linked = stored(_verified(docs, routes, shared, hot_count, buckets), "line-links")
    shared.destroy()
    discard(routes)
    nodes = connected_components(linked.select(F.col("name").alias("a"), F.col("joined").alias("b"))).withColumnRenamed("node", "name")
    place = F.struct("doc", "mark", "line")
    per_set = linked.groupBy("name").agg(F.sum("links").alias("links"), F.max("gone").alias("gone"), F.min(place).alias("at")).join(nodes, "name", "left")
    # Sets with repeats have a class of their own if they have no links.
    alone = found.where(F.col("kind") == REPEATED).select("name", place.alias("at")).join(per_set.select("name"), "name", "left_anti")
    none = alone.select("name", F.lit(0).cast("long").alias("links"), F.lit(False).alias("gone"), "at", F.col("name").alias("component"))
    sets = stored(per_set.unionByName(none), "line-sets")
    # The first line of a class is the first one of a set.
    firsts = sets.groupBy("component").agg(F.min("at").alias("first"))
    sets = stored(sets.join(firsts, "component").drop("component"), "line-classes")
    again = found.where(F.col("kind") == DROPPED).select("doc", "mark", "line", "name").join(sets.drop("at"), "name").withColumn("gone", F.lit(True))
    return stored(sets.select("at.*", "name", "links", "gone", "first").unionByName(again), "similar-lines")


def dedup_lines(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Per document: doc_id, n_lines, removed (line numbers from 0, ascending), n_links, classes and class_id.

    n_links sums, over the different word sets of this document, the different sets that each is similar to. classes: of each line
    that is like another one, its number and the document and line that come first in its class, by line. class_id is the smallest
    document with a line like one of these.
    """
    known = _identified(docs)
    own = known.select("doc_id", "doc", "mark", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"))
    buckets = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = similar_lines(known, buckets)
    each = F.struct("line", "gone", F.col("first.doc").alias("first_doc"), F.col("first.line").alias("first_line"), "name", "links")
    found = lines.groupBy("doc", "mark").agg(F.array_sort(F.collect_set(each)).alias("at"))
    sets = F.array_distinct(F.transform("at", lambda r: F.struct(r["name"], r["links"].alias("links"))))
    found = found.withColumn("n_links", F.aggregate(sets, F.lit(0).cast("long"), lambda n, r: n + r["links"]))
    numbers = lambda rows: F.transform(rows, lambda r: r["line"])
    none, no_id = F.array().cast("array<int>"), -(2**63)
    classes = F.transform("at", lambda r: F.struct(r["line"].alias("line"), F.nullif(r["first_doc"], F.lit(no_id)).alias("first_doc"), r["first_line"].alias("first_line")))
    return own.join(found, ["doc", "mark"], "left").select(
        "doc_id", "n_lines", F.coalesce(numbers(F.filter("at", lambda r: r["gone"])), none).alias("removed"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce(classes, F.array()).alias("classes"),
        F.nullif(F.array_min(F.transform("at", lambda r: r["first_doc"])), F.lit(no_id)).alias("class_id"),
    )


def kept_lines(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """The rows of docs with the lines that stay as their text; null texts stay null."""
    doc, mark, removed = (fresh_name(docs, f"line_{n}") for n in ("doc", "mark", "removed"))
    identity = _identity()
    known = docs.select("*", identity["doc"].alias(doc), identity["mark"].alias(mark))
    found = _removed(_identified(docs), buckets).select(F.col("doc").alias(doc), F.col("mark").alias(mark), F.col("removed").alias(removed))
    gone = F.coalesce(removed, F.array().cast("array<int>"))
    lines = F.split(F.col("text"), "\n")
    text = F.array_join(_kept(lines, gone), "\n")
    return known.join(found, [doc, mark], "left").select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns])


def _identity() -> dict[str, Column]:
    return {"doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), "mark": F.xxhash64("text")}


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[c.alias(n) for n, c in _identity().items()])


def _removed(known: DataFrame, buckets: int | None) -> DataFrame:
    buckets = buckets or int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return similar_lines(known, buckets).groupBy("doc", "mark").agg(
        F.array_sort(F.collect_set(F.when(F.col("gone"), F.col("line")))).alias("removed")
    )


def _kept(lines: Column, removed: Column) -> Column:
    places = F.transform(lines, lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    left = F.transform(F.filter(places, lambda p: ~F.array_contains(removed, p["i"])), lambda p: p["line"])
    return F.when(F.size(removed) == 0, lines).otherwise(left)
