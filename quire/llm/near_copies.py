"""Near copies of documents: an exact join of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

The join is that of line_dedup, with documents for lines and shingles for words: shingles by rarity, sets listed under their
prefix shingles, length and positional filters. Beside the prefix a set is listed under one shingle more for every MORE that it has:
sets that are similar then share as many and one more. A set that meets others under fewer has no similar one, however common shingles
are, and goes before pairs are formed. The pairs that are left leave a task as a spanning forest of names. Each set in such a forest is then sent once more, whole, to the block of its component, where pairs are verified; a component of more than
LARGE shingles is verified under its prefix shingles, bucket by bucket. Verified pairs leave a task as a spanning forest, too.
Under a shingle all sets are first compared with one of them: of a group of near copies no other pairs are formed.
Shingles are known by 64-bit hashes.

On request the links of op4 join the groups as well: fingerprints of three-word shingles that differ in at most two bits.

Words are what ASCII white space separates, A-Z lower-cased. A text of fewer than five words is one shingle; null texts and texts
without words are equal. A row is known by its doc_id and a hash of its text; the row that stays of a group is the one with the
smallest doc_id, then hash, rows without a doc_id last. Of rows with equal doc_id and text one stays. Texts may be of any length;
the shingles of one must fit a task's memory. Other columns are passed on, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import connected_components, discard, fresh_name, merged, row_key, stored, utf8
from quire.llm.line_dedup import (
    SLICE, _by_bucket, _candidates, _cut, _hot_count, _Listing, _listed, _mixed, _names, _near, _pieces, _planes, _seen, _spread, _uncut, _whole as _unplaned, counted,
)
from quire.llm.simhash import fingerprint, links as fingerprint_links
from quire.llm.suffixes import BASES, Hashes

SHINGLE = 5
# Shingles compared at once, sets under a shingle from which on they are compared with one of them first, and shingles of a component
# that is verified in one task.
VERIFIED, STAR, LARGE = 1 << 20, 16, 1 << 24
# Shingles to one more that a set is listed under, and bytes of a listed shingle: others with the same bytes only look like it.
MORE, KEY = 8, 5
SPACE = np.array([b in b" \t\n\r\x0b\x0c" for b in range(256)])
FACTORS = _mixed(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)
ROW = ["no_id", "doc", "mark"]
SENT = "bucket int, keys binary, sets binary, sizes binary, places binary"
MET = "bucket int, key long, name long, size int, place int"
WHOLE = "owner long, bucket int, sets binary, tokens binary, sizes binary"


def _shingles(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every shingle, in order of texts; the texts go through in slices of bounded size."""
    parts, held, size = [], [], 0
    for number, text in enumerate(raw):
        held.append(number)
        size += len(text) + 1
        if size >= SLICE or number == len(raw) - 1:
            parts.append(_slice(raw, held))
            held, size = [], 0
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(column) for column in zip(*parts))


def _slice(raw: list[bytes], held: list[int]) -> tuple[np.ndarray, np.ndarray]:
    bytes_of = np.frombuffer(b"\n".join([*(raw[n].lower() for n in held), b""]), np.uint8)
    inside = ~SPACE[bytes_of]
    first = np.nonzero(inside & np.append(True, ~inside[:-1]))[0]
    end = np.nonzero(inside & np.append(~inside[1:], True))[0] + 1
    words = _mixed(Hashes(bytes_of, BASES[0]).of(first, end - first) + (end - first).astype(np.uint64))
    starts = np.cumsum([0, *(len(raw[n]) + 1 for n in held[:-1])])
    own = np.searchsorted(starts, first, "right") - 1
    n_words = np.bincount(own, minlength=len(held))
    # A short text is one shingle of all its words, a text without words one of none.
    n_shingles = np.maximum(n_words - SHINGLE + 1, 1)
    text, step = _spread(n_shingles)
    at, left = (np.cumsum(n_words) - n_words)[text] + step, np.minimum(n_words, SHINGLE)[text]
    hashes, padded = left.astype(np.uint64), np.append(words, np.zeros(SHINGLE, np.uint64))
    for k in range(SHINGLE):
        hashes = hashes + np.where(k < left, padded[at + k], np.uint64(0)) * FACTORS[k]
    return _mixed(hashes), np.array(held)[text]


def _sets(texts: list[str | None], counts: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """Per text: first place and number of its distinct shingles; and these by rarity: hashes and counts."""
    hashes, owner = _shingles([utf8(text) for text in texts])
    seen = np.zeros(len(hashes), np.int32) if counts is None else _seen(counts, hashes)
    order = np.lexsort((hashes, seen, owner))
    hashes, owner, seen = hashes[order], owner[order], seen[order]
    fresh = np.append(True, (np.diff(hashes) != 0) | (np.diff(owner) != 0)) if len(hashes) else np.zeros(0, bool)
    sizes = np.bincount(owner[fresh], minlength=len(texts))
    return np.cumsum(sizes) - sizes, sizes, hashes[fresh], seen[fresh]


def _named(docs: DataFrame, fingerprints: bool) -> DataFrame:
    """(no_id, doc, mark, name, size, fp): each row, the name and size of its set, and op4's fingerprint of its text if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, 3):
            begins, sizes, tokens, _ = _sets(batch.column(3).to_pylist(), None)
            names = _names(tokens, begins, sizes).view(np.int64)
            marks = [fingerprint(text) if fingerprints else 0 for text in batch.column(3).to_pylist()]
            columns = [*batch.columns[:3], pa.array(names), pa.array(sizes.astype(np.int64)), pa.array(np.array(marks, np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*ROW, "name", "size", "fp"])

    return docs.mapInArrow(run, "no_id boolean, doc long, mark long, name long, size long, fp long")


def _packed(bucket: int, *columns: np.ndarray, names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in columns)], [n.split()[0] for n in names.split(", ")])


def _column(group: pa.Table, name: str, form: str) -> np.ndarray:
    return np.concatenate([np.frombuffer(value.as_buffer(), form) for value in group.column(name)])


def _may_reach(size: np.ndarray, other: np.ndarray, place: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The length and positional filters for sets with a shingle in common at these places."""
    return np.minimum(place, at) + np.minimum(size - place, other - at) >= (4 * (size + other) + 8) // 9


def _joined(listed: _Listing, sizes: np.ndarray, near: Callable[[np.ndarray, np.ndarray], np.ndarray], label: np.ndarray) -> np.ndarray:
    """Labels of sets once all pairs under a common key that may be similar, and that `near` accepts, are merged."""
    order = np.lexsort((listed.row, listed.keys))
    first = np.append(True, np.diff(listed.keys[order]) != 0) if len(order) else np.zeros(0, bool)
    begins = np.nonzero(first)[0]
    group = np.cumsum(first) - 1
    large = np.diff(np.append(begins, len(order)))[group] >= STAR
    heads, others = order[begins[group]][large], order[large]
    for low in range(0, len(heads), VERIFIED):
        head, other = heads[low : low + VERIFIED], others[low : low + VERIFIED]
        left, right = listed.row[head], listed.row[other]
        apart = (label[left] != label[right]) & _may_reach(sizes[left], sizes[right], listed.places[head], listed.places[other])
        left, right = left[apart], right[apart]
        use = near(left, right)
        label = merged(label, left[use], right[use])
    if len(order):
        own = label[listed.row[order]]
        open_ = np.minimum.reduceat(own, begins) != np.maximum.reduceat(own, begins)
        order = order[open_[group]]
    row, none = listed.row[order], np.zeros((len(order), 1), np.uint64)
    for a, b in _candidates(listed.keys[order], listed.lasts[order], sizes[row], listed.places[order], listed.visitor[order], none):
        left, right = row[a], row[b]
        while True:
            apart = label[left] != label[right]
            left, right = left[apart], right[apart]
            if not len(left):
                break
            n = max(1, int(np.searchsorted(np.cumsum(sizes[left]), VERIFIED, "right")))
            one, two, left, right = left[:n], right[:n], left[n:], right[n:]
            use = near(one, two)
            label = merged(label, one[use], two[use])
    return label


def _forest(bucket: int, names: np.ndarray, label: np.ndarray) -> pa.Table:
    ends = np.nonzero(label != np.arange(len(label)))[0]
    columns = {"bucket": pa.array(np.full(len(ends), bucket, np.int32)), "a": pa.array(names[ends].view(np.int64)), "b": pa.array(names[label[ends]].view(np.int64))}
    return pa.table(columns)


def _meetings(docs: DataFrame, shared: Broadcast, hot_count: int, buckets: int) -> DataFrame:
    """(bucket, key, name, size, place): listed sets that meet one of similar size under a shingle."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, 0):
            begins, sizes, tokens, seen = _sets(batch.column(0).to_pylist(), shared.value)
            names = _names(tokens, begins, sizes)
            rows = np.unique(names, return_index=True)[1]
            found = _listed(tokens, seen, begins[rows], sizes[rows], hot_count, sizes[rows] // MORE)
            for bucket, own in _by_bucket(found.keys, buckets):
                r = rows[found.row[own]]
                places = found.places[own] * 2 + found.visitor[own]
                yield _packed(bucket, _cut(found.keys[own] >> np.uint64(64 - 8 * KEY), KEY), names[r], _planes(sizes[r]), _planes(places), names=SENT)

    def meet(group: pa.Table) -> pa.Table:
        keys, sets = _uncut(_column(group, "keys", np.uint8), KEY), _column(group, "sets", "<u8")
        sizes, places = (np.concatenate([_unplaned(np.frombuffer(v.as_buffer(), np.uint8)) for v in group.column(name)]) for name in ("sizes", "places"))
        order = np.lexsort((places, sets, sizes, keys))
        keys, sets, sizes, places = (column[order] for column in (keys, sets, sizes, places))
        # Another shingle of a set with the same bytes has another place.
        fresh = np.append(True, (np.diff(keys) != 0) | (np.diff(sets) != 0) | (np.diff(places) != 0))
        keys, sets, sizes, places = (column[fresh] for column in (keys, sets, sizes, places))
        # Under a shingle sets are in order of size: if any is similar in size, a neighbour is.
        close = (np.diff(keys) == 0) & (4 * sizes[1:].astype(np.int64) <= 5 * sizes[:-1].astype(np.int64))
        use = np.append(False, close) | np.append(close, False)
        bucket = np.full(use.sum(), group.column("bucket")[0].as_py(), np.int32)
        columns = bucket, keys[use].view(np.int64), sets[use].view(np.int64), sizes[use], places[use]
        return pa.table([pa.array(c) for c in columns], [n.split()[0] for n in MET.split(", ")])

    return docs.select("text").mapInArrow(send, SENT).groupBy("bucket").applyInArrow(meet, MET)


def _candidate_links(met: DataFrame) -> DataFrame:
    """(bucket, a, b): names that connect what may be similar under a shingle of the bucket.

    A set is taken if it meets others under as many shingles as the smallest set similar to it has in common with it at least.
    """
    often = F.count("*").over(Window.partitionBy("name")) > F.expr(f"(4 * size + 4) div 5 div {MORE}")
    # Where two sets have met under the shingle before as well, they are a pair there.
    before = F.lag(F.struct("bucket", "key", "place")).over(Window.partitionBy("name").orderBy("place"))
    next_to = F.shiftright("place", 1) == F.shiftright("before.place", 1) + 1
    last = F.when(next_to, F.xxhash64("before.bucket", "before.key")).otherwise(F.xxhash64("name", "place")).alias("last")

    def resolve(group: pa.Table) -> pa.Table:
        sets, key, size, place, last = (group.column(name).to_numpy() for name in ("name", "key", "size", "place", "last"))
        names, firsts, row = np.unique(sets.view(np.uint64), return_index=True, return_inverse=True)
        listed = _Listing(row, key, place.astype(np.int64) >> 1, last, place.astype(np.int64) & 1)
        near = lambda a, b: np.ones(len(a), bool)
        return _forest(group.column("bucket")[0].as_py(), names, _joined(listed, size[firsts].astype(np.int64), near, np.arange(len(names))))

    taken = met.select("*", often.alias("often"), before.alias("before")).where("often").select(*met.columns, last)
    return taken.groupBy("bucket").applyInArrow(resolve, "bucket int, a long, b long")


def _routes(named: DataFrame, candidates: DataFrame, buckets: int) -> DataFrame:
    """(no_id, doc, mark, routes): one row for each candidate set, and where it is verified: an owner, which is a large component or null,
    and a bucket."""
    firsts = named.groupBy("name").agg(F.min(F.struct(*ROW)).alias("row"), F.max("size").alias("size"))
    nodes = connected_components(candidates.select("a", "b")).withColumnRenamed("node", "name")
    known = stored(nodes.join(firsts, "name"), "near-copy-components")
    large = known.groupBy("component").agg(F.sum("size").alias("whole")).where(F.col("whole") > LARGE).select("component")
    block = F.pmod(F.xxhash64("component"), F.lit(buckets)).cast("int")
    whole = F.array(F.struct(F.lit(None).cast("long").alias("owner"), block.alias("bucket")))
    small = known.join(large, "component", "left_anti").select("row.*", whole.alias("routes"))
    # Both ends of an edge are of one component: only edges of large ones tell where sets go.
    spread = known.join(large, "component", "left_semi")
    edges = candidates.join(spread.select(F.col("name").alias("a")), "a", "left_semi")
    ends = edges.select("bucket", F.explode(F.array("a", "b")).alias("name")).distinct()
    spread = spread.join(ends, "name").groupBy("row", "component")
    return small.unionByName(spread.agg(F.collect_list(F.struct(F.col("component").alias("owner"), "bucket")).alias("routes")).select("row.*", "routes"))


def _whole(docs: DataFrame, routes: DataFrame, shared: Broadcast) -> DataFrame:
    """The candidate sets' shingles in order of rarity, packed by where they are verified."""
    joined = _near(docs.select(*ROW, "text"), routes, *ROW).join(routes, ROW).select("text", "routes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, 0):
            begins, sizes, tokens, _ = _sets(batch.column(0).to_pylist(), shared.value)
            names = _names(tokens, begins, sizes)
            parts: dict[tuple, list[int]] = defaultdict(list)
            for row, own in enumerate(batch.column(1).to_pylist()):
                for route in own:
                    parts[route["owner"], route["bucket"]].append(row)
            for (owner, bucket), rows in parts.items():
                held = np.concatenate([tokens[begins[r] : begins[r] + sizes[r]] for r in rows])
                packed = [pa.array([c.tobytes()], pa.binary()) for c in (names[rows], held, sizes[rows].astype("<i4"))]
                yield pa.RecordBatch.from_arrays([pa.array([owner], pa.int64()), pa.array([bucket], pa.int32()), *packed], [n.split()[0] for n in WHOLE.split(", ")])

    return joined.mapInArrow(run, WHOLE)


def _linked(tokens: np.ndarray, seen: np.ndarray, begins: np.ndarray, sizes: np.ndarray, hot_count: int, bucket: int, buckets: int) -> np.ndarray:
    """The first set of each one's group, by verified pairs of this bucket; what is linked already is not compared again."""
    listed = _listed(tokens, seen, begins, sizes, hot_count)
    here = np.nonzero((_mixed(listed.keys) % np.uint64(buckets)).astype(np.int64) == bucket)[0]
    listed = _Listing(*(column[here] for column in listed))
    _, word = np.unique(tokens, return_inverse=True)
    at, step = _spread(sizes)
    member = np.sort((at << 32) | word[begins[at] + step])

    def near(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        found, low = np.zeros(len(one), bool), 0
        ends = np.cumsum(sizes[one])
        while low < len(one):
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + VERIFIED, "right")))
            a, b = one[low:high], two[low:high]
            at, step = _spread(sizes[a])
            wanted = (b[at] << 32) | word[begins[a[at]] + step]
            hit = member[np.minimum(np.searchsorted(member, wanted), len(member) - 1)] == wanted
            both = np.bincount(at, hit, len(a)).astype(np.int64)
            found[low:high] = 10 * both >= 8 * (sizes[a] + sizes[b] - both)
            low = high
        return found

    return _joined(listed, sizes, near, np.arange(len(sizes)))


def links(docs: DataFrame, named: DataFrame, counts: np.ndarray, buckets: int) -> DataFrame:
    """Edges (a, b) between names of sets that connect exactly what the pairs of 0.8 or more connect."""
    hot_count = _hot_count(counts, buckets)
    # A table of fixed size, sent once: every executor, each of its Python workers and the driver hold it as often as it is broadcast.
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    del counts
    met = stored(_meetings(docs, shared, hot_count, buckets), "near-copy-meetings")
    candidates = stored(_candidate_links(met), "near-copy-candidates")
    discard(met)
    routes = stored(_routes(named, candidates, buckets), "near-copy-routes")

    def run(group: pa.Table) -> pa.Table:
        bucket, whole = group.column("bucket")[0].as_py(), group.column("owner")[0].as_py() is None
        names, tokens, sizes = _column(group, "sets", "<u8"), _column(group, "tokens", "<u8"), _column(group, "sizes", "<i4").astype(np.int64)
        begins = np.cumsum(sizes) - sizes
        # Equal rows of the table send the same set again.
        names, rows = np.unique(names, return_index=True)
        begins, sizes = begins[rows], sizes[rows]
        where = (len(tokens) + 1, 0, 1) if whole else (hot_count, bucket, buckets)
        seen = _seen(shared.value, tokens)
        seen = np.minimum(seen, len(tokens) + 1) if whole else seen
        return _forest(bucket, names, _linked(tokens, seen, begins, sizes, *where)).select(["a", "b"])

    found = stored(_whole(docs, routes, shared).groupBy("owner", "bucket").applyInArrow(run, "a long, b long"), "near-copy-links")
    discard(candidates, routes)
    shared.destroy()
    return found


def _alike(named: DataFrame) -> DataFrame:
    """Edges (a, b) between names of sets that connect exactly what op4's links of fingerprints connect."""
    nodes = connected_components(fingerprint_links(named)).withColumnRenamed("node", "fp")
    known = stored(named.select("name", "fp").distinct().join(nodes, "fp", "left").select("name", F.coalesce("component", "fp").alias("group")), "near-copy-fingerprints")
    firsts = known.groupBy("group").agg(F.min("name").alias("first"))
    return known.join(firsts, "group").where("name <> first").select(F.col("name").alias("a"), F.col("first").alias("b"))


def classes(docs: DataFrame, buckets: int | None = None, fingerprints: bool = False) -> DataFrame:
    """(no_id, doc, mark, component) of every row: rows of a component are connected by near copies, and by links of fingerprints if asked for."""
    buckets = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = docs.select(*row_key(), "text")
    named = stored(_named(known, fingerprints), "near-copy-names")
    edges = links(known, named, counted(known, lambda raw: _shingles(raw)[0]), buckets)
    nodes = connected_components(edges.unionByName(_alike(named)) if fingerprints else edges).withColumnRenamed("node", "name")
    return named.join(nodes, "name", "left").select(*ROW, F.coalesce("component", "name").alias("component"))


def keep_one(docs: DataFrame, buckets: int | None = None, fingerprints: bool = False) -> DataFrame:
    """The documents without all but one of each group."""
    found = stored(classes(docs, buckets, fingerprints).groupBy("component", *ROW).agg(F.count("*").alias("rows")), "near-copies")
    firsts = found.groupBy("component").agg(F.min(F.struct(*ROW)).alias("first"))
    judged = found.join(firsts, "component").select(*ROW, "rows", (F.struct(*ROW) == F.col("first")).alias("stays"))
    judged = stored(judged, "near-copies-judged")
    discard(found)
    key = [fresh_name(docs, f"near_{n}") for n in ROW]
    keyed = docs.select("*", *[c.alias(n) for n, c in zip(key, row_key())])
    named = lambda frame: frame.select(*[F.col(n).alias(k) for n, k in zip(ROW, key)])
    # A number of rejected rows has no bound: never broadcast.
    kept = keyed.join(named(judged.where("not stays")).hint("merge"), key, "left_anti")
    again = named(judged.where("stays and rows > 1"))
    if again.isEmpty():
        return kept.select(docs.columns)
    place = fresh_name(docs, "near_row")
    order = Window.partitionBy(*key).orderBy(F.xxhash64(*docs.columns))
    single = kept.join(again.hint("merge"), key, "left_anti").select(docs.columns)
    repeated = kept.join(again, key, "left_semi").withColumn(place, F.row_number().over(order)).where(F.col(place) == 1)
    return single.unionByName(repeated.select(docs.columns))
