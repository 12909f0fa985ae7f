"""Token ids in ORC files: integer run-length encoding, row indexes and Bloom filters on doc_id.

Texts are dealt by range of doc_id, encoded and written in ascending order, one file per range. Stripes are read in parallel,
and a lookup of single documents skips stripes and row groups by statistics and Bloom filters.

Where the vocabulary separates tokens at white space, a text's ids are the ids of its space-separated pieces one after another;
a worker encodes a distinct piece once with the tokenizer itself and remembers it, up to a number of pieces. Null and empty texts hold only the end id.
Null doc_ids come first. Rows that repeat a doc_id follow one another, ordered by a hash of the text and then by the text;
equal rows are interchangeable. An empty table gives an empty file set. Other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import stored, utf8
from quire.llm.suffixes import BASES, Hashes
from quire.session import scratch_folder

END_ID = 2
SLICE = 256
REMEMBERED = 2_000_000
STRIPE_BYTES, STRIDE = 16 << 20, 1000
SCHEMA = "doc_id long, ids array<int>, part int, place int"

# The end of the letters of European Latin alphabets.
BEYOND_LATIN = "\u0250"
SIGNS = ".,;:!?"
SPACE, SIGN, LETTER = (np.isin(np.arange(256), list(some)) for some in (b" \t\n\r", SIGNS.encode(), bytes(range(65, 91)) + bytes(range(97, 123))))


class PieceEncoder:
    """Ids of texts, and where each text's begin.

    For a vocabulary that drops white space and marks the end of words, texts are cut at white space and before a sign that ends
    a piece. Pieces are known by two hashes; new words are encoded many at a time and told apart by their end marks. Texts that
    may hold control strings, and any other kind of vocabulary, are encoded whole.
    """

    def __init__(self, model: str, end_id: int) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id = Tokenizer.from_str(model), end_id
        described = json.loads(model)
        suffix = described["model"].get("end_of_word_suffix")
        splits = [one for one in (described.get("pre_tokenizer") or {}).get("pretokenizers", []) if one.get("type") == "Split"]
        self.by_piece = bool(suffix) and [(one["behavior"], one["invert"]) for one in splits] == [("Removed", True)]
        vocabulary = described["model"]["vocab"]
        self.ends = np.zeros(max([*vocabulary.values(), *(t["id"] for t in described.get("added_tokens", []))], default=0) + 1, bool)
        if self.by_piece:
            self.ends[[number for token, number in vocabulary.items() if token.endswith(suffix)]] = True
        self.control = tuple({token["content"][:2].encode() for token in described.get("added_tokens", [])})
        self.lowers = any(one.get("type") == "Lowercase" for one in (described.get("normalizer") or {}).get("normalizers", []))
        self._forget()

    def _forget(self) -> None:
        """Known pieces in order of their hash; the ids of all stand one after another in `pool`, the end id first."""
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.begins, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.filled = np.full(1 << 16, self.end_id, np.int32), 1

    def _keep(self, ids: np.ndarray) -> int:
        while self.filled + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.int32)])
        self.pool[self.filled : self.filled + len(ids)] = ids
        self.filled += len(ids)
        return self.filled - len(ids)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Begins in the pool and sizes of texts encoded one by one."""
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.array([len(ids) for ids in found], np.int64)
        flat = np.fromiter((i for ids in found for i in ids), np.int32, int(sizes.sum()))
        return self._keep(flat) + np.cumsum(sizes) - sizes, sizes

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters only, and words with a sign behind, many in one text."""
        parts = []
        for at in range(0, len(words), 4000):
            some = words[at : at + 4000]
            signed = np.array([not word[-1].isalpha() for word in some])
            text = " ".join([f"{word[:-1]} {word[-1]}" if apart else word for word, apart in zip(some, signed.tolist())])
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            ends = np.nonzero(self.ends[ids])[0] + 1
            if len(ends) == len(some) + signed.sum():
                lasts = ends[np.cumsum(1 + signed) - 1]
                firsts = np.append(0, lasts[:-1])
                parts.append((self._keep(ids) + firsts, lasts - firsts))
            else:
                parts.append(self._whole(some))
        return tuple(np.concatenate(column) for column in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 2

    def _learn(self, keys: np.ndarray, checks: np.ndarray, pieces: list[str]) -> None:
        """Remember new pieces, their keys ascending."""
        bare = [p[:-1] if len(p) > 1 and p[-1] in SIGNS else p for p in pieces]
        plain = np.array([p.isalpha() and max(p) < BEYOND_LATIN for p in bare], bool)
        begins, sizes = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        for chosen, encode in ((plain, self._words), (~plain, self._whole)):
            begins[chosen], sizes[chosen] = encode([p for p, use in zip(pieces, chosen) if use])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.checks = np.insert(self.keys, at, keys), np.insert(self.checks, at, checks)
        self.begins, self.sizes = np.insert(self.begins, at, begins), np.insert(self.sizes, at, sizes)

    def _cut(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All bytes with a space after each text; first byte, end and text of each piece."""
        text = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
        space, sign, letter = SPACE[text], SIGN[text], LETTER[text]
        before, after = np.append(True, space[:-1]), np.append(space[1:], True)
        split = sign & after & np.append(False, letter[:-1])
        first = np.nonzero(~space & (before | split))[0]
        end = np.nonzero(~space & (after | np.append(split[1:], False)))[0] + 1
        starts = np.cumsum([0, *(len(r) + 1 for r in raw[:-1])])
        return text, first, end, np.searchsorted(starts, first, "right") - 1

    def _known(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin in the pool, size and text of each piece."""
        text, first, end, owner = self._cut(raw)
        if not len(first):
            return first, first, owner
        sizes = (end - first).astype(np.uint64)
        keys, checks = (Hashes(text, base).of(first, end - first) * np.uint64(0x9E3779B97F4A7C15) + sizes for base in BASES)
        keys ^= keys >> np.uint64(29)
        unique, example, place = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, unique)
        new = np.append(self.keys, np.uint64(0))[at] != unique
        new |= at == len(self.keys)
        if new.any():
            chosen = example[new]
            self._learn(unique[new], checks[chosen], [text[a:b].tobytes().decode() for a, b in zip(first[chosen], end[chosen])])
            at = np.searchsorted(self.keys, unique)
        at = at[place]
        begins, counts = self.begins[at], self.sizes[at]
        # A piece whose key belongs to another one.
        for row in np.nonzero(self.checks[at] != checks)[0]:
            begins[row], counts[row] = (x[0] for x in self._whole([text[first[row] : end[row]].tobytes().decode()]))
        return begins, counts, owner

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, the end id after each text's, and the offsets of texts."""
        if len(self.keys) > REMEMBERED:
            self._forget()
        filled = self.filled
        raw = [utf8(text) for text in texts]
        odd = [not self.by_piece or any(start in r for start in self.control) for r in raw]
        cut = [b"" if o else r.lower() if self.lowers else r for r, o in zip(raw, odd)]
        begins, sizes, owner = self._known(cut) if raw else (np.zeros(0, np.int64),) * 3
        whole = np.nonzero(odd)[0]
        more = self._whole([texts[i] for i in whole])
        # Behind each text's pieces, the end id at the head of the pool.
        begins = np.concatenate([begins, more[0], np.zeros(len(raw), np.int64)])
        sizes = np.concatenate([sizes, more[1], np.ones(len(raw), np.int64)])
        owner = np.concatenate([owner, whole, np.arange(len(raw))])
        order = np.argsort(owner, kind="stable")
        begins, sizes, owner = begins[order], sizes[order], owner[order]
        ids = self.pool[np.repeat(begins - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
        if len(whole):
            self.filled = max(filled, int((self.begins + self.sizes).max(initial=1)))
        return ids, np.append(0, np.cumsum(np.bincount(owner, sizes, len(raw)).astype(np.int64)))


def encode(docs: DataFrame, model: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids, part, place) in the rows' order, `place` counting through a partition. model: a tokenizer's JSON text."""
    # One vocabulary file. A worker keeps what it has parsed and remembered for its next task.
    shipped = docs.sparkSession.sparkContext.broadcast({"model": model})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state, part, place = shipped.value, TaskContext.get().partitionId(), 0
        if "encoder" not in state:
            state["encoder"] = PieceEncoder(state["model"], end_id)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                ids, offsets = state["encoder"].encode(rows.column(1).to_pylist())
                values = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                places = pa.array(np.arange(place, place + rows.num_rows, dtype=np.int32))
                place += rows.num_rows
                parts = pa.array(np.full(rows.num_rows, part, np.int32))
                yield pa.RecordBatch.from_arrays([rows.column(0), values, parts, places], ["doc_id", "ids", "part", "place"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def write(docs: DataFrame, folder: str, model: str, end_id: int = END_ID, partitions: int | None = None) -> None:
    """Write the ids of all texts under folder in ascending doc_id order."""
    count = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("mark", F.xxhash64("text"))
    ranged = texts.repartitionByRange(count, "doc_id", "mark").sortWithinPartitions("doc_id", "mark", "text")
    options = {
        "compression": "zstd", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
        "orc.stripe.size": str(STRIPE_BYTES), "orc.row.index.stride": str(STRIDE), "orc.create.index": "true",
    }
    encode(ranged.select("doc_id", "text"), model, end_id).write.options(**options).orc(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, ids, part, place); a filter on doc_id prunes stripes and row groups."""
    return spark.read.schema(SCHEMA).orc(folder)


def digest(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files; start counts the ids of all documents before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1)
            offsets = ids.offsets.to_numpy()
            raw = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            marks = [zlib.crc32(raw[low:high].tobytes()) for low, high in zip(offsets[:-1], offsets[1:])]
            counts = pa.array(np.diff(offsets).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), counts, pa.array(marks, pa.int64()), batch.column(2), batch.column(3)],
                ["doc_id", "n_tokens", "ids_crc32", "part", "place"],
            )

    rows = stored(read(spark, folder).mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, part int, place int"), "token-digests")
    # One row per file; a file's rows are one range of doc_ids, in one task when they were written too.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = (F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).alias("start")
    return rows.join(parts, "part").select("doc_id", start, "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, model: str, end_id: int = END_ID) -> DataFrame:
    """Write docs' ids under the scratch folder and return `digest` of what the files hold."""
    folder = scratch_folder(docs.sparkSession, "token-ids")
    write(docs, folder, model, end_id)
    return digest(docs.sparkSession, folder)
