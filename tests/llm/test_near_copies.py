import itertools
import random

import numpy as np
import pytest

import corpus_pipeline
from quire.llm import line_dedup, near_copies, simhash

SCHEMA = "doc_id long, text string, source string"
FOLDER = "/root/testdata/sf0.001"


def shingles(text):
    own = (text or "").encode().lower().split()
    return frozenset(b" ".join(own[i : i + 5]) for i in range(max(1, len(own) - 4)))


def brute(rows):
    """The rows that stay: the first of each group of rows connected by similar sets."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
            parent[root(j)] = root(i)
    groups = {}
    for i, row in enumerate(rows):
        groups.setdefault(root(i), []).append(row)
    return sorted((min((r[0] is None, r[0] or 0) for r in group) for group in groups.values()))


def corpus(seed, n=160):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 5)))
    passage = [word() for _ in range(30)]
    base = [[word() for _ in range(rng.choice([3, 6, 12, 40, 90, 300]))] for _ in range(20)]
    rows = []
    for i in range(n):
        own = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
            own[rng.randrange(len(own))] = word()
        if rng.random() < 0.2:
            own += passage
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(own).upper() if rng.random() < 0.2 else " ".join(own)))
    return rows


def got(spark, rows):
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(3)
    kept = near_copies.keep_one(frame)
    assert kept.columns == frame.columns
    return sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two"), (None, rows[3][1]), (None, "of no other kin at all here"), (906, "ünï codé " * 5000)]
    rows += [rows[3], rows[3], (907, rows[3][1]), (4, "the same number but another text than before")]
    assert got(spark, rows) == brute(rows)


def test_hot_shingles_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_PART", 0.0001)
    monkeypatch.setattr(line_dedup, "PAIRS", 50)
    monkeypatch.setattr(near_copies, "VERIFIED", 500)
    rows = corpus(3)
    assert got(spark, rows) == brute(rows)


def test_stage_drops_near_copies_with_distant_fingerprints(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, FOLDER)
    assert sorted((False, r.doc_id) for r in kept.collect()) == brute(rows)


def test_stage_drops_what_fingerprints_link(spark):
    """op4's links count in the pipeline: a passage read fifty times with some words after it, below 0.8 on five-word shingles."""
    rng = random.Random(7)
    words = [f"w{rng.randrange(10**9)}" for _ in range(41)] * 50
    one, two = " ".join(words), " ".join([*words, *(f"x{i}" for i in range(12))])
    rows = [(1, one), (2, two), (3, "something else altogether")]
    assert (simhash.fingerprint(one) ^ simhash.fingerprint(two)).bit_count() <= simhash.RADIUS
    assert [number for _, number in brute(rows)] == [1, 2, 3]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    assert sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, frame, FOLDER).collect()) == [1, 3]


def test_no_rows(spark):
    assert got(spark, []) == []


def test_names_of_the_user_stay(spark):
    rows = [(1, "one two three four five six", "d", "m", "n", "r"), (1, "one two three four five six", "d", "m", "n", "r"), (2, "else", "d", "m", "n", "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, near_doc string, near_mark string, near_no_id string, near_row string")
    kept = near_copies.keep_one(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]


def test_large_components_are_verified_by_bucket(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "LARGE", 200)
    monkeypatch.setattr(near_copies, "STAR", 2)
    rows = corpus(4)
    assert got(spark, rows) == brute(rows)


def test_common_shingles_alone_make_no_candidates(spark, monkeypatch):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    common = [" ".join(word() for _ in range(6)) for _ in range(10)]
    texts = [" ".join([*(word() for _ in range(100)), *rng.sample(common, 3)]) for _ in range(60)]
    texts += [texts[0] + " " + word(), word() + " " + texts[1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select(*near_copies.row_key(), "text")
    found = {}

    def kept(frame, label):
        found[label] = near_copies_stored(frame, label)
        found[label + "-rows"] = found[label].count()
        return found[label]

    near_copies_stored = near_copies.stored
    monkeypatch.setattr(near_copies, "stored", kept)
    named = near_copies._named(docs, False)
    name = {r.doc: r.name for r in named.collect()}
    # Counters that are full, as those of a very large table: no shingle looks rarer than another.
    full = np.full(1 << 22, 60, np.uint8)
    edges = {frozenset(r) for r in near_copies.links(docs, named, full, 4).collect()}
    assert edges == {frozenset((name[0], name[60])), frozenset((name[1], name[61]))}
    assert 2 <= found["near-copy-candidates-rows"] <= 2 * 4
