import random
import re

import numpy as np
import pyarrow as pa
import pytest

from quire.llm import line_dedup
from quire.llm.common import WORD

SCHEMA = "doc_id long, text string, line int, mark string"


def brute(rows):
    docs = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    lines = []
    for i, text in docs:
        for n, line in enumerate(text.split("\n") if text is not None else []):
            lines.append((i, text, n, frozenset(re.findall(WORD, line.encode().lower().decode()))))
    firsts, links = {}, {}
    removed = {d: set() for d in docs}
    similar = lambda a, b: 10 * len(a & b) >= 8 * len(a | b)
    for at, (i, text, n, words) in enumerate(lines):
        if not words:
            continue
        if any(s[3] and similar(words, s[3]) for s in lines[:at]):
            removed[i, text].add(n)
        firsts.setdefault(words, (i, text))
    parent = {words: words for words in firsts}

    def root(x):
        while parent[x] is not x:
            x = parent[x]
        return x

    for a in firsts:
        for b in firsts:
            if a != b and similar(a, b):
                links[a] = links.get(a, 0) + 1
                parent[root(b)] = root(a)
    own_sets, begins, times = {}, {}, {}
    for at, (i, text, n, words) in enumerate(lines):
        if words:
            own_sets.setdefault((i, text), {})[n] = words
            begins.setdefault(root(words), (i, n))
            times[words] = times.get(words, 0) + 1
    out = []
    for i, text in rows:
        own = text.split("\n") if text is not None else []
        gone, sets = removed[i, text], own_sets.get((i, text), {})
        classes = [(n, *begins[root(words)]) for n, words in sorted(sets.items()) if times[words] > 1 or words in links]
        firsts_of = [(d is not None, d) for _, d, _ in classes]
        class_id = min(firsts_of, key=lambda x: (x[0], x[1] or 0))[1] if classes else None
        out.append((i, len(own), sorted(gone), sum(links.get(words, 0) for words in set(sets.values())), classes, class_id, None if text is None else "\n".join(x for n, x in enumerate(own) if n not in gone)))
    return sorted(out, key=repr)


def got(spark, rows):
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA).repartition(3)
    return sorted(((r.doc_id, r.n_lines, list(r.removed), r.n_links, [tuple(c) for c in r.classes], r.class_id) for r in line_dedup.dedup_lines(frame).collect()), key=repr)


def kept(spark, rows):
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    left = line_dedup.kept_lines(frame)
    assert left.columns == frame.columns
    return sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)


def corpus(seed, n=40):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdé1") for _ in range(rng.randint(1, 4))) for _ in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    line = lambda: [rng.choices(vocabulary, weights)[0] for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 15, 30]))]
    old, rows = [], []
    for i in range(n):
        own = []
        for _ in range(rng.randint(0, 8)):
            words = list(rng.choice(old)) if old and rng.random() < 0.5 else line()
            if words and rng.random() < 0.6:
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rng.shuffle(words)
            old.append(words)
            own.append(rng.choice([" ", ", "]).join(words).capitalize())
        rows.append((i, "\n".join(own)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    rows += [(90, None), (91, ""), (92, "\n\n"), (None, rows[4][1] + "\nlast line of words"), rows[6], rows[6], (93, "...\n!!!"), (94, "a b c d e f g h\n" * 3)]
    assert got(spark, rows) == sorted((r[:6] for r in brute(rows)), key=repr)
    assert kept(spark, rows) == sorted(((r[0], r[6]) for r in brute(rows)), key=repr)


def test_hot_words_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_PART", 0.001)
    monkeypatch.setattr(line_dedup, "PAIRS", 50)
    rows = corpus(3)
    assert got(spark, rows) == sorted((r[:6] for r in brute(rows)), key=repr)


def test_no_rows(spark):
    assert got(spark, []) == []


def test_repeats_keep_their_links_and_class(spark):
    """Two documents with the same two similar lines: both say so."""
    one, two = "a b c d e f g h i j", "a b c d e f g h i k"
    rows = [(1, f"{one}\n{two}"), (2, f"{one}\n{two}"), (3, "nothing like it")]
    found = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)).collect()}
    assert [found[i].n_links for i in (1, 2, 3)] == [2, 2, 0]
    assert [found[i].class_id for i in (1, 2, 3)] == [1, 1, None]


def test_names_of_the_user_stay(spark):
    frame = spark.createDataFrame([(1, "a b c\na b c", "d", "m", "r")], "doc_id long, text string, line_doc string, line_mark string, line_removed string")
    left = line_dedup.kept_lines(frame)
    assert left.columns == frame.columns and tuple(left.first()) == (1, "a b c", "d", "m", "r")


def test_very_long_lines(spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    assert [r[2] for r in got(spark, [(1, long), (2, long + " more"), (3, "x")])] == [[], [0], []]


def near_lines(n):
    """Sets of twenty words that all differ in one, and lines unlike them."""
    common = " ".join(f"w{i}" for i in range(19))
    return [(i, f"{common} own{i}\nother{i} more{i} x{i} y{i} z{i}") for i in range(n)]


def test_a_set_is_sent_once_to_be_verified(spark, monkeypatch):
    """It went to the bucket of each of its words under which it may be similar to another one."""
    sent = []
    monkeypatch.setattr(line_dedup, "stored", lambda frame, label, store=line_dedup.stored: sent.append((label, out := store(frame, label), out.count())) or out)
    rows = near_lines(12) + [(100 + i, t) for i, t in near_lines(12)]
    assert got(spark, rows) == sorted((r[:6] for r in brute(rows)), key=repr)
    assert [n for label, _, n in sent if label == "line-routes"] == [12]


@pytest.mark.parametrize("limit", [("MEMBERS", 3), ("LARGE", 30), ("VERIFIED", 25)])
def test_large_components_give_the_same(spark, monkeypatch, limit):
    monkeypatch.setattr(line_dedup, *limit)
    rows = near_lines(9) + [(100 + i, t) for i, t in corpus(4, 25)]
    assert got(spark, rows) == sorted((r[:6] for r in brute(rows)), key=repr)


def test_bitmaps_tell_long_sets_apart():
    """Bits that are set by any word are all set in long sets; bits flipped by each word are not."""
    rng = np.random.default_rng(1)
    for size in (20, 60, 200, 350):
        tokens = rng.integers(1, 1 << 63, 200 * size).astype(np.uint64) * np.uint64(2)
        sizes, begins = np.full(200, size), np.arange(200) * size
        row = np.arange(200)
        ones = np.ones(200, np.uint64)
        found = [p for p in line_dedup._candidates(ones, row.astype(np.uint64), sizes, 0 * row, 0 * row, line_dedup._bitmaps(tokens, begins, sizes))]
        assert sum(len(a) for a, _ in found) <= 20


def test_words_that_share_a_key_lose_no_pair():
    """A set listed twice under one cut key keeps both places: the second word is the one in common."""
    cut = {"sets": line_dedup._cut(np.array([7, 7, 9]), line_dedup.NAME), "keys": line_dedup._cut(np.array([5, 5, 5]), line_dedup.KEY)}
    shape = {"sizes": line_dedup._planes(np.array([10, 10, 10])), "places": line_dedup._planes(np.array([0, 2, 2]))}
    row = line_dedup._row(0, line_dedup.LISTED, bitmaps=line_dedup._flat(np.zeros((3, 4), np.uint64)), **cut, **shape)
    a, b = line_dedup._may_be_similar(line_dedup._Group(pa.Table.from_batches([row]), line_dedup.LISTED))
    assert sorted([*a.tolist(), *b.tolist()]) == [7, 9]


def test_bitmaps_differ_in_no_more_bits_than_sets_do():
    """Whatever the sizes on both sides of a limit, and also once they were sent."""
    rng = np.random.default_rng(2)
    limits = line_dedup.NARROW, line_dedup.WIDE
    for size in (4, 40, *(n + k for n in limits for k in (-6, 0, 1, 6)), 300):
        base = rng.integers(1, 1 << 63, size + 20).astype(np.uint64) * np.uint64(2)
        for more in range(1, 20):
            begins, sizes = np.array([0, size]), np.array([size, size + more])
            bitmaps = line_dedup._bitmaps(np.append(base[:size], base[: size + more]), begins, sizes)
            assert (line_dedup._unflat(line_dedup._flat(bitmaps)) == bitmaps).all()
            assert line_dedup._apart(bitmaps[:1], bitmaps[1:], sizes[:1])[0] <= more
