import random

import numpy as np
import pytest

from quire.llm import suffixes

SCHEMA = "doc_id long, text string, doc string, mark int, runs int"


def brute(rows, length):
    """Every window of every document in order, against the windows seen before."""
    docs = sorted(set((i, t) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for i, text in docs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for at in range(len(raw) - length + 1):
            window = raw[at : at + length]
            if window in seen:
                gone[at : at + length] = True
            seen.add(window)
        out[i, text] = (len(raw), int(gone.sum()), int((np.diff(np.append(0, gone.astype(int))) == 1).sum()), bytes(np.frombuffer(raw, np.uint8)[~gone]))
    return sorted(((i is not None, i or 0), out[i, t]) for i, t in rows)


def got(spark, rows, **options):
    frame = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], SCHEMA).repartition(3)
    found = suffixes.remove_repeats(frame, **options).collect()
    return sorted(((r.doc_id is not None, r.doc_id or 0), (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept))) for r in found)


def corpus(seed, n=60, size=400):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 5)))
    passage = [" ".join(word() for _ in range(60)) for _ in range(3)]
    rows = []
    for i in range(n):
        text = " ".join(word() for _ in range(rng.randint(0, size // 4)))
        if rng.random() < 0.5:
            cut = rng.randint(0, len(text))
            text = text[:cut] + rng.choice(passage)[rng.randint(0, 30) :] + text[cut:]
        if rows and rng.random() < 0.3:
            old = rng.choice(rows)[1]
            at = rng.randint(0, len(old))
            text = old[:at] + rng.choice(["", "X"]) + old[at:]
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("seed,length,gram", [(1, 100, 32), (2, 20, 8), (3, 9, 4)])
def test_against_every_window(spark, seed, length, gram):
    rows = corpus(seed)
    rows += [(100, None), (101, ""), (102, "short"), (None, rows[3][1] + "tail" * 30), (104, "a" * 700), (105, "ab" * 400), (106, "a" * 150)]
    rows += [rows[5], rows[5], (107, "x" * 99), (108, "x" * 100)]
    assert got(spark, rows, length=length, gram=gram) == brute(rows, length)


def test_hot_grams_give_the_same(spark, monkeypatch):
    rows = corpus(7)
    monkeypatch.setattr(suffixes, "HOT_SAMPLE", 1.0)
    monkeypatch.setattr(suffixes, "HOT_PART", 0.001)
    assert got(spark, rows, length=20, gram=8) == brute(rows, 20)


def test_long_text_over_slices(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SLICE", 500)
    rows = corpus(8, 20, 4000)
    assert got(spark, rows, length=50, gram=16) == brute(rows, 50)


def test_no_rows_and_short_rows(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, "x"), (2, None)]) == brute([(1, "x"), (2, None)], 100)


def test_sort_and_extensions():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 99, 3000).astype(np.uint8)
    hashes = suffixes.Hashes(text, suffixes.BASES[0])
    a, b = rng.integers(0, 2900, (2, 500))
    raw = text.tobytes()
    wanted = [next((k for k in range(100) if raw[x + k] != raw[y + k]), 100) for x, y in zip(a, b)]
    assert suffixes.common_extension(hashes, a, b, 100).tolist() == wanted
    starts, segment = rng.integers(0, 2900, 700), np.sort(rng.integers(0, 20, 700))
    order = suffixes.suffix_sort(text, hashes, starts, segment, 12)
    assert order.tolist() == sorted(range(700), key=lambda i: (segment[i], raw[starts[i] : starts[i] + 12]))


def test_colliding_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(suffixes.Hashes, "of", lambda self, start, size: np.zeros(len(start), np.uint64))
    text = np.frombuffer(b"abcdabcdabce", np.uint8)
    classes = suffixes.equal_classes(text, np.array([0, 4, 8]), np.zeros(3, np.int64), 4)
    assert classes[0] == classes[1] != classes[2]
