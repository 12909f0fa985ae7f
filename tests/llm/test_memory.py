"""What the driver and a task hold at once."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark import SparkContext

from quire.llm import common, line_dedup, near_copies

SCHEMA = "doc_id long, text string"


def components(edges):
    least = {n: n for edge in edges for n in edge}
    for _ in least:
        before = dict(least)
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
        if least == before:
            break
    return least


def graph():
    rng = random.Random(5)
    path = [(n, n + 1) for n in range(-30, 60)]
    hub = [(1000, 1000 + n) for n in range(50)]
    return path + hub + [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)] + [(2**62, -(2**62)), (7, 7), (60, 59)]


@pytest.mark.parametrize("within", [0, 1 << 18])
def test_components_with_and_without_rounds(spark, monkeypatch, within):
    monkeypatch.setattr(common, "WITHIN", within)
    edges = [e for e in graph() if e[0] != e[1]]
    for some in (graph(), []):
        got = [tuple(r) for r in common.connected_components(spark.createDataFrame(some, "a long, b long").repartition(3)).collect()]
        assert len(got) == len(dict(got)) and dict(got) == (components(edges) if some else {})


def test_few_edges_take_no_rounds(spark, monkeypatch):
    """A path needs many rounds of stars; each was two jobs or more of the driver."""
    written = []
    monkeypatch.setattr(common, "stored", lambda frame, label, store=common.stored: written.append(label) or store(frame, label))
    path = spark.createDataFrame([(n, n + 1) for n in range(500)], "a long, b long")
    assert {r.component for r in common.connected_components(path).collect()} == {0}
    assert len(written) <= 2


def test_pairs_of_a_frequent_word_take_little_memory():
    """Three thousand sets of one size under one word: 4.5 million pairs, formed in blocks."""
    n = 3000
    one = np.ones(n, np.int64)
    bitmaps = np.zeros((n, 2), np.uint64)
    tracemalloc.start()
    found = sum(len(a) for a, _ in line_dedup._candidates(one.astype(np.uint64), np.arange(n, dtype=np.uint64), 20 * one, 0 * one, 0 * one, bitmaps))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == n * (n - 1) // 2 and peak < 80 << 20


@pytest.mark.parametrize("operator", [line_dedup.dedup_lines, near_copies.classes])
def test_counters_are_broadcast_once(spark, monkeypatch, operator):
    sent = []
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value, send=SparkContext.broadcast: sent.append(len(value)) or send(self, value))
    rows = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, "a b c d e f g h i j k"), (3, "else")], SCHEMA)
    assert len(operator(rows).collect()) == 3
    assert sent == [1 << line_dedup.SLOT_BITS]


def test_counters_are_bytes_in_order_of_counts(spark):
    """The driver gets 4 MB, whatever the input; a word read once is told from one read twice."""
    times = [1, 2, 3, 63, 64, 900, 5000]
    words = [f"word{n}" for n in times]
    rows = spark.createDataFrame([(n, f"{w} " * n) for n, w in zip(times, words)], SCHEMA).repartition(3)
    counts = line_dedup.word_counts(rows)
    seen = line_dedup._seen(counts, line_dedup._word_hashes([" ".join(words).encode()])[0])
    assert counts.nbytes == 1 << line_dedup.SLOT_BITS
    assert seen[:5].tolist() == times[:5] and all(0.9 * n <= s <= n for s, n in zip(seen.tolist(), times)) and (np.diff(seen) > 0).all()
