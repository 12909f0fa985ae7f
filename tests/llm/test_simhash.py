import itertools
import random
import re

import pytest
import xxhash

from quire.llm import simhash

SCHEMA = "doc_id long, text string, fp string, tile int, component long"


def mark(text, size=3):
    own = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    hashes = [xxhash.xxh64_intdigest(b" ".join(own[i : i + size]), 42) for i in range(max(1, len(own) - size + 1))] if own else []
    return sum((sum(h >> k & 1 for h in hashes) * 2 > len(hashes)) << k for k in range(64)) if hashes else 0


def brute(rows, radius):
    marks = [mark(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if (marks[i] ^ marks[j]).bit_count() <= radius:
            parent[root(j)] = root(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(((d, f"{marks[i]:016x}", least.get(root(i))) for i, (d, _) in enumerate(rows)), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA).repartition(3)


def corpus(seed):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(80)) for _ in range(12)]
    rows = []
    for i in range(120):
        own = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            own[rng.randrange(len(own))] = rng.choice("xyz")
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("seed,radius,tile", [(1, 2, 2048), (2, 4, 3), (3, 6, 5)])
def test_components_against_all_pairs(spark, seed, radius, tile):
    rows = corpus(seed)
    rows += [(200, None), (201, ""), (202, " \n\t"), (203, "one"), (204, "ONE two"), (None, rows[0][1]), (None, "alone " * 4), rows[3], rows[3], (205, "Ünï " * 9000)]
    got = simhash.near_duplicates(frame(spark, rows), radius=radius, tile_rows=tile).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, radius)


def test_no_rows(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_chain_of_links(spark):
    import numpy as np

    values = np.array([0, 0b11, 0b1111, 0b111111, 7 << 40, (7 << 40) | 1], np.int64)
    fps = spark.createDataFrame([(int(v),) for v in values], "fp long")
    from quire.llm.common import connected_components

    got = dict(map(tuple, connected_components(simhash.links(fps, 2, 2)).collect()))
    assert got == {0: 0, 3: 0, 15: 0, 63: 0, 7 << 40: 7 << 40, (7 << 40) | 1: 7 << 40}
