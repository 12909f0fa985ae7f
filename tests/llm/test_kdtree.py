import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import kdtree

SCHEMA = "vec_id long, embedding array<double>, score int, id string"


def brute(rows, k, is_query=lambda i: i % 10 == 0):
    usable = [(i, [math.floor(1024 * x) for x in v]) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in sorted((i, rows_v) for i, rows_v, *_ in rows if i is not None and is_query(i) and rows_v is not None and all(x is not None and math.isfinite(x) for x in rows_v)):
        queries.setdefault(i, [math.floor(1024 * x) for x in v])
    out = []
    for q, v in queries.items():
        best = [(i, sum(a * b for a, b in zip(v, w))) for i, w in usable if i != q and len(w) == len(v)]
        out += [(q, rank, i, s) for rank, (i, s) in enumerate(sorted(best, key=lambda x: (-x[1], x[0]))[:k], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, 1) for _ in range(4)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.05) for x in rng.choice(centre)]) for i in range(400)]
    rows += [(i, [1.0, 0.5, 0.25, 0.0]) for i in range(400, 460)]
    rows += [(500, None), (510, [1.0, None, 2.0, 3.0]), (520, [float("nan"), 0.0, 0.0, 0.0]), (530, [float("inf"), 0.0, 0.0, 0.0]), (540, []), (550, [1.0, 2.0]), (551, [3.0, -1.0])]
    rows += [(None, [9.0, 9.0, 9.0, 9.0]), (20, [0.0, 1.0, 0.0, 1.0]), (21, [5.0, 5.0, 5.0, 5.0]), (21, [5.0, 5.0, 5.0, 5.0])]
    rng.shuffle(rows)
    got = kdtree.top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, k=7, query_block=16, shard=90, leaf=8)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 7)


def test_fewer_than_k_large_numbers_and_no_rows(spark):
    rows = [(0, [1e6, -1e6]), (1, [2e6, 1e6]), (2, [1e-9, -1e-9])]
    assert sorted(map(tuple, kdtree.top_k(frame(spark, rows), F.col("vec_id") == 0).collect())) == brute(rows, 10, lambda i: i == 0)
    assert kdtree.top_k(frame(spark, rows).limit(0), F.col("vec_id") == 0).count() == 0
    assert kdtree.top_k(frame(spark, rows[:1]), F.col("vec_id") == 0).count() == 0


def test_repeated_rows_are_candidates_each(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [1.0, 5.0]), (2, [0.5, 0.0])]
    got = sorted(map(tuple, kdtree.top_k(frame(spark, rows), F.col("vec_id") == 0).collect()))
    assert [r[2] for r in got] == [1, 1, 2] and got == brute(rows, 10, lambda i: i == 0)


def test_bounds_skip_boxes():
    rng = np.random.default_rng(0)
    vectors = (rng.normal(size=(4000, 3)) * 1000).astype(np.int64)
    order, boxes, nodes = kdtree.build_tree(vectors, 16)
    assert sorted(order) == list(range(4000))
    for box, (low, high, *_) in zip(boxes, nodes):
        own = vectors[order[low:high]]
        assert (own.min(axis=0) == box[0]).all() and (own.max(axis=0) == box[1]).all()
    queries = kdtree._Queries(np.array([-1]), vectors[:1], 5)
    queries.floor = np.array([-(2.0**63)])
    best = [[]]
    opened = kdtree.search_tree(queries, best, order, vectors[order], boxes, nodes)
    assert opened < (nodes[:, 2] < 0).sum() / 4
    assert sorted((s for s, _ in best[0]), reverse=True) == sorted((vectors @ vectors[0]).tolist(), reverse=True)[:5]


@pytest.mark.parametrize("large", [5e15, -1e300, 1e308])
def test_large_finite_components_fail(large):
    import pyarrow as pa

    whole = lambda rows: [r.tolist() for r, _ in kdtree.whole_vectors(pa.array(rows, pa.list_(pa.float64())))]
    assert whole([[1.0, 2.0], None, [1.0, None], [float("inf"), large], [float("nan"), 1.0]]) == [[0]]
    with pytest.raises(OverflowError):
        whole([[1.0, 2.0], [1.0, large]])
