import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from quire.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(data):
    return hashlib.sha256(data.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row):
    return digest("".join(field(v) for v in row))


def fold(place, node, levels):
    """The root above a changed node, and its siblings; levels: lists of all nodes."""
    beside = []
    for nodes in levels[:-1]:
        low = place // 16 * 16
        run = nodes[low : low + 16]
        beside += run[: place - low] + run[place - low + 1 :]
        run[place - low] = node
        node, place = digest("".join(run)), place // 16
    return node, beside


def levels_of(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([digest("".join(found[-1][i : i + 16])) for i in range(0, len(found[-1]), 16)])
    return found


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    for group in groups.values():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {name: levels_of([leaf_of(r) for r in groups[name]]) for name in names}
    top = levels_of([trees[name][-1][0] for name in names])
    found = []
    for at, name in enumerate(names):
        for place, row in enumerate(groups[name]):
            start = leaf = leaf_of(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                start = leaf_of((*row[:4], "".join(c.lower() if c.isascii() else c for c in row[4])))
            sub, beside = fold(place, start, trees[name])
            root, more = fold(at, sub, top)
            found.append((row[0], leaf, trees[name][-1][0], top[-1][0], digest("".join(beside + more)), root, root == top[-1][0]))
    return found


def got(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("tree", "place", "total", "row", "digest", "changed", "block", "of", "path", "at", "part"):
        frame = frame.withColumn(name, F.lit("clash"))
    found = merkle.audit(frame, **options)
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", F.element_at("copied", -1), "verified")


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def corpus():
    rows = [(i, "big", "en", i % 7, f"Text {i} É") for i in range(700)]
    rows += [(i, f"s{i % 40}", None, None, f"text {i}") for i in range(1000, 1120)]
    rows += [(2000, None, "x", 1, "A"), (2001, None, "x", 1, None), (None, None, None, None, None), (None, "big", "x", 5, "B"), (None, "big", "x", 5, "B"), (-7, "", "", 0, ""), (5, "big", "x", 2, "another with a number twice"), (3000, "é", "e", 3, "Long " * 50_000), (3001, "\U0001f600", "e", 3, "9:x")]
    return rows + rows[20:24]


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_against_whole_trees(spark, levels):
    """With one level a block, a source of 700 rows has three rounds of blocks."""
    rows = corpus()
    assert ordered(got(spark, rows, levels=levels).collect()) == ordered(brute(rows))


def test_ranges_cut_a_source(spark):
    rows = corpus()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert ordered(got(spark, rows, levels=1).collect()) == ordered(brute(rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_one_row_and_none(spark):
    rows = [(1, "s", None, 2, "Só")]
    assert [tuple(r) for r in got(spark, rows).collect()] == brute(rows)
    assert got(spark, []).collect() == []


def test_versions_share_what_they_do_not_copy(spark):
    rows = corpus()
    frame = spark.createDataFrame(rows, SCHEMA)
    found = merkle.audit(frame, tampered=F.when(F.col("doc_id") == 300, F.sha2(F.lit("anything").cast("binary"), 256)), levels=1).collect()
    hit = [r for r in found if r.tampered]
    assert [r.doc_id for r in hit] == [300] and not hit[0].verified and all(r.verified for r in found if not r.tampered)
    # A leaf, three levels of its source, two of the sources.
    assert len(hit[0].copied) == 6 and hit[0].copied[0] == digest("anything")
    neighbour = next(r for r in found if r.doc_id == 20)
    assert neighbour.copied[-1] == neighbour.root and not set(neighbour.copied) & set(hit[0].copied)
