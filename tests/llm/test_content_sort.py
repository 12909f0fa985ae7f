import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quire.llm import content_sort

SCHEMA = "doc_id long, text string"


def same(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute(rows):
    groups = {}
    for place, (doc_id, text) in enumerate(rows):
        groups.setdefault(same(text), []).append((-len(text or ""), doc_id is None, doc_id or 0, place, doc_id))
    best = {key: min(group) for key, group in groups.items()}
    found = []
    for place, (doc_id, text) in enumerate(rows):
        key = same(text)
        found.append((doc_id, best[key][4], len(groups[key]), best[key][3] == place, hashlib.sha256(key.encode()).hexdigest()))
    return found


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé ß\t") for _ in range(rng.choice([0, 1, 3, 70, 400]))) for _ in range(30)]
    prefix = "the same beginning of many texts, longer than the head of bytes that the splitters know, so only digests differ "
    rows = []
    for i in range(n):
        text = rng.choice(base)
        if rng.random() < 0.3:
            text = prefix + text
        rows.append((rng.choice([i, i, i, 5, None]), "".join(c + rng.choice(["", "", " ", "\n"]) for c in text)))
    return rows


@pytest.mark.parametrize("partitions", ["1", "4", "23"])
def test_against_groups_in_python(spark, partitions):
    rows = corpus(3, 400) + [(900, None), (901, ""), (902, " \r\x0b\x0c\n"), (903, "a b"), (904, "ab"), (905, "long " * 60_000), (906, "long" * 60_000), (907, "x"), (907, "x"), (907, "x")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = content_sort.exact_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ordered(got) == ordered(brute(rows))


def test_a_group_over_many_ranges(spark):
    """Every batch sends a row of the hot text; they fill several ranges whose borders are compared."""
    rows = [(i, "hot text" if i % 4 else f"text {i // 8}") for i in range(2000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = content_sort.exact_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ordered(found) == ordered(brute(rows))


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert content_sort.exact_duplicates(empty).collect() == []
    assert content_sort.keep_one(empty).collect() == []


def test_kept_rows_with_clashing_names(spark):
    rows = corpus(5, 120)
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("row", "ref", "part", "run", "digest", "keep_id", "kept", "size"):
        frame = frame.withColumn(name, F.lit("own"))
    kept = content_sort.keep_one(frame)
    assert kept.columns == frame.columns
    found = kept.collect()
    assert {r.row for r in found} == {"own"}
    expected = [(row[0], row[1]) for row, judged in zip(rows, brute(rows)) if judged[3]]
    assert sorted(same(r.text) for r in found) == sorted(same(text) for _, text in expected)
    assert ordered((r.doc_id, len(r.text or "")) for r in found) == ordered((d, len(t or "")) for d, t in expected)
