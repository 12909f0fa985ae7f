import random
import re

import pytest
from pyspark.sql import functions as F

from quire.llm import decontaminate
from quire.llm.common import WORD

DOCS = "doc_id long, text string, items string, segment int"


def words(text):
    return re.findall(WORD, (text or "").encode().lower().decode())


def windows(items, window):
    out = {}
    for item, text in items:
        own = words(text)
        for at in range(max(1, len(own) - window + 1) if own else 0):
            out.setdefault(tuple(own[at : at + window]), set()).add(item)
    return out


def brute(rows, items, window, within):
    tests, out = windows(items, window), []
    for doc_id, text in rows:
        own, hit, found, near = words(text), set(), set(), set()
        for test, names in tests.items():
            named = {n for n in names if n is not None}
            for at in range(len(own) - len(test) + 1):
                if tuple(own[at : at + len(test)]) == test:
                    hit |= set(range(at, at + len(test)))
                    found |= named
            for at in range(len(own)):
                part = own[at : at + within]
                if all(part.count(w) >= test.count(w) for w in test):
                    near |= named
        out.append((doc_id, len(own), len(hit), sorted(found), sorted(near), bool(hit)))
    return sorted(out, key=repr)


def got(spark, rows, items, **options):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS).repartition(3)
    found = decontaminate.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"), **options)
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r.items), list(r.near_items), r.contaminated) for r in found.collect()), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("a b c dé E f g1 h".split())
    items = [(i, " ".join(word() for _ in range(rng.randint(0, 9)))) for i in range(12)]
    rows = []
    for i in range(50):
        own = [word() for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.6:
            test = words(rng.choice(items)[1])
            rng.random() < 0.3 and rng.shuffle(test)
            at = rng.randint(0, len(own))
            own[at:at] = test
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(own)))
    return rows, items


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"block_items": 3}), (3, {"block_items": 5})])
def test_against_every_position(spark, seed, options):
    rows, items = corpus(seed)
    rows += [(60, None), (61, ""), (None, rows[2][1]), rows[4], rows[4], (62, "A " * 500)]
    items += [(20, None), (None, "h h h c"), (3, "a a g1"), (21, "?!")]
    assert got(spark, rows, items, window=4, within=6, **options) == brute(rows, items, 4, 6)


def test_small_segments_and_frequent_terms(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "CANDIDATES", 20)
    rows, items = corpus(5)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS)
    index = decontaminate.build_index(docs, segment_words=60)
    assert index.count() > 10
    found = decontaminate.search(index, spark.createDataFrame(items, "item_id long, text string"), 4, 6)
    assert sorted(((r.doc_id, list(r.items)) for r in found.collect())) == sorted((r[0], r[3]) for r in brute(rows, items, 4, 6))


def test_empty_tables_and_filter(spark):
    rows, items = corpus(6)
    assert got(spark, [], items) == []
    assert all(not r[5] and not r[3] for r in got(spark, rows, []))
    docs = spark.createDataFrame([(1, "x a b c y", None, None), (2, "clean", None, None), (None, "a b c", None, None)], DOCS)
    kept = decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, "a b c")], "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(map(repr, (r.doc_id for r in kept.collect()))) == ["2"]


def test_rows_are_known_by_id_and_text(spark):
    rows = [(None, "x a b c y", "u", None), (5, "a b c", "u", None), (5, "clean", "u", None), (None, "clean too", "u", None), (5, "a b c", "u", None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("mark", F.lit("m")).withColumn("row_doc", F.lit("r"))
    kept = decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, "a b c")], "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted((repr(r.doc_id), r.text, r.mark, r.row_doc) for r in kept.collect()) == [("5", "clean", "m", "r"), ("None", "clean too", "m", "r")]


def test_very_long_texts_and_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 1000)
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, long), (2, "w5 w6 w7 w8"), (3, "w29000 " * 12)]
    items = [(1, long), (2, "w5 w6 w7"), (3, "none of it")]
    found = {r[0]: (r[2], r[3]) for r in got(spark, rows, items)}
    assert found == {1: (30_000, [1, 2]), 2: (3, [2]), 3: (0, [])}


def test_window_of_ten(spark):
    items = [(7, " ".join(f"w{i}" for i in range(15)))]
    rows = [(1, " ".join(f"w{i}" for i in range(9))), (2, "x " + " ".join(f"W{i}" for i in range(3, 13)) + " x"), (3, " ".join(f"w{i}" for i in range(15)))]
    assert [r[:4] for r in got(spark, rows, items)] == [(1, 9, 0, []), (2, 12, 10, [7]), (3, 15, 15, [7])]
