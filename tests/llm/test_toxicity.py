import random

import pytest

from quire.llm import toxicity

DOCS, LABELS = "doc_id long, text string, score double, features string", "doc_id long, toxic int, quality int"


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    docs, labels = [], []
    for i in range(n):
        own, toxic = [word() for _ in range(60)], rng.random() < 0.25
        if toxic:
            for _ in range(rng.randint(2, 6)):
                own[rng.randrange(60)] = rng.choice(["zurk", "zurkling", "vomple", "You"])
            own[rng.randrange(60)] = "zurk"
        docs.append((i, " ".join(own), None, "x"))
        labels.append((i, int(toxic), 0))
    return docs, labels


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = corpus()
    docs += [(2000, None, 0.0, ""), (2001, "", 0.0, ""), (None, "zurk zurk", 0.0, ""), (2002, "fine", 0.0, ""), (2002, "fine", 0.0, ""), (2003, "zurk vomple " * 9000, 0.0, "")]
    labels += [(None, 1, 1), (2002, None, 1), (0, labels[0][1], 1)]
    docs, labels = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    return docs, labels, toxicity.toxicity(docs, labels, per_class=300, rounds=6).collect()


def test_held_out_rows(learned):
    docs, labels, scored = learned
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in scored if r.held_out and r.doc_id in truth and r.doc_id < 2000]
    assert len(held) > 100
    assert sum(p == t for p, t in held) / len(held) > 0.97


def test_every_row_has_a_score(learned):
    docs, _, scored = learned
    assert len(scored) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in scored)
    by_id = {r.doc_id: r for r in scored}
    assert by_id[2000].score == by_id[2001].score < 0.5 and by_id[2003].predicted == 1 and not by_id[None].held_out


def test_filter_keeps_columns(spark, learned):
    docs, labels, scored = learned
    kept = toxicity.drop_toxic(docs, labels, per_class=300, rounds=6)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r.predicted for r in scored)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a", None, None)], DOCS)
    for labels in ([], [(1, 0, 0), (2, 0, 0)]):
        assert toxicity.toxicity(docs, spark.createDataFrame(labels, LABELS)).first().score == 0
    assert toxicity.toxicity(docs, spark.createDataFrame([(i, 1, 0) for i in range(20)], LABELS)).count() == 1
    assert toxicity.toxicity(docs.limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_features():
    lexicon = {"zur": 2.0, "=vomple": 3.0}
    found = dict(zip(toxicity.FEATURES, toxicity.features("You ZURKLING, vomple! z0urk vomples", lexicon)))
    assert found["hits"] == 2 and found["kinds"] == 2 and found["strongest"] == 3 and found["addressed"] == 2 and found["shouting"] == pytest.approx(1 / 5)
    assert toxicity.features(None, lexicon) == toxicity.features("", lexicon) == [0.0] * len(toxicity.FEATURES)


def test_lexicon_is_the_same_for_any_partitions(spark):
    docs, labels = corpus(400, seed=3)
    rows = [(doc[1], label[1]) for doc, label in zip(docs, labels)]
    frame = spark.createDataFrame(rows, "text string, toxic int")
    one, many = (toxicity.lexicon_of(frame.repartition(parts), sure=3.0) for parts in (1, 200))
    assert one == many and "=zurk" in one
