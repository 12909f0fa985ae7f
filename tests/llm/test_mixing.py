import math

import pytest
from pyspark.sql import functions as F

from quire.llm import mixing


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("tokens", F.lit("x")).withColumn("key", F.lit("y"))


def corpus():
    rows = [(i, "big", "w " * 40) for i in range(600)] + [(1000 + i, "mid", "w " * 30) for i in range(150)] + [(2000 + i, "small", "w " * 20) for i in range(60)]
    return [*rows, (3000, None, "one two"), (None, "mid", "no id here"), (3001, "silent", None), (3002, "silent", ""), (7, "big", "w " * 40)]


def entropy(weights):
    return -sum(w * math.log(w) for w in weights if w > 0)


def brute(sizes, goal, most, budget):
    """The smallest exponent that meets both conditions, by plain bisection."""
    total = sum(sizes)

    def at(p):
        z = sum((s / total) ** p for s in sizes)
        weights = [(s / total) ** p / z for s in sizes]
        spent = budget or max(s / w for s, w in zip(sizes, weights))
        return entropy(weights) <= goal + 1e-12 and max(w * spent / s for s, w in zip(sizes, weights)) <= most

    low, high = 0.0, 1.0
    if at(0.0):
        return 0.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if at(middle) else (middle, high)
    return high


@pytest.mark.parametrize("goal,most,budget", [(None, 4.0, None), (1.0, 1e9, None), (5.0, 2.0, None), (0.9, 3.0, 20_000)])
def test_exponent_and_budget(spark, goal, most, budget):
    docs = frame(spark, corpus())
    sizes = [r.n for r in docs.groupBy("source").agg(F.sum(mixing.tokens_of()).alias("n")).collect() if r.n]
    total = sum(sizes)
    natural = entropy([s / total for s in sizes])
    wanted = brute(sizes, (natural + math.log(len(sizes))) / 2 if goal is None else goal, most, budget)
    sources = mixing.plan(docs, goal, most, budget)
    found = {r.key: r for r in sources.collect()}
    z = sum((s / total) ** wanted for s in sizes)
    assert found["sbig"].weight == pytest.approx((found["sbig"].tokens / total) ** wanted / z, rel=1e-5)
    assert sum(r.weight for r in found.values()) == pytest.approx(1)
    counted = mixing.copies(docs, sources).withColumn("n", mixing.tokens_of()).groupBy("mix_key").agg(
        F.sum(F.col("n") * F.col("mix_copies")).alias("read"), F.min("mix_copies").alias("least"), F.max("mix_copies").alias("most")
    )
    for row in counted.collect():
        plan = found[row.mix_key]
        assert plan.dealt - 85 <= row.read <= plan.dealt or plan.tokens == 0
        assert row.most - row.least <= 1 and row.most <= math.ceil(most) + 1
        if budget is None:
            assert row.least >= 1
    assert found["ssilent"].weight == 0 and found["ssilent"].epochs == 1


@pytest.mark.parametrize("goal,most,budget", [(None, 4.0, None), (0.9, 3.0, 20_000), (None, 4.0, 9_000)])
def test_copies_are_permuted_blocks_up_to_the_budget(spark, monkeypatch, goal, most, budget):
    """Against a plain permutation: blocks in the order of their hashes, documents in the order of theirs, cut where the budget ends."""
    monkeypatch.setattr(mixing, "LEAST_BLOCK", 500)
    monkeypatch.setattr(mixing, "MOST_BLOCK", 700)
    rows = [r for r in corpus() if r[0] != 7]
    docs = frame(spark, rows)
    sources = mixing.plan(docs, goal, most, budget)
    known = {r.key: r for r in sources.collect()}
    got = {}
    for r in mixing.order(docs, sources).collect():
        if r.epoch is not None:
            got.setdefault(("n" if r.source is None else f"s{r.source}", r.epoch), []).append((r.block, r.place, r.doc_id))
    key = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source"))
    hashed = docs.select("doc_id", key.alias("key"), mixing.tokens_of().alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(5).cast("long"))).alias("at"))
    hashed = hashed.join(sources.select("key", "blocks"), "key").withColumn("home", F.pmod(F.xxhash64(F.lit(mixing.SEED), "doc_id"), F.col("blocks")))
    hashed = hashed.withColumns({"br": F.xxhash64(F.lit(mixing.SEED + 1), "key", "at", "home"), "pr": F.xxhash64(F.lit(mixing.SEED + 2), "at", "doc_id")}).collect()
    expected = {}
    for name, plan in known.items():
        for at in range(plan.epochs + 1):
            blocks = {}
            for r in (r for r in hashed if r.key == name and r.at == at):
                blocks.setdefault(r.br, []).append((r.pr, r.doc_id, r.n))
            whole, spent = at < plan.epochs, 0
            for block, (_, members) in enumerate(sorted(blocks.items())):
                for place, (_, doc_id, n) in enumerate(sorted(members, key=lambda m: m[0])):
                    spent += n
                    if whole or (plan.rest > 0 and spent <= plan.rest):
                        expected.setdefault((name, at + 1), []).append((block, place, doc_id))
    assert {k: sorted(v, key=repr) for k, v in got.items()} == {k: sorted(v, key=repr) for k, v in expected.items()}
    # Each epoch of a source with several blocks has an order of its own.
    first, second = (sorted(got.get(("ssmall", e), []), key=lambda x: x[:2]) for e in (1, 2))
    if known["ssmall"].epochs > 1:
        assert [x[2] for x in first] != [x[2] for x in second]


def test_columns_of_the_user_stay(spark):
    docs = spark.createDataFrame([(1, "a", "x y", "k", "c", "e"), (2, "b", "z", "k", "c", "e")], "doc_id long, source string, text string, mix_key string, mix_copies string, mix_epoch string")
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert {(r.mix_key, r.mix_copies, r.mix_epoch) for r in mixed.collect()} == {("k", "c", "e")}


def test_very_long_texts(spark):
    docs = spark.createDataFrame([(1, "a", "word " * 300_000), (2, "a", "x"), (3, "b", "y z")], "doc_id long, source string, text string")
    assert {r.doc_id for r in mixing.mix(docs).collect()} == {1, 2, 3}


def test_repeated_rows_and_columns(spark):
    docs = frame(spark, corpus())
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.where("doc_id = 7").count() % 2 == 0
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in docs.collect()}


def test_no_rows_and_one_source(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    assert mixing.mix(frame(spark, [(1, "a", "x y"), (2, "a", "z")])).count() == 2
