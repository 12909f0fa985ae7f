import re

import corpus_pipeline
from quire.llm import decontaminate
from quire.llm.common import WORD
from tests.llm.test_near_copies import brute

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_their_own_input(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["toxicity", "near_dedup", "decontamination", "mixing", "token_ids"]

    one = steps["near_dedup"](spark, docs, FOLDER)
    marks = {r.doc_id for r in docs.collect()}
    assert sorted((False, r.doc_id) for r in one.collect()) == brute([(r.doc_id, r.text) for r in docs.collect()])

    two = steps["decontamination"](spark, docs, FOLDER)
    tests = set()
    for row in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        own = re.findall(WORD, row.text.encode().lower().decode())
        tests |= {" ".join(own[i : i + 10]) for i in range(max(1, len(own) - 9))}
    dirty = {r.doc_id for r in docs.collect() if any(f" {t} " in f" {' '.join(re.findall(WORD, r.text.encode().lower().decode()))} " for t in tests)}
    assert {r.doc_id for r in two.collect()} == marks - dirty
    assert decontaminate.WINDOW == 10

    three = steps["mixing"](spark, docs, FOLDER)
    assert {r.doc_id for r in three.collect()} == marks
    for frame in (one, two, three, steps["toxicity"](spark, docs, FOLDER)):
        assert frame.columns == docs.columns


def test_run(spark):
    rows = corpus_pipeline.run(spark, FOLDER).orderBy("start").collect()
    assert rows and [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids)
