import re

import pytest

from quire.llm import licences
from quire.llm.common import WORD

SCHEMA = "doc_id long, text string, words string, known int, labels string"
GPL = "This work is licensed under the GNU General Public License, version 3."


def scan(spark, rows):
    frame = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)
    return {r.doc_id: r for r in licences.scan(frame).collect()}


def places(text):
    own = re.findall(WORD, (text or "").encode().lower().decode())
    return len(own), sorted(i for p in licences.BASE for i in range(len(own)) if own[i : i + len(p.split())] == p.split())


def test_places_and_labels(spark):
    rows = [
        (1, "Released under the MIT License."), (2, "x\nAPACHE LICENSE, Version 2.0 and under the mit-license, CC BY-NC 4.0 CC by nc"), (3, GPL.replace(" ", "\n * ")),
        (4, "the license of mit"), (5, None), (6, ""), (7, "..."), (8, "K " + "É" * 5 + " under the mİt license"), (9, "w " * 30_000 + licences.TEMPLATES[0].text + " tail"),
        (10, licences.TEMPLATES[0].text.replace("person", "man")), (11, "free of charge " + licences.TEMPLATES[0].text[20:]), (12, "under the mit license under the mit license"),
        (13, "general public gnu license version 3 is licensed work this under the"), (None, "cc by nc"),
    ]
    got = scan(spark, rows)
    for doc_id, text in rows:
        assert (got[doc_id].n_words, list(got[doc_id].places)) == places(text), doc_id
    labels = {i: list(r.labels) for i, r in got.items()}
    assert labels == {1: ["mit"], 2: ["apache-2", "cc-by-nc", "mit"], 3: ["gpl-3"], 4: [], 5: [], 6: [], 7: [], 8: [], 9: ["mit"], 10: ["mit"], 11: [], 12: ["mit"], 13: [], None: ["cc-by-nc"]}
    assert got[3].score == pytest.approx(1) and 0.5 < got[10].score < 1 and got[1].score == 1 and got[4].score == 0


def test_repeated_rows_and_no_rows(spark):
    frame = spark.createDataFrame([(1, GPL, "", 0, "")] * 2, SCHEMA)
    assert [list(r.labels) for r in licences.scan(frame).collect()] == [["gpl-3"]] * 2
    assert licences.scan(frame.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, GPL, "", 0, "")], SCHEMA)
    assert not re.search("Python|Arrow|Pandas", licences.scan(frame)._jdf.queryExecution().toString())


def test_whole_corpus_places(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.n_words, list(r.places)) for r in licences.scan(docs).collect()}
    assert got == {r.doc_id: places(r.text) for r in docs.collect()}


def template_labels(rows):
    """Templates by trying every place of every text."""
    split = lambda text: re.findall(WORD, (text or "").encode().lower().decode())
    texts = {i: split(text) for i, text in rows}
    vocabulary = {word for t in licences.TEMPLATES for word in t.words}
    df = {word: sum(word in own for own in texts.values()) for word in vocabulary}
    found = {}
    for i, own in texts.items():
        labels = set()
        for t in licences.TEMPLATES:
            held = sorted(set(t.words) & set(own), key=lambda w: (df[w], w))[: licences.PROBES]
            phrases = [split(p) for p in t.mandatory]
            starts = [next(k for k in range(len(t.words)) if t.words[k : k + len(p)] == p) for p in phrases]
            for shift in range(-len(t.words), len(own)):
                votes = {w for k, w in enumerate(t.words) if 0 <= shift + k < len(own) and own[shift + k] == w and w in held}
                stand = all(shift + k >= 0 and own[shift + k : shift + k + len(p)] == p for k, p in zip(starts, phrases))
                if held and 3 * len(votes) >= 2 * len(held) and stand:
                    labels.add(t.label)
        found[i] = labels
    return found


def test_template_labels_against_every_place(spark):
    import random

    rng = random.Random(2)
    rows = []
    for i in range(160):
        own = []
        for _ in range(rng.choice([1, 1, 2, 3])):
            words = rng.choice(licences.TEMPLATES).text.split()
            low = rng.choice([0, 0, 0, 2])
            words = words[low : len(words) - rng.choice([0, 0, 1, 5])]
            for _ in range(rng.choice([0, 0, 1, 3])):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(["license", "other", "the", "software"])
            own += ["filler"] * rng.randint(0, 3) + words
        rows.append((i, " ".join(own)))
    # Equal frequencies are ordered by word in both.
    got = scan(spark, rows)
    expected = template_labels(rows)
    base = {i: set(r.base_labels) for i, r in got.items()}
    assert {i: set(r.labels) for i, r in got.items()} == {i: expected[i] | base[i] for i in expected}
    assert sum(map(bool, expected.values())) > 60
