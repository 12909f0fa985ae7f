import datetime as dt
import random
import time
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from quire.plans import measures
from quire.session import stored_once

DAY = dt.date(2020, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def test_a_book_author_and_day_meet_one_contract(spark):
    rng = random.Random(4)
    sales = [(f"b{rng.randrange(4)}", day(rng.randrange(40)), rng.randrange(-50, 200)) for _ in range(150)]
    terms = []
    for number in range(40):
        start = rng.randrange(-5, 40)
        terms.append((number, rng.choice(["a", "b", "c", None]), rng.choice(["b0", "b1", "b2", None, ""]), day(start), rng.choice([None, day(start + rng.randrange(-2, 25))])))
    wrote = [(f"b{i}", a) for i in range(4) for a in "abc" if rng.random() < 0.7]
    expected = Counter()
    for isbn in {s[0] for s in sales}:
        for author in ["a", "b", "c", None]:
            for on in range(40):
                cents = [m * 100 for i, d, m in sales if (i, d) == (isbn, day(on))]
                fit = [
                    (bool(t[2]), t[3], t[0])
                    for t in terms
                    if t[1] == author and (t[2] == isbn or (not t[2] and (isbn, author) in wrote)) and t[3] <= day(on) and (t[4] is None or t[4] >= day(on))
                ]
                if cents and fit:
                    expected[max(fit)[2], day(on), isbn] += sum(cents)
    totals = Counter()
    for (number, on, _), value in expected.items():
        totals[number, on] += value
    sold = spark.createDataFrame(sales, "isbn string, date_vente date, m int").withColumn("montant_ht", F.col("m").cast("decimal(11,2)"))
    held = spark.createDataFrame(terms, "num_contrat bigint, code_auteur string, isbn string, date_debut date, date_fin date")
    earned = measures.earnings(sold, held, spark.createDataFrame(wrote, "isbn string, code_auteur string"))
    got = Counter()
    for r in earned.collect():
        got[r.num_contrat, r.date_vente] += r._cents
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in totals.items() if v}
    # The choice is made before sales are met: nothing is grouped after the join with them.
    plan = earned._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan.split("_cents", 1)[0].split("Join")[0]


def test_spans_of_a_key_do_not_overlap(spark):
    held = spark.createDataFrame(
        [(1, "a", day(0), None, 0), (2, "a", day(5), day(9), 0), (3, None, day(1), day(2), 0)], "num_contrat bigint, code_auteur string, date_debut date, date_fin date, _for_title int"
    )
    got = {tuple(r) for r in measures.in_force(held, ["code_auteur"]).collect()}
    assert got == {("a", 1, day(0), day(5)), ("a", 2, day(5), day(10)), ("a", 1, day(10), None), (None, 3, day(1), day(3))}


def test_parts_of_authors_add_up_to_the_whole(spark, monkeypatch):
    rng = random.Random(7)
    sales = [(f"b{rng.randrange(6)}", day(rng.randrange(900)), rng.randrange(-50, 200)) for _ in range(300)]
    terms = [(n % 50, rng.choice(["a", "b", "c", "d", None]), rng.choice(["b0", "b1", None, ""]), day(rng.randrange(300)), rng.choice([None, day(700)]), 5, n) for n in range(60)]
    sold = spark.createDataFrame(sales, "isbn string, date_vente date, m int").withColumn("montant_ht", F.col("m").cast("decimal(11,2)"))
    held = spark.createDataFrame(terms, "num_contrat bigint, code_auteur string, isbn string, date_debut date, date_fin date, pct_droits int, avance int")
    held = held.withColumns({c: F.col(c).cast("decimal(11,2)") for c in ("pct_droits", "avance")})
    wrote = spark.createDataFrame([(f"b{i}", a) for i in range(6) for a in "abcd" if rng.random() < 0.7], "isbn string, code_auteur string")
    stored = []
    monkeypatch.setattr(measures, "stored_once", lambda df, label: stored.append(label) or stored_once(df, label))
    results = []
    for rows in (10**6, 1):
        monkeypatch.setattr(measures, "SLICE_ROWS", rows)
        results.append([sorted(map(repr, f(sold, held, wrote).collect())) for f in (measures.royalties, measures.royalty_ledger)])
    assert results[0] == results[1] and len(results[0][1]) > 50
    assert stored.count("earned") == 2 * (1 + measures.SLICES)


def test_a_stored_frame_leaves_no_shuffle_files(spark):
    def left():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for top in manager.localDirsString() for f in Path(top).rglob("shuffle_*")}

    before = left()
    stored = stored_once(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "shuffled")
    end = time.time() + 20
    while left() - before and time.time() < end:
        time.sleep(0.2)
    assert not left() - before and stored.count() == 7
