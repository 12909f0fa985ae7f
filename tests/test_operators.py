import datetime as dt

import pytest
from pyspark.sql import functions as F

from quire.operators import (
    calendar, clean_by_metadata, cluster_by, collapse_report, cosine_topk, files_holding, join_dimension, keep_latest,
    key_collisions, latest_with_ties, orphan_keys, profile_columns, resolve_code, snapshot_diff, union_evolved,
    upsert, with_surrogate_key,
)
from quire.session import scratch_folder
from quire.sources.sinks import overwrite_clustered


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def hot(spark):
    """A fact whose key 1 holds a third of the rows, with identical copies and NULL keys."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 50).cast("int").alias("k"),
        F.lit("same").alias("v"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain(spark, hot, how):
    dimension = spark.range(0, 30).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("w"))
    salted = join_dimension(hot, dimension, ["k"], how, hot_rows=100, limit=-1)
    assert bag(salted) == bag(hot.join(dimension, ["k"], how))
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def static_plans(spark):
    """No broadcasts and no runtime coalescing, so that partitions can be counted."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_salting_spreads_a_hot_key_of_copies(spark, hot, static_plans):
    dimension = spark.range(5).select(F.col("id").cast("int").alias("k"))
    salted = join_dimension(hot.repartition(16), dimension, ["k"], "inner", 100)
    sizes = [r["count"] for r in salted.filter("k = 1").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == hot.filter("k = 1").count() and len(sizes) > 1


def test_small_dimension_is_not_salted(spark, hot):
    small = spark.range(5).select(F.col("id").cast("int").alias("k"))
    assert "_salt" not in join_dimension(hot, small, ["k"])._jdf.queryExecution().optimizedPlan().toString()


def test_joins_that_cannot_be_split_are_refused(spark, hot):
    with pytest.raises(ValueError):
        join_dimension(hot, hot, ["k"], "full")


def test_orphans_count_null_keys(spark, hot):
    got = {r["k"]: r["orphan_rows"] for r in orphan_keys(hot, spark.range(2, 50).select(F.col("id").cast("int").alias("k")), "k").collect()}
    expected = {r["k"]: r["count"] for r in hot.filter("k is null or k < 2").groupBy("k").count().collect()}
    assert got == expected and None in got


def test_unknown_code_keeps_its_row(spark):
    df = spark.createDataFrame([("LIB", 1), ("ZZZ", 2), (None, 3)], "canal string, n int")
    lookup = spark.createDataFrame([("LIB", "Librairie")], "code string, libelle string")
    assert bag(resolve_code(df, lookup, "canal", "label")) == sorted(
        [("LIB", 1, "Librairie"), ("ZZZ", 2, "Inconnu"), (None, 3, "Inconnu")], key=repr)


def test_keep_latest_is_deterministic(spark):
    rows = [(1, dt.date(2024, 1, 1), "a"), (1, dt.date(2024, 1, 2), "b"), (1, dt.date(2024, 1, 2), "c"),
            (2, None, "z"), (2, dt.date(2020, 1, 1), "y"), (None, None, "n"), (None, None, "m")]
    frame = spark.createDataFrame(rows, "k int, d date, v string")
    for parts in (1, 5):
        kept = bag(keep_latest(frame.repartition(parts), ["k"], ["d"]).select("k", "v"))
        assert kept == sorted([(1, "c"), (2, "y"), (None, "n")], key=repr)


def test_keep_latest_cuts_before_the_shuffle(spark, hot):
    plan = keep_latest(hot, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_latest_with_ties(spark):
    frame = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 5, 4)], "k string, d int, v int")
    assert bag(latest_with_ties(frame, ["k"], "d").select("k", "d", "v")) == [("a", 2, 2), ("a", 2, 3), ("b", 5, 4)]


def test_collapse_report(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "n int, g string")
    assert bag(collapse_report(frame, n=["n"], g=["g"])) == [("g", 3, 2, 1), ("n", 3, 3, 0)]
    assert bag(collapse_report(frame.limit(0), n=["n"])) == [("n", 0, 0, 0)]


def test_upsert_takes_late_rows_of_the_mark_day(spark):
    day = dt.date(2024, 5, 1)
    target = spark.createDataFrame([(1, day, "old"), (2, day, "kept"), (3, dt.date(2024, 6, 1), "newer")], "k int, d date, v string")
    batch = spark.createDataFrame([(1, day, "new", "x"), (3, day, "older", "x"), (4, day, "added", "x")], "k int, d date, v string, extra string")
    got = {r["k"]: (r["v"], r["extra"]) for r in upsert(target, batch, ["k"], ("d",)).collect()}
    assert got == {1: ("new", "x"), 2: ("kept", None), 3: ("newer", None), 4: ("added", "x")}


def test_snapshot_diff(spark):
    ddl = "k int, a int, b int"
    old = spark.createDataFrame([(1, 1, None), (2, 5, 5), (3, 7, 7), (4, None, None), (6, 1, 1), (6, 2, 2), (7, 1, 1), (7, 1, 1)], ddl)
    new = spark.createDataFrame([(1, None, 1), (2, 5, 5), (4, None, None), (5, 0, 0), (6, 2, 2), (6, 1, 1), (7, 2, 2), (7, 2, 2)], ddl)
    assert {r["k"]: r["change"] for r in snapshot_diff(old, new, ["k"]).collect()} == {
        1: "updated", 2: "unchanged", 3: "deleted", 4: "unchanged", 5: "inserted", 6: "unchanged", 7: "updated"}


def test_union_evolved(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "n")], "x int, y string")
    assert bag(union_evolved(a, b)) == [(1, None), (2, "n")]


def test_surrogate_keys(spark):
    frame = spark.createDataFrame([("a", None), (None, "a"), ("b", "c")], "x string, y string")
    keyed = with_surrogate_key(frame, "key", ["x", "y"])
    assert keyed.columns == ["key", "x", "y"] and keyed.select("key").distinct().count() == 3
    assert bag(keyed) == bag(with_surrogate_key(frame.repartition(3), "key", ["x", "y"]))
    assert key_collisions(keyed, "key", ["x", "y"]).count() == 0
    assert key_collisions(keyed.withColumn("key", F.lit(1)), "key", ["x", "y"]).first()["natural_keys"] == 3


def test_clean_by_metadata(spark):
    frame = spark.createDataFrame(
        [("A ", "1250315", "x\x01y ", "1.239"), ("A", "1250316", "newer", "bad"), ("B", "0", None, "2")],
        "CODE string, DT string, TXT string, AMT string")
    meta = [
        {"name": "CODE", "type": "CHAR", "is_pk": True}, {"name": "DT", "type": "DECIMAL", "length": 7, "scale": 0, "format": "CYYMMDD"},
        {"name": "TXT", "type": "CHAR", "ccsid": 297}, {"name": "AMT", "type": "DECIMAL", "length": 5, "scale": 2},
    ]
    got = {r["code"]: r for r in clean_by_metadata(frame, meta, ("dt",)).collect()}
    assert got["A"]["dt"] == dt.date(2025, 3, 16) and got["A"]["amt"] is None and got["B"]["dt"] is None
    keyless = clean_by_metadata(frame, [{**m, "is_pk": False} for m in meta])
    assert keyless.count() == 3 and "xy" in {r["txt"] for r in keyless.collect()}


def test_calendar(spark):
    days = calendar(spark)
    assert days.count() == 9496
    row = {r["date_id"]: r for r in days.filter("annee in (2005, 2027, 2030)").collect()}
    assert row[dt.date(2027, 1, 1)]["semaine_annee"] == 53 and dt.date(2030, 12, 31) in row
    assert row[dt.date(2005, 1, 1)]["jour_semaine"] == 7 and row[dt.date(2005, 1, 1)]["nom_jour"] == "Saturday"
    seasons = {r["mois"]: r["saison_editoriale"] for r in days.filter("annee = 2005").collect()}
    assert [seasons[m] for m in (3, 4, 7, 8, 9, 10)] == [
        "Hiver", "Printemps", "Été (prix littéraires)", "Rentrée littéraire", "Rentrée littéraire", "Fin d'année (Noël)"]


def test_profile(spark):
    frame = spark.createDataFrame([(1, "ab", None), (2, None, None)], "n int, t string, e string")
    got = {r["column_name"]: r for r in profile_columns(frame, "t").collect()}
    assert (got["t"]["null_count"], got["t"]["max_length"], got["t"]["min_value"]) == (1, 2, "ab")
    assert got["e"]["null_count"] == 2 and got["n"]["approx_distinct"] == 2 and got["n"]["column_type"] == "int"


def test_clustering(spark):
    rows = spark.range(20000).select(
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 1000).cast("int")).alias("d"),
        F.when(F.col("id") % 3 == 0, "9780000000001").otherwise((F.lit(9780000000000) + F.col("id") * 7919 % 20000).cast("string")).alias("isbn"),
        F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id")).alias("n"))
    clustered = cluster_by(rows, ("d", "isbn"), partitions=16)
    assert bag(clustered) == bag(rows)
    plain, sorted_path = scratch_folder(spark, "plain"), scratch_folder(spark, "clustered")
    rows.repartition(16).write.parquet(plain)
    overwrite_clustered(rows, sorted_path, ("d", "isbn"), 16)
    bounds = {"d": (dt.date(2020, 1, 1), dt.date(2020, 2, 1)), "isbn": ("9780000010000", "9780000012000")}
    found = {p: files_holding(spark.read.parquet(p), bounds).first() for p in (plain, sorted_path)}
    assert found[sorted_path]["row_count"] == found[plain]["row_count"] > 0
    assert found[sorted_path]["files"] <= 16 / 3 < found[plain]["files"]


def test_one_value_does_not_fill_one_partition(spark):
    same = spark.range(8000).select(F.lit("x").alias("k"), F.col("id"))
    sizes = [r["count"] for r in cluster_by(same, ("k",), partitions=8).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 8000 and max(sizes) < 4000


def test_cosine_topk_equals_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(7)
    points = [[float(x) for x in p] for p in rng.normal(size=(200, 4))]
    points[5] = points[6] = points[7] = points[0]
    rows = [(i, p) for i, p in enumerate(points)] + [(900, [0.0] * 4), (901, None)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(7)
    asked = vectors.filter("vec_id in (0, 3, 900, 901)").withColumnRenamed("vec_id", "query_id")
    single = np.array(points, dtype=np.float32).astype(np.float64)
    unit = single / np.linalg.norm(single, axis=1)[:, None]
    expected = set()
    for q in (0, 3):
        order = sorted((i for i in range(200) if i != q), key=lambda i: (-round(float(unit[i] @ unit[q]), 12), i))
        expected |= {(q, i, place + 1) for place, i in enumerate(order[:4])}
    got = cosine_topk(vectors, asked, 4)
    assert {(r["query_id"], r["vec_id"], r["place"]) for r in got.collect()} == expected


def test_vector_blocks_are_skipped_and_nothing_is_lost(spark):
    """Clusters, a vector that a third of all rows repeat, and queries that are not in the table."""
    import numpy as np

    from quire.operators.vectors import CosineSearch

    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8)) * 4
    points = np.concatenate([centres[i % 12] + rng.normal(size=8) * 0.1 for i in range(400)]).reshape(400, 8)
    points = np.concatenate([points, np.repeat(points[:1], 200, axis=0)])
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)] + [(901, None), (902, [0.0] * 8), (903, [float("nan")] + [1.0] * 7)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    asked = [(i, rows[i][1]) for i in (0, 1, 5, 17, 450)] + [(-1, [1.0] + [0.0] * 7), (902, [0.0] * 8)]
    search = CosineSearch(vectors, spark.createDataFrame(asked, "query_id bigint, embedding array<double>"), 5, pivots=16, block_rows=40)
    unit = points / np.linalg.norm(points, axis=1)[:, None]
    expected = set()
    for q, v in asked[:-1]:
        scores = np.round(unit @ (np.array(v) / np.linalg.norm(v)), 12)
        order = sorted((i for i in range(600) if i != q), key=lambda i: (-scores[i], i))
        expected |= {(q, i, place + 1) for place, i in enumerate(order[:5])}
    assert {(r["query_id"], r["vec_id"], r["place"]) for r in search.result().collect()} == expected
    told = search.skipped().first()
    assert told.queries == 6 and told.skipped > 0 and told.searched + told.skipped == told.queries * told.blocks
    empty = CosineSearch(vectors.limit(0), spark.createDataFrame(asked, "query_id bigint, embedding array<double>"), 5)
    assert empty.result().count() == 0 and empty.skipped().first().searched == 0
