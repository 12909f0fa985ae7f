"""Incremental runs against full ones, and versions that readers see."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quire.model import table
from quire.plans import increments, measures
from quire.session import scratch_folder
from quire.sources.commits import Commit, Commits, ConflictError

AT = dt.datetime(2025, 3, 16, 6, 0)
GOLD = ("fact_ventes", "fact_commandes", "fact_stocks", "dim_ouvrages", "fact_droits")


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def earlier(sources):
    """What the sources held before: fewer sales, two of them under another year or without a date, one order not yet placed."""
    sales = sources["ventes"]
    low = sales.agg(F.min("VENUMR")).first()[0]
    newest = sales.agg(F.max("VEDTVT")).first()[0]
    place = F.col("VENUMR") - F.lit(low)
    code = F.when(place == 3, F.lit(1100101)).when(place == 5, F.lit(None).cast("int")).otherwise(F.col("VEDTVT"))
    then = sales.where((F.col("VEDTVT") < newest) | (place == 3)).withColumn("VEDTVT", code.cast("int"))
    orders = sources["commandes"]
    return {**sources, "ventes": then, "commandes": orders.where(F.col("CMDTCM") < orders.agg(F.max("CMDTCM")).first()[0])}


@pytest.fixture(scope="module")
def lake(spark, sources):
    """A run of everything in one folder, and two runs in another."""
    one, two = scratch_folder(spark, "one"), scratch_folder(spark, "two")
    full = increments.run(spark, sources, one, AT)
    first = increments.run(spark, earlier(sources), two, AT)
    # What changed before the mark needs a full read of its table: here every sale is delivered again.
    moved = sources["ventes"].withColumn("VEDTVT", F.col("VEDTVT"))
    second = increments.run(spark, {**sources, "ventes": moved}, two, AT + dt.timedelta(days=1), full=False)
    return one, two, full, first, second


def test_two_runs_equal_one(spark, sources, lake):
    one, two, *_ = lake
    mark = Commits(spark, two).at(1).marks["ventes"]
    # A sale moved back in time is not seen by the mark; the full run below sees it.
    seen = sources["ventes"].where(F.col("VEDTVT") >= mark)
    for name in GOLD:
        if name not in ("fact_ventes", "fact_droits"):
            assert bag(increments.read(spark, one, "gold", name)) == bag(increments.read(spark, two, "gold", name)), name
    fact = {r.num_mouvement: r.date_vente for r in increments.read(spark, two, "gold", "fact_ventes").collect()}
    whole = {r.num_mouvement: r.date_vente for r in increments.read(spark, one, "gold", "fact_ventes").collect()}
    assert fact.keys() == whole.keys()
    changed = {r.VENUMR for r in seen.collect()}
    assert all(fact[k] == whole[k] for k in fact if k in changed)


def test_a_full_run_takes_everything_over(spark, sources, lake):
    one, two, *_ = lake
    increments.run(spark, sources, two, AT, full=True)
    for name in GOLD:
        assert bag(increments.read(spark, one, "gold", name)) == bag(increments.read(spark, two, "gold", name)), name


def test_only_changes_are_delivered(spark, lake):
    _, two, full, first, second = lake
    assert second.version == 2 and second.delivered["ventes"] < full.delivered["ventes"]
    assert second.delivered["editeurs"] == full.delivered["editeurs"]
    rows = {(r.table_name, r.row_count) for r in second.manifest.collect()}
    assert ("bronze_ventes", second.delivered["ventes"]) in rows


def test_untouched_years_keep_their_folders(spark, lake):
    _, two, _, _, second = lake
    files = Commits(spark, two)
    old, new = files.at(1).folders("silver_ventes"), files.at(2).folders("silver_ventes")
    untouched = old.keys() - set(second.years["ventes"])
    assert untouched and all(old[y] == new[y] for y in untouched)
    assert all(old.get(y) != new[y] for y in second.years["ventes"] if y in new)


def test_a_run_that_dies_leaves_the_version_before(spark, sources, lake, monkeypatch):
    one, *_ = lake
    before = bag(increments.read(spark, one, "gold", "fact_ventes"))

    def die(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(measures, "royalties", die)
    emptied = {**sources, "ventes": sources["ventes"].limit(1)}
    with pytest.raises(RuntimeError, match="killed"):
        increments.run(spark, emptied, one, AT, full=True)
    assert Commits(spark, one).versions()[-1] == 1
    assert bag(increments.read(spark, one, "gold", "fact_ventes")) == before
    monkeypatch.undo()
    assert increments.run(spark, sources, one, AT).version == 2
    assert bag(increments.read(spark, one, "gold", "fact_ventes")) == before
    assert bag(increments.read(spark, one, "gold", "fact_ventes", version=1)) == before


def test_years_are_written_in_one_reading(spark):
    """No sample computes the rows before they are written."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(300).selectExpr("id", "date_add(DATE '2020-11-01', int(id)) AS day", "'x' AS t")
    run = increments.Run(spark, scratch_folder(spark, "years"))
    assert run.write_years("t", rows.mapInArrow(counted, rows.schema), "day", set()) == {"2020", "2021"}
    assert read.value == 300 and bag(run.known("t")) == bag(rows)
    assert bag(run.known("t", {"2020"})) == bag(rows.where("year(day) = 2020"))


def test_of_two_runs_from_one_version_one_commits(spark):
    files = Commits(spark, scratch_folder(spark, "conflict"))
    assert files.latest() == Commit() and files.read(Commit(), "t") is None
    files.commit(Commit(1, {}, {"a": 5}))
    with pytest.raises(ConflictError):
        files.commit(Commit(1, {}, {"a": 6}))
    assert files.latest().marks == {"a": 5}


def test_old_versions_expire(spark):
    files = Commits(spark, scratch_folder(spark, "expire"))
    for version in (1, 2, 3):
        folder = files.new_folder("t")
        spark.range(version).write.parquet(folder)
        shared = files.latest().folders("t").get("x", folder)
        files.commit(Commit(version, {"t": {"schema": spark.range(1).schema.json(), "folders": {"x": shared, "y": folder}}}, {}))
    gone = files.expire(keep=1)
    assert len(gone) == 1 and files.versions() == [3]
    assert files.read(files.latest(), "t").count() == 4


def test_moved_rows_and_rows_without_a_date(spark):
    """Keys are found in the year where they stood, dated or not."""
    root = scratch_folder(spark, "moved")
    schema = table("commandes").schema

    def orders(*rows):
        return spark.createDataFrame([(n, "9782070368228", day, None, q, None, None, "C", "EN") for n, day, q in rows], schema)

    increments.run(spark, {"commandes": orders((1, 1200105, 1), (2, 1210105, 2), (3, 1991332, 3), (4, 1200106, 4))}, root, AT)
    # 2 moves on, 3 gets a day, 5 comes late on the mark's day; 1 and 4 are not delivered.
    increments.run(spark, {"commandes": orders((1, 1200105, 99), (2, 1220301, 20), (3, 1220302, 30), (5, 1991332, 50))}, root, AT)
    found = {(r.num_commande, r.annee_commande, r.qte_commandee) for r in increments.read(spark, root, "gold", "fact_commandes").collect()}
    assert found == {(1, 2020, 1), (2, 2022, 20), (3, 2022, 30), (4, 2020, 4), (5, None, 50)}


def test_no_rows(spark, sources):
    root = scratch_folder(spark, "none")
    increments.run(spark, {"ventes": sources["ventes"].limit(0), "ouvrages": sources["ouvrages"].limit(0)}, root, AT)
    assert increments.read(spark, root, "gold", "fact_ventes").count() == 0
    increments.run(spark, {"ventes": sources["ventes"], "ouvrages": sources["ouvrages"]}, root, AT)
    assert increments.read(spark, root, "gold", "fact_ventes").count() == 24
