"""Extraction in slices, quarantine, changing schemas, differences found range by range, and XML arrivals."""

import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.model import table
from quire.operators.drilldown import drill_down, unlike_ranges
from quire.operators.evolve import SchemaConflict, changes_report, read_evolved, widened
from quire.plans import gate, gold, measures, recon
from quire.plans.pipeline import Lake
from quire.session import scratch_folder
from quire.sources.quarantine import take_in
from quire.sources.slices import SlicedExtract
from quire.streaming.onix import load_products, merge_batch, products, quarantined

MONEY = T.DecimalType(11, 2)


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_slices_go_on_where_they_stopped(spark):
    rows = [(i, 2000 + i % 5 if i % 7 else None, "AB"[i % 2]) for i in range(200)]
    source = spark.createDataFrame(rows, "id int, year int, publisher string")
    extract = SlicedExtract(spark, scratch_folder(spark, "slices"), ["year", "publisher"])
    first = extract.run(source, together=3, groups=2)
    assert len(first) == 6 and extract.table(source).count() < 200
    # A row that no planned slice names arrives between the runs.
    grown = source.unionByName(spark.createDataFrame([(900, 1999, "C")], source.schema))
    second = extract.run(grown, together=3)
    assert not set(first) & set(second) and -1 in second
    assert bag(extract.table(source)) == bag(grown)
    assert sum(r.row_count for r in extract.ledger().collect()) == 201
    failing = source.withColumn("id", F.raise_error(F.lit("the source was read")).cast("int"))
    assert extract.run(failing) == [] and extract.missing() == []


def test_each_pass_reads_the_source_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [(i, 2000 + i % 5, "AB"[i % 2] if i % 9 else None) for i in range(300)]
    source = spark.createDataFrame(rows, "id int, year int, publisher string")
    source = source.mapInArrow(counted, source.schema)
    extract = SlicedExtract(spark, scratch_folder(spark, "slices"), ["year", "publisher"])
    extract.run(source, together=5)
    # The plan, two passes of five slices each, and the rows that no slice names.
    assert read.value == 4 * 300
    assert bag(extract.table(source)) == bag(spark.createDataFrame(rows, source.schema))


def test_a_slice_half_written_is_written_again(spark, monkeypatch):
    source = spark.range(40).select("id", (F.col("id") % 4).cast("int").alias("year"))
    extract = SlicedExtract(spark, scratch_folder(spark, "slices"), ["year"])
    monkeypatch.setattr(spark.__class__, "createDataFrame", spark.__class__.createDataFrame)
    extract.run(source, together=2, groups=1)
    # The data of a pass whose ledger entry is missing.
    ledger = extract.ledger().collect()
    extract.spark.createDataFrame(ledger[:1], "_slice int, row_count bigint").write.mode("overwrite").parquet(f"{extract.folder}/ledger")
    extract.run(source)
    assert bag(extract.table(source)) == bag(source)


def test_every_line_is_accounted_for(spark, tmp_path):
    fields = table("ref_canaux").source_columns
    head = "|".join(fields)
    (tmp_path / "a.csv").write_text(f"{head}\nLIB|Librairie\nWEB|Internet|too much\n\nGMS|\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text(f"{head}\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text(f"{head}\nshort\n", encoding="utf-8")
    intake = take_in(spark, str(tmp_path), table("ref_canaux"))
    assert bag(intake.accepted) == [("GMS", None), ("LIB", "Librairie")]
    assert {r._corrupt_record for r in intake.rejected.collect()} == {"WEB|Internet|too much", "short"}
    assert sorted((Path(r._file).name, r.lines, r.accepted, r.rejected, r.balanced) for r in intake.lines.collect()) == [
        ("a.csv", 3, 2, 1, True), ("b.csv", 0, 0, 0, True), ("c.csv", 1, 0, 1, True),
    ]
    assert intake.check("ref_canaux").first().status == "FAIL" and intake.check("ref_canaux", 60.0).first().status == "PASS"


@pytest.mark.parametrize(("before", "after", "holds"), [
    (T.IntegerType(), T.LongType(), T.LongType()), (T.LongType(), T.IntegerType(), None), (T.StringType(), T.IntegerType(), None),
    (T.IntegerType(), T.DecimalType(12, 2), T.DecimalType(12, 2)), (T.IntegerType(), T.DecimalType(9, 2), None),
    (MONEY, T.DecimalType(13, 3), T.DecimalType(13, 3)), (MONEY, T.DecimalType(12, 4), None), (T.FloatType(), T.DoubleType(), T.DoubleType()),
    (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()), (T.NullType(), T.StringType(), T.StringType()),
    (T.StringType(), T.NullType(), T.StringType()), (T.LongType(), T.DoubleType(), None),
])
def test_what_may_widen(before, after, holds):
    assert widened(before, after) == holds


def test_schema_changes_are_listed_and_narrower_types_fail_by_name(spark):
    one = spark.createDataFrame([(1, "a", 5)], "k int, old string, gone int")
    two = spark.createDataFrame([(2**40, "b", Decimal("1.50"))], "k bigint, new string, price decimal(9,2)")
    renames = {"old": "new"}
    assert bag(read_evolved({"one": one, "two": two}, renames)) == bag(spark.createDataFrame(
        [(1, "a", 5, None), (2**40, "b", None, Decimal("1.50"))], "k bigint, new string, gone int, price decimal(9,2)"))
    report = {(r.column_name, r.change) for r in changes_report(spark, {"one": one.schema, "two": two.schema}, renames).collect()}
    assert report == {("new", "renamed from old"), ("k", "widened"), ("price", "added"), ("gone", "missing")}
    with pytest.raises(SchemaConflict, match=r"k \(bigint to int in one\)"):
        read_evolved({"two": two, "one": one}, renames)


def test_drill_down_names_the_planted_rows(spark):
    old = spark.range(0, 50_000).select((F.col("id") * 3 - 7000).alias("k"), (F.col("id") % 11).alias("v"), F.when(F.col("id") % 5 == 0, "x").alias("t"))
    changed = old.withColumn("t", F.when(F.col("k") == 2, F.lit(None)).when(F.col("k") == 59_999, "y").otherwise(F.col("t")))
    extra = spark.createDataFrame([(100_000, 1, "new"), (None, 1, "z")], "k bigint, v bigint, t string")
    new = changed.where("k <> -6991").unionByName(extra)
    assert bag(drill_down(old, new, "k")) == bag(spark.createDataFrame(
        [(-6991, "deleted"), (2, "updated" if old.where("k = 2 and t is not null").count() else None), (59_999, "updated"), (100_000, "inserted"), (None, "inserted")],
        "k bigint, change string").where("change is not null"))
    ranges = unlike_ranges(old, new, "k")
    assert ranges and sum(high - low for low, high in ranges) < 100
    assert unlike_ranges(old, old, "k") == [] and drill_down(old, old, "k").count() == 0
    assert unlike_ranges(old.limit(0), old.limit(0), "k") == []
    assert drill_down(old.limit(0), new, "k").count() == new.count()
    with pytest.raises(ValueError, match="columns differ"):
        unlike_ranges(old, new.drop("t"), "k")


def test_drill_down_with_rows_that_differ_everywhere(spark):
    """More unlike ranges than can be written out one by one in a filter."""
    old = spark.range(0, 900_000).select((F.col("id") * 2 - 1000).alias("k"), (F.col("id") % 11).alias("v"))
    new = old.where("k % 997 <> 5").withColumn("v", F.when(F.col("k") % 1009 == 7, -1).otherwise(F.col("v")))
    differs = [(r.k, "deleted" if r.k % 997 == 5 else "updated") for r in old.where("k % 997 = 5 or k % 1009 = 7").collect()]
    ranges = unlike_ranges(old, new, "k")
    assert len(ranges) > 500 and all(any(low <= k < high for low, high in ranges) for k, _ in differs[:50])
    assert bag(drill_down(old, new, "k")) == sorted(differs, key=repr)


def product(reference, title):
    return f"<Product><RecordReference>{reference}</RecordReference><DescriptiveDetail><TitleDetail><TitleType>01</TitleType><TitleElement><TitleText>{title}</TitleText></TitleElement></TitleDetail></DescriptiveDetail></Product>"


def titles(spark, root):
    found = products(spark, root)
    return {r.RecordReference: r.DescriptiveDetail.TitleDetail[0].TitleElement[0].TitleText for r in found.collect()}


def test_xml_arrivals(spark, tmp_path):
    folder, root, seen = tmp_path / "in", scratch_folder(spark, "onix"), str(tmp_path / "seen")
    folder.mkdir()

    def drop(name, body):
        (folder / name).write_text(f"<ONIXMessage>{body}</ONIXMessage>", encoding="utf-8")

    drop("a.xml", product("1", "un") + product("2", "deux") + product("1", "un encore"))
    (folder / "cut.xml").write_text("<ONIXMessage>" + product("3", "trois") + "<Product><RecordReference>4", encoding="utf-8")
    drop("nameless.xml", product("5", "cinq") + "<Product></Product>")
    load_products(spark, str(folder), root, seen)
    assert titles(spark, root) == {"1": "un encore", "2": "deux"}
    aside = {Path(r._file).name: (r.broken_records, r.without_reference) for r in quarantined(spark, root).collect()}
    assert aside == {"cut.xml": (1, 0), "nameless.xml": (0, 1)}
    drop("b.xml", product("2", "zwei") + product("3", "drei"))
    load_products(spark, str(folder), root, seen)
    expected = {"1": "un encore", "2": "zwei", "3": "drei"}
    assert titles(spark, root) == expected and quarantined(spark, root).count() == 2
    # The batch again, after a crash between its commit and the stream's: nothing changes.
    again = spark.read.parquet(f"{root}/data/batch/*").drop("_place").limit(1)
    merge_batch(again, 1, root)
    load_products(spark, str(folder), root, seen)
    assert titles(spark, root) == expected


def test_sizes_are_those_of_the_file_system(spark, tmp_path):
    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "large"))
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "small"))
    found = recon.file_inventory({n: spark.read.parquet(str(tmp_path / n)) for n in ("small", "large")}).collect()
    assert [r.table_name for r in found] == ["large", "small"]
    for r in found:
        files = list((tmp_path / r.table_name).glob("*.parquet"))
        assert (r.files, r.bytes) == (len(files), sum(f.stat().st_size for f in files))
    assert [r.row_count for r in found] == [1000, 10]


def test_merged_sketches_are_those_of_all_rows(spark):
    loads = [spark.range(n * 3000, n * 3000 + 5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("few")) for n in range(4)]
    stored = recon.union_all([recon.distinct_sketches(df, str(n), ["k", "few"]) for n, df in enumerate(loads)])
    merged = {r.column_name: r for r in recon.merged_distinct(stored).collect()}
    rebuilt = {r.column_name: r for r in recon.merged_distinct(recon.distinct_sketches(recon.union_all(loads), "all", ["k", "few"])).collect()}
    assert {c: r.approx_distinct for c, r in merged.items()} == {c: r.approx_distinct for c, r in rebuilt.items()}
    assert abs(merged["k"].approx_distinct - 14_000) <= 0.05 * 14_000 and merged["few"].approx_distinct == 7
    assert merged["k"].loads == 4 and merged["k"].row_count == 20_000


def test_counts_come_with_the_write(spark):
    lake = Lake(spark, scratch_folder(spark, "observed"))
    reads = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    source = spark.createDataFrame([("LIB", "Librairie"), ("WEB", "")], table("ref_canaux").schema).mapInArrow(counting, table("ref_canaux").schema)
    assert lake.store_raw("ref_canaux", source).count() == 2
    assert lake.seen["bronze", "ref_canaux"]["_rows"] == 2 and reads.value == 2
    empty = spark.createDataFrame([], table("commandes").schema)
    assert lake.store_raw("commandes", empty).count() == 0
    assert lake.seen["bronze", "commandes"]["_rows"] == 0


def test_undecodable_values_reach_the_report(spark):
    lake = Lake(spark, scratch_folder(spark, "unreadable"))
    text = ", ".join(f"{c} string" for c in table("ouvrages").source_columns)
    values = {c: None for c in table("ouvrages").source_columns}
    rows = [tuple({**values, "OVISBN": "9782070368228", "OVPXHT": p, "OVDTPB": d}.values()) for p, d in (("9.50", "1200101"), ("9,50", "1201301"), (None, "0"))]
    lake.store_raw("ouvrages", spark.createDataFrame(rows, text))
    found = {r.check: (r.status, int(r.measured)) for r in lake.unreadable("ouvrages").collect()}
    assert found["unreadable ouvrages.OVPXHT"] == ("FAIL", 1) and found["unreadable ouvrages.OVDTPB"] == ("WARN", 1)
    assert found["unreadable ouvrages.OVNBPG"] == ("PASS", 0)
    delivered = spark.createDataFrame(rows, text)
    told = gate.full_gate({}, {}, {}, delivered={"ouvrages": delivered, "ref_canaux": delivered})
    assert {r.check: (r.status, int(r.measured)) for r in told.where("check like 'unreadable %'").collect()} == found


@pytest.mark.parametrize("period", ["annee", "trimestre", "mois"])
def test_ledger_adds_up_to_the_lifetime_row(spark, period):
    day = dt.date(2020, 1, 15)
    amounts = ["100.01", "50.55", "-300.00", "999.99", "0.07", "333.33"]
    sales = spark.createDataFrame([("X", day + dt.timedelta(days=50 * i), Decimal(a)) for i, a in enumerate(amounts)] + [("Y", None, Decimal("5"))], "isbn string, date_vente date, montant_ht decimal(11,2)")
    contracts = spark.createDataFrame(
        [(1, "A", "X", Decimal("7.50"), Decimal("20.00"), day, None), (2, "B", "X", Decimal("3.33"), None, day, None), (3, "C", "Z", Decimal("5.00"), Decimal("1.00"), day, None)],
        "num_contrat bigint, code_auteur string, isbn string, pct_droits decimal(5,2), avance decimal(11,2), date_debut date, date_fin date")
    bridge = spark.createDataFrame([("X", "A"), ("X", "B")], "isbn string, code_auteur string")
    whole = {r.num_contrat: r for r in measures.royalties(sales, contracts, bridge).collect()}
    ledger = measures.royalty_ledger(sales, contracts, bridge, period).orderBy("periode").collect()
    assert {r.num_contrat for r in ledger} == {1, 2}
    for number in (1, 2):
        own = [r for r in ledger if r.num_contrat == number]
        for column in ("base_ht", "droits_dus", "droits_a_payer"):
            assert sum(getattr(r, column) for r in own) == getattr(whole[number], column)
        assert own[-1].avance_restante == whole[number].avance - sum(r.avance_imputee for r in own) >= 0
        assert own[-1].droits_cumules == whole[number].droits_dus


def test_contract_facts_of_authors_and_publishers_of_orders(spark):
    authors = spark.createDataFrame([("A", "Ann"), ("B", "Bo")], "code_auteur string, nom_complet string")
    contracts = spark.createDataFrame([("A", Decimal("5"), Decimal("10"), dt.date(2020, 1, 1), None), ("A", Decimal("8"), None, dt.date(2010, 1, 1), dt.date(2012, 1, 1))],
                                      "code_auteur string, pct_droits decimal(5,2), avance decimal(11,2), date_debut date, date_fin date")
    found = {r.code_auteur: r for r in gold.author_contracts(authors, contracts, dt.date(2021, 1, 1)).collect()}
    assert (found["A"].nb_contrats, found["A"].nb_contrats_en_cours, found["A"].total_avances) == (2, 1, Decimal("10.00"))
    assert (found["B"].nb_contrats, found["B"].total_avances, found["B"].pct_droits_max) == (0, Decimal("0.00"), None)
    orders = spark.createDataFrame([(1, "X"), (2, "?"), (3, None)], "num_commande bigint, isbn string")
    books = spark.createDataFrame([("X", "E1")], "isbn string, code_editeur string")
    assert bag(gold.orders_with_publisher(orders, books).select("num_commande", "code_editeur")) == [(1, "E1"), (2, None), (3, None)]
