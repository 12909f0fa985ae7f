import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from quire.plans import gate, gold, measures, monitor, recon
from quire.plans.gold import dim_author, fact_stock
from quire.streaming.drop_folder import load_drop_folder


def by_check(df):
    return {r["check"]: r for r in df.collect()}


def test_completeness_states(spark):
    def n(rows):
        return spark.range(rows)

    got = by_check(gate.completeness([
        gate.Layers("whole", n(1000), n(1000), n(995)),
        gate.Layers("thin", n(1000), n(1000), n(900)),
        gate.Layers("filtered", n(1000), n(1000), n(900), True),
        gate.Layers("lost", n(1000), n(980), n(980)),
        gate.Layers("absent", n(10), None, n(10)),
        gate.Layers("nowhere", None, None, None),
        gate.Layers("empty", n(0), n(0), n(0)),
    ]))
    assert {k.split()[1]: r["status"] for k, r in got.items()} == {
        "whole": "PASS", "thin": "WARN", "filtered": "PASS", "lost": "FAIL", "absent": "FAIL", "nowhere": "FAIL",
        "empty": "PASS"}
    assert got["completeness absent"]["detail"] == "bronze=10 silver=missing gold=10"


def test_two_presets(spark):
    bronze, silver = spark.range(1000), spark.range(995)
    assert by_check(gate.row_loss("t", bronze, silver))["row_loss t"]["status"] == "FAIL"
    assert by_check(gate.row_loss("t", bronze, silver, gate.STAGE_LIMITS))["row_loss t"]["status"] == "PASS"
    books = spark.range(100).select((F.col("id") >= 3).alias("isbn_valide"))
    assert by_check(gate.isbn_checksum("b", books))["isbn checksum b"]["status"] == "WARN"
    assert by_check(gate.isbn_checksum("b", books, gate.STRICT_LIMITS))["isbn checksum b"]["status"] == "FAIL"


def test_null_ratio_and_dates(spark):
    frame = spark.range(100).select(
        F.when(F.col("id") >= 10, F.col("id")).alias("some"), F.when(F.col("id") >= 30, F.col("id")).alias("many"), "id",
        F.when(F.col("id") >= 3, F.lit("2031-01-01").cast("date")).alias("d"))
    got = by_check(gate.null_ratio("t", frame.select("some", "many", "id")))
    assert [got[f"nulls t.{c}"]["status"] for c in ("some", "many", "id")] == ["WARN", "FAIL", "PASS"]
    got = by_check(gate.dates("t", frame, "d"))
    assert got["date range t.d"]["status"] == "FAIL" and got["date nulls t.d"]["status"] == "WARN"
    assert {r["status"] for r in gate.null_ratio("t", frame.limit(0)).collect()} == {"PASS"}


def test_checks_that_find_nothing_still_report(spark):
    frame = spark.createDataFrame([("x", 1)], "k string, v int")
    got = by_check(gate.expected_values(frame, [
        gate.Expected("there", "k = 'x'", "v = 1"), gate.Expected("wrong", "k = 'x'", "v = 2", gate.WARN),
        gate.Expected("absent", "k = 'y'", "v = 1")]))
    assert [got[c]["status"] for c in ("there", "wrong", "absent")] == ["PASS", "WARN", "FAIL"]
    none = gate.accent_audit("t", frame.limit(0), ["k"])
    assert gate.accents([none]).first()["status"] == "WARN"


def test_accent_damage(spark):
    good = spark.createDataFrame([("été",), ("García Márquez",), (None,)], "t string")
    counts = {r["character"]: r["row_count"] for r in gate.accent_audit("t", good, ["t"]).collect()}
    assert counts["é"] == 1 and counts["í"] == 1 and counts["ç"] == 0 and counts["�"] == 0
    assert gate.accents([gate.accent_audit("t", good, ["t"])]).first()["status"] == "PASS"
    bad = spark.createDataFrame([("Ã©tÃ©",), ("é",)], "t string")
    assert gate.accents([gate.accent_audit("t", bad, ["t"])]).first()["status"] == "WARN"


def sales(spark, rows):
    return spark.createDataFrame([(i, v and Decimal(v), ok) for i, v, ok in rows], "n int, montant_ttc decimal(11,2), isbn_valide boolean")


def test_gold_gap_must_be_explained(spark):
    silver = sales(spark, [(1, "10.00", True), (2, "-5.00", False), (3, None, True)])
    bronze = silver.select(F.col("montant_ttc").alias("VEMTTTC"))
    good, short = silver.filter("isbn_valide"), silver.filter("n = 99")
    assert {r["status"] for r in gate.amounts(bronze, silver, good).collect()} == {"PASS"}
    assert by_check(gate.amounts(bronze, silver, short))["amounts silver to gold"]["status"] == "FAIL"
    doubled = bronze.union(bronze)
    assert by_check(gate.amounts(doubled, silver, good))["amounts bronze to silver"]["status"] == "FAIL"


def test_summary(spark):
    checks = spark.createDataFrame([("PASS",), ("WARN",), ("PASS",)], "status string")
    assert tuple(gate.summary(checks).first()) == (2, 1, 0, "PASS", "GO")


def test_rates_of_empty_tables(spark):
    empty = sales(spark, [])
    assert tuple(recon.invalid_rate(empty).first()) == (0, 0, Decimal("0.000000"))
    assert recon.load_verification(empty.withColumns({"isbn": F.lit("x"), "d": F.current_date()}), "isbn", "d", "montant_ttc").first()["ca_total"] == 0


def test_freshness_and_volume(spark):
    day = dt.datetime(2024, 1, 1, 6)
    rows = [("a", day + dt.timedelta(days=i), n) for i, n in enumerate([100, 102, 98, 101, 99, 100, 500])]
    log = spark.createDataFrame(rows + [("b", day, 5)], "table_name string, loaded_at timestamp_ntz, row_count bigint")
    got = {r["table_name"]: r for r in monitor.freshness(log, ["a", "b", "c"], dt.datetime(2024, 1, 8, 6)).collect()}
    assert [got[t]["status"] for t in "abc"] == ["HEALTHY", "STALE", "STALE"]
    assert got["a"]["age_hours"] == Decimal("24.0") and got["c"]["last_load"] is None and got["c"]["row_count"] == 0
    odd = [r["load_day"] for r in monitor.volume_anomalies(log).filter("is_anomaly").collect()]
    assert odd == [dt.date(2024, 1, 7)]


def test_repeated_book_repeats_no_stock(spark):
    stock = spark.createDataFrame([("x", 1), ("y", 2)], "isbn string, n int")
    assert fact_stock(stock, spark.createDataFrame([("x",), ("x",)], "isbn string")).count() == 1


def test_dimension_keys_survive_a_rerun(spark):
    authors = spark.createDataFrame([("A1", "N", "P", None, "FR", None, None, "A")],
        "code_auteur string, nom string, prenom string, pseudonyme string, nationalite string, date_naissance date, date_deces date, statut string")
    assert dim_author(authors).first()["auteur_key"] == dim_author(authors.repartition(3)).first()["auteur_key"]


def royalty_inputs(spark, contracts):
    sold = spark.createDataFrame(
        [("X", dt.date(2020, 6, 1), "100.00"), ("X", dt.date(2021, 6, 1), "200.00"), ("X", dt.date(2021, 6, 1), "-50.00"),
         ("Y", dt.date(2021, 6, 1), "1000.00"), ("Z", dt.date(2021, 6, 1), "7.00"), ("X", None, "9999.00")],
        "isbn string, date_vente date, m string").withColumn("montant_ht", F.col("m").cast("decimal(11,2)"))
    terms = spark.createDataFrame(
        contracts, "num_contrat bigint, code_auteur string, isbn string, p string, a string, date_debut date, date_fin date, statut string"
    ).withColumns({"pct_droits": F.col("p").cast("decimal(5,2)"), "avance": F.col("a").cast("decimal(11,2)")})
    wrote = spark.createDataFrame([("X", "A"), ("Y", "A"), ("X", "B")], "isbn string, code_auteur string")
    return {r["num_contrat"]: r for r in measures.royalties(sold, terms, wrote).collect()}


def test_royalties_prefer_the_title_contract(spark):
    d = dt.date
    got = royalty_inputs(spark, [
        (1, "A", "X", "10.00", "5.00", d(2021, 1, 1), None, "A"),           # title, from 2021
        (2, "A", None, "5.00", "0.00", d(2019, 1, 1), None, "A"),           # everything by A
        (3, "A", "X", "20.00", "0.00", d(2021, 3, 1), d(2021, 12, 31), "T"),  # later start wins over 1
        (4, "B", "", "1.00", None, d(2020, 6, 1), d(2020, 6, 1), "S"),       # blank title, one day
        (5, "C", None, "50.00", "0.00", d(2019, 1, 1), None, "A"),          # wrote nothing
        (6, "A", None, "5.00", "0.00", d(2022, 1, 1), d(2021, 1, 1), "A"),  # ends before it starts
    ])
    assert {k: r["base_ht"] for k, r in got.items()} == {
        1: 0, 2: Decimal("1100.00"), 3: Decimal("150.00"), 4: Decimal("100.00"), 5: 0, 6: 0}
    assert got[2]["droits_a_payer"] == Decimal("55.00") and got[3]["droits_a_payer"] == Decimal("30.00")
    assert got[1]["droits_a_payer"] == 0 and got[4]["droits_dus"] == Decimal("1.00") and got[4]["avance"] == 0


def test_report_filters(spark, sources):
    from quire.plans.gold import fact_sales
    from quire.plans.silver import silver

    fact, books = fact_sales(silver("ventes", sources["ventes"])), silver("ouvrages", sources["ouvrages"])
    grasset = {(r["annee_vente"], r["mois_vente"]): r["montant_ttc"] for r in measures.sales_filtered(fact, books, "GRASSET", 2010).collect()}
    assert grasset == {(2010, 6): Decimal("3798.00")}
    one = measures.sales_filtered(fact, books, isbn="9782070368228").first()
    assert one["montant_ttc"] == Decimal("55370.00")
    top = measures.top_authors(fact, silver("ouvrages_auteurs", sources["ouvrages_auteurs"]), dim_author(silver("auteurs", sources["auteurs"])), 2)
    assert {r["nom_complet"]: r["montant_ttc"] for r in top.collect()} == {
        "Michel Houellebecq": Decimal("84180.50"), "Patrick Modiano": Decimal("55370.00")}


def test_drop_folder_loads_each_file_once(spark, landing, tmp_path):
    from quire.model import table

    drop, target, marks = tmp_path / "drop", str(tmp_path / "bronze"), str(tmp_path / "marks")
    drop.mkdir()
    text = (landing / "stocks.csv").read_text(encoding="utf-8")
    (drop / "one.csv").write_text(text, encoding="utf-8")
    load_drop_folder(spark, str(drop), table("stocks"), target, marks)
    load_drop_folder(spark, str(drop), table("stocks"), target, marks)
    assert spark.read.parquet(target).count() == 11
    (drop / "two.csv").write_text(text, encoding="utf-8")
    load_drop_folder(spark, str(drop), table("stocks"), target, marks)
    loaded = spark.read.parquet(target)
    assert loaded.count() == 22 and loaded.columns == table("stocks").source_columns


def test_leads_are_named_after_they_are_chosen(spark):
    pairs = spark.createDataFrame([("i1", "A", "AUT", 2), ("i1", "B", "AUT", 1), ("i1", "C", "TRA", 1), ("i2", "Z", "AUT", 1), ("i2", "A", "AUT", 1)], "isbn string, code_auteur string, role string, ordre int")
    authors = spark.createDataFrame([("A", "Ann"), ("B", "Bea")], "code_auteur string, nom_complet string")
    found = gold.named_leads(pairs, authors)
    assert {tuple(r) for r in found.collect()} == {("i1", "AUT", "B", "Bea", 2), ("i1", "TRA", "C", "Inconnu", 1), ("i2", "AUT", "A", "Ann", 2)}
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in gold.lead_authors(gold.book_authors(pairs, authors)).collect()}
