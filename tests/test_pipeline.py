import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quire.plans import gate, measures, monitor, pipeline, recon
from quire.plans.gold import resolve_codes
from quire.plans.silver import excluded_rows
from quire.session import scratch_folder

LOADED_AT = dt.datetime(2025, 3, 16, 6, 0)


@pytest.fixture(scope="module")
def outcome(spark, sources):
    return pipeline.run(
        spark, sources, scratch_folder(spark, "lake"), LOADED_AT,
        known_books=gate.KNOWN_BOOKS, known_authors=gate.KNOWN_AUTHORS,
    )


def rows(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.collect()}


def test_row_counts(outcome):
    assert {n: df.count() for n, df in outcome.silver.items() if not n.startswith("ref")} == {
        "editeurs": 8, "collections": 8, "auteurs": 10, "ouvrages": 9, "ouvrages_auteurs": 9,
        "contrats": 6, "ventes": 25, "commandes": 6, "stocks": 11,
    }
    assert {n: df.count() for n, df in outcome.gold.items() if not n.startswith("fact_droits")} == {
        "dim_dates": 9496, "dim_editeurs": 8, "dim_auteurs": 10, "dim_ouvrages": 8,
        "dim_collections": 8, "dim_entrepots": 3, "fact_ventes": 24, "fact_stocks": 10,
        "fact_commandes": 6, "fact_commandes_editeurs": 6, "pont_ouvrages_auteurs": 9,
    }


def test_bronze_keeps_padding_and_silver_trims(outcome):
    raw = outcome.bronze["editeurs"].filter("EDCODE LIKE 'STOCK%'").first()
    assert raw["EDCODE"] == "STOCK     " and len(raw["EDNOM"]) == 80
    assert ("STOCK", "Éditions Stock") in rows(outcome.silver["editeurs"], "code_editeur", "nom_editeur")


def test_dates_of_both_centuries(outcome):
    books = {r["isbn"]: r["date_publication"] for r in outcome.silver["ouvrages"].collect()}
    assert books["9782070368228"] == dt.date(1978, 3, 1)
    assert books["9782246831471"] == dt.date(2021, 10, 6)
    authors = {r["code_auteur"]: r for r in outcome.silver["auteurs"].collect()}
    assert authors["AUT00006"]["date_naissance"] == dt.date(1945, 7, 30)
    assert authors["AUT00006"]["date_deces"] is None


def test_columns_match_the_published_model(outcome):
    assert outcome.silver["ventes"].columns == [
        "num_mouvement", "isbn", "date_vente", "quantite", "montant_ht", "montant_ttc", "canal",
        "code_client", "code_entrepot", "date_reglement", "type_mouvement", "isbn_valide",
    ]
    assert outcome.gold["fact_ventes"].columns == [
        "num_mouvement", "isbn", "date_vente", "annee_vente", "mois_vente", "quantite", "montant_ht",
        "montant_ttc", "canal", "code_client", "code_entrepot", "date_reglement", "type_mouvement",
    ]
    assert outcome.gold["dim_auteurs"].columns == [
        "auteur_key", "code_auteur", "nom", "prenom", "pseudonyme", "nom_complet", "nationalite",
        "date_naissance", "date_deces", "est_vivant", "statut",
    ]


def test_dimensions(outcome):
    authors = {r["code_auteur"]: r for r in outcome.gold["dim_auteurs"].collect()}
    assert authors["AUT00009"]["nom_complet"] == "Gabo" and not authors["AUT00009"]["est_vivant"]
    assert authors["AUT00001"]["nom_complet"] == "Amélie Nothomb" and authors["AUT00001"]["est_vivant"]
    books = {r["isbn"]: r for r in outcome.gold["dim_ouvrages"].collect()}
    assert books["9782070368228"]["tranche_prix"] == "< 10 €"
    assert books["9782070368228"]["libelle_format"] == "Poche"
    assert books["9782080287410"]["tranche_prix"] == "20-30 €"
    assert len({b["ouvrage_key"] for b in books.values()}) == 8


def test_amounts(outcome):
    total = recon.control_totals(
        outcome.silver["ventes"], "ventes", "montant_ht", "montant_ttc", "quantite", "date_vente"
    ).first()
    assert total["total_ht"] == Decimal("190460.00") and total["total_ttc"] == Decimal("200927.70")
    assert total["total_qte"] == 15690 and total["date_min"] == dt.date(2010, 6, 15)
    by_book = rows(
        outcome.silver["ventes"].groupBy("isbn").agg(measures.total("montant_ttc").alias("t")), "isbn", "t"
    )
    assert ("9782070368228", Decimal("55370.00")) in by_book
    assert ("9782246831471", Decimal("7216.20")) in by_book
    gold = outcome.gold["fact_ventes"].agg(measures.total("montant_ttc").alias("t")).first()["t"]
    assert gold == Decimal("200716.70")
    assert [r["num_mouvement"] for r in excluded_rows(outcome.silver["ventes"]).collect()] == [100025]


def test_movement_types(outcome):
    assert rows(measures.net_sales(outcome.silver["ventes"]), "type_mouvement", "nb_mouvements") == {
        ("Vente", 22), ("Retour", 3),
    }


MORE_CHECKS = ("nulls ", "row_loss ", "isbn shape ", "unreadable ")


def test_gate_report(outcome):
    report = {r["check"]: r for r in outcome.report.collect()}
    status = {k: r["status"] for k, r in report.items() if not k.startswith(MORE_CHECKS)}
    assert len(status) == 16
    assert [k for k, s in status.items() if s == "FAIL"] == ["isbn checksum ouvrages"]
    assert {k for k, s in status.items() if s == "WARN"} == {"completeness ouvrages", "completeness stocks"}
    assert report["completeness ouvrages"]["detail"] == "bronze=9 silver=9 gold=8"
    assert report["accents"]["measured"] == 3
    total = gate.summary(outcome.report.filter(F.col("check").isin(*status))).first()
    assert (total["nb_pass"], total["nb_warn"], total["nb_fail"]) == (13, 2, 1)
    assert total["global_status"] == "FAIL" and total["decision"] == "HUMAN_REVIEW_REQUIRED"


def test_gate_holds_the_column_checks(outcome):
    status = {r["check"]: r["status"] for r in outcome.report.collect()}
    assert status["row_loss ventes"] == "PASS" and status["isbn shape ventes"] == "PASS"
    assert status["nulls ventes.isbn"] == "PASS" and status["nulls auteurs.pseudonyme"] == "FAIL"


def test_history_is_stored(outcome, spark):
    assert outcome.load_log.count() == len(outcome.gold)
    late = max(r.loaded_at for r in outcome.load_log.collect())
    fresh = monitor.freshness(outcome.load_log, ["fact_ventes"], late).first()
    assert fresh.row_count == outcome.gold["fact_ventes"].count() and fresh.status == "HEALTHY"


def test_absent_tables_fail_their_checks(outcome):
    some = gate.full_gate({}, {"ventes": outcome.silver["ventes"]}, {}).collect()
    failed = {r["check"] for r in some if r["status"] == "FAIL"}
    assert {"amounts", "accents", "fk ventes to ouvrages", "isbn checksum ouvrages", "completeness ventes"} <= failed
    assert {r["status"] for r in gate.full_gate({}, {}, {}).collect()} == {"FAIL"}


def test_manifest(outcome):
    listed = {r["table_name"]: r for r in outcome.manifest.collect()}
    assert listed["bronze_ventes"]["row_count"] == 25 and listed["bronze_ventes"]["is_blu_source"]
    assert listed["bronze_stocks"]["source_name"] == "STCKP" and not listed["bronze_stocks"]["is_blu_source"]


def test_lookups_win_over_fixed_labels(outcome):
    labelled = resolve_codes(outcome.silver["ventes"], outcome.silver, ["canal", "code_entrepot"])
    assert labelled.count() == 25
    assert rows(labelled, "canal", "libelle_canal") == {
        ("LIB", "Librairie indépendante"), ("GMS", "Grande et moyenne surface"),
        ("WEB", "Vente en ligne"), ("EXP", "Export international"),
    }


def test_royalties(outcome):
    due = {r["num_contrat"]: r for r in outcome.gold["fact_droits"].collect()}
    # 250+100+50-20 copies at 18.00
    assert due[1001]["base_ht"] == Decimal("6840.00") and due[1001]["droits_dus"] == Decimal("547.20")
    assert due[1001]["droits_a_payer"] == 0
    # The ended contract still covers the sales of 2010, and so does the translator's.
    assert due[1005]["droits_dus"] == Decimal("216.00") == due[1005]["droits_a_payer"]
    assert due[1006]["droits_dus"] == Decimal("108.00") and due[1006]["droits_a_payer"] == 0


def test_order_fill(outcome):
    fill = {r["statut"]: r for r in measures.order_fill(outcome.gold["fact_commandes"]).collect()}
    assert (fill["PA"]["qte_commandee"], fill["PA"]["qte_livree"]) == (15000, 12900)
    assert fill["PA"]["taux_service"] == Decimal("0.860000")
    assert fill["EN"]["delai_moyen"] is None and fill["LV"]["delai_moyen"] == Decimal("3.5000")
