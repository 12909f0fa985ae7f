"""The 13 source tables with their types, keys and cleaned column names."""

from __future__ import annotations

from quire.model.fields import SourceTable, char, day, number

TABLES = {
    t.name: t
    for t in (
        SourceTable(
            "OUVRGP", "ouvrages", ("isbn",),
            (
                char("OVISBN", 13, "isbn", True),
                char("OVTITR", 200, "titre", True),
                char("OVSTIT", 200, "sous_titre"),
                char("OVEDIT", 10, "code_editeur", True),
                char("OVCOLL", 10, "code_collection"),
                char("OVFMT", 3, "format", True),
                char("OVLANG", 3, "langue"),
                number("OVNBPG", 5, 0, "nb_pages"),
                number("OVPXHT", 9, 2, "prix_ht", True),
                number("OVPXTTC", 9, 2, "prix_ttc", True),
                number("OVTVA", 5, 2, "taux_tva"),
                day("OVDTPB", "date_publication"),
                day("OVDTCR", "date_creation"),
                day("OVDTMJ", "date_maj"),
                char("OVSTAT", 2, "statut"),
                number("OVTIRG", 9, 0, "tirage_initial"),
                number("OVPOID", 7, 0, "poids_grammes"),
                char("OVEAN", 13, "ean"),
                char("OVCOMM", 500, "commentaire"),
            ),
            newest_by=("date_maj", "date_creation"),
        ),
        SourceTable(
            "AUTURP", "auteurs", ("code_auteur",),
            (
                char("AUCODE", 10, "code_auteur", True),
                char("AUNOM", 60, "nom", True),
                char("AUPRN", 60, "prenom"),
                char("AUPSEUD", 80, "pseudonyme"),
                char("AUNATI", 3, "nationalite"),
                day("AUDTNS", "date_naissance"),
                day("AUDTDC", "date_deces"),
                char("AUEMAIL", 100, "email"),
                day("AUDTCR", "date_creation_fiche"),
                char("AUSTAT", 1, "statut"),
            ),
            newest_by=("date_creation_fiche",),
        ),
        SourceTable(
            "OVAUJP", "ouvrages_auteurs", ("isbn", "code_auteur", "role"),
            (
                char("JAISBN", 13, "isbn", True),
                char("JAAUTE", 10, "code_auteur", True),
                char("JAROLE", 3, "role"),
                number("JAORDR", 3, 0, "ordre"),
            ),
        ),
        SourceTable(
            "EDITRP", "editeurs", ("code_editeur",),
            (
                char("EDCODE", 10, "code_editeur", True),
                char("EDNOM", 80, "nom_editeur", True),
                char("EDIMPR", 80, "imprint"),
                char("EDGRPE", 10, "groupe"),
                char("EDPAYS", 2, "pays"),
                char("EDSTAT", 1, "statut"),
            ),
        ),
        SourceTable(
            "COLLCP", "collections", ("code_collection",),
            (
                char("CLCODE", 10, "code_collection", True),
                char("CLNOM", 80, "nom_collection", True),
                char("CLEDIT", 10, "code_editeur", True),
                day("CLDTCR", "date_creation"),
                char("CLSTAT", 1, "statut"),
            ),
            newest_by=("date_creation",),
        ),
        SourceTable(
            "VENTEP", "ventes", ("num_mouvement",),
            (
                number("VENUMR", 15, 0, "num_mouvement", True),
                char("VEISBN", 13, "isbn", True),
                day("VEDTVT", "date_vente", True),
                number("VEQTE", 9, 0, "quantite", True),
                number("VEMTHT", 11, 2, "montant_ht", True),
                number("VEMTTTC", 11, 2, "montant_ttc", True),
                char("VECANL", 3, "canal", True),
                char("VECLIE", 10, "code_client"),
                char("VEENTR", 5, "code_entrepot"),
                day("VEDTRG", "date_reglement"),
                char("VESTAT", 1, "statut"),
            ),
            newest_by=("date_vente",),
            column_organised=True,
        ),
        SourceTable(
            "CMDEP", "commandes", ("num_commande",),
            (
                number("CMNUMR", 15, 0, "num_commande", True),
                char("CMISBN", 13, "isbn", True),
                day("CMDTCM", "date_commande", True),
                day("CMDTLV", "date_livraison"),
                number("CMQTE", 9, 0, "qte_commandee", True),
                number("CMQTLV", 9, 0, "qte_livree"),
                number("CMMTHT", 11, 2, "montant_ht"),
                char("CMCLIE", 10, "code_client", True),
                char("CMSTAT", 2, "statut"),
            ),
            newest_by=("date_commande",),
        ),
        SourceTable(
            "STCKP", "stocks", ("isbn", "code_entrepot", "date_position"),
            (
                char("SKISBN", 13, "isbn", True),
                char("SKENTR", 5, "code_entrepot", True),
                day("SKDTPS", "date_position", True),
                number("SKQTDS", 9, 0, "qte_disponible"),
                number("SKQTRS", 9, 0, "qte_reservee"),
                number("SKQTTR", 9, 0, "qte_transit"),
                number("SKQTPI", 9, 0, "qte_pilonnee"),
            ),
        ),
        SourceTable(
            "CNTRTP", "contrats", ("num_contrat",),
            (
                number("CTNUM", 10, 0, "num_contrat", True),
                char("CTAUTE", 10, "code_auteur", True),
                char("CTISBN", 13, "isbn"),
                char("CTTYPE", 3, "type_contrat", True),
                number("CTPCTD", 5, 2, "pct_droits", True),
                number("CTAVNC", 11, 2, "avance"),
                day("CTDTDB", "date_debut", True),
                day("CTDTFN", "date_fin"),
                char("CTSTAT", 1, "statut"),
            ),
            newest_by=("date_debut",),
        ),
        SourceTable(
            "RFCANL", "ref_canaux", ("code",),
            (char("RCCODE", 3, "code", True), char("RCLIB", 40, "libelle", True)),
        ),
        SourceTable(
            "RFFMT", "ref_formats", ("code",),
            (char("RFCODE", 3, "code", True), char("RFLIB", 40, "libelle", True)),
        ),
        SourceTable(
            "RFSTAT", "ref_statuts", ("code",),
            (char("RSCODE", 2, "code", True), char("RSLIB", 40, "libelle", True)),
        ),
        SourceTable(
            "RFENTR", "ref_entrepots", ("code",),
            (
                char("RECODE", 5, "code", True),
                char("RENOM", 60, "libelle", True),
                char("REVILL", 40, "ville"),
            ),
        ),
    )
}


def table(name: str) -> SourceTable:
    """A table by its cleaned name or its source name."""
    if name in TABLES:
        return TABLES[name]
    return next(t for t in TABLES.values() if t.source == name.upper())
