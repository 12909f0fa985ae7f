"""Gold: dimensions, bridge and facts of the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import (
    display_name,
    format_label,
    is_missing,
    price_band,
    status_label,
)
from quire.operators.joins import join_dimension, resolve_code
from quire.operators.keys import with_surrogate_key

ACTIVE = "A"


def dim_publisher(publishers: DataFrame) -> DataFrame:
    """Active publishers."""
    active = publishers.filter(F.col("statut") == ACTIVE).select(
        "code_editeur", "nom_editeur", "imprint", "groupe", "pays"
    )
    return with_surrogate_key(active, "editeur_key", ["code_editeur"])


def dim_author(authors: DataFrame) -> DataFrame:
    """Authors with the name to show and whether they live."""
    named = authors.select(
        "code_auteur",
        "nom",
        "prenom",
        "pseudonyme",
        display_name("pseudonyme", "prenom", "nom").alias("nom_complet"),
        "nationalite",
        "date_naissance",
        "date_deces",
        is_missing("date_deces").alias("est_vivant"),
        "statut",
    )
    return with_surrogate_key(named, "auteur_key", ["code_auteur"])


def author_contracts(authors: DataFrame, contracts: DataFrame, as_of: dt.date) -> DataFrame:
    """The author dimension with what the contracts say: how many, how many in term, rates, advances, first start.

    Contracts are summed to the author first; an author without one has zeros.
    """
    in_term = (F.col("date_debut") <= F.lit(as_of)) & (F.col("date_fin").isNull() | (F.col("date_fin") >= F.lit(as_of)))
    summed = contracts.groupBy("code_auteur").agg(
        F.count("*").alias("nb_contrats"),
        F.count_if(in_term).alias("nb_contrats_en_cours"),
        F.min("pct_droits").alias("pct_droits_min"),
        F.max("pct_droits").alias("pct_droits_max"),
        F.sum("avance").cast("decimal(28,2)").alias("total_avances"),
        F.min("date_debut").alias("premier_contrat"),
    )
    none = {"nb_contrats": F.lit(0).cast("bigint"), "nb_contrats_en_cours": F.lit(0).cast("bigint"), "total_avances": F.lit(0).cast("decimal(28,2)")}
    joined = authors.join(summed, "code_auteur", "left")
    return joined.withColumns({c: F.coalesce(c, zero) for c, zero in none.items()})


def dim_book(books: DataFrame) -> DataFrame:
    """Books with a valid ISBN, labelled and banded by price."""
    labelled = books.filter("isbn_valide").select(
        "isbn",
        "titre",
        "sous_titre",
        "code_editeur",
        "code_collection",
        "format",
        format_label("format").alias("libelle_format"),
        "langue",
        "nb_pages",
        "prix_ht",
        "prix_ttc",
        "taux_tva",
        "date_publication",
        "statut",
        status_label("statut").alias("libelle_statut"),
        "tirage_initial",
        "poids_grammes",
        price_band("prix_ttc").alias("tranche_prix"),
        "commentaire",
    )
    return with_surrogate_key(labelled, "ouvrage_key", ["isbn"])


def dim_collection(collections: DataFrame, publishers: DataFrame) -> DataFrame:
    """Collections with the publisher that owns them; an unknown owner stays NULL."""
    owners = publishers.select("code_editeur", "nom_editeur")
    named = join_dimension(collections, owners, ["code_editeur"], "left").select(
        "code_collection", "nom_collection", "code_editeur", "nom_editeur", "date_creation", "statut"
    )
    return with_surrogate_key(named, "collection_key", ["code_collection"])


def dim_warehouse(warehouses: DataFrame) -> DataFrame:
    """Warehouses with name and town."""
    named = warehouses.select(
        F.col("code").alias("code_entrepot"), F.col("libelle").alias("nom_entrepot"), "ville"
    )
    return with_surrogate_key(named, "entrepot_key", ["code_entrepot"])


def fact_sales(sales: DataFrame) -> DataFrame:
    """Sales on valid ISBNs at movement grain, with year and month."""
    return sales.filter("isbn_valide").select(
        "num_mouvement",
        "isbn",
        "date_vente",
        F.year("date_vente").alias("annee_vente"),
        F.month("date_vente").alias("mois_vente"),
        "quantite",
        "montant_ht",
        "montant_ttc",
        "canal",
        "code_client",
        "code_entrepot",
        "date_reglement",
        "type_mouvement",
    )


def fact_stock(stock: DataFrame, books: DataFrame) -> DataFrame:
    """Stock positions of books in the dimension; a semi join, so a repeated book repeats no position."""
    return join_dimension(stock, books.select("isbn"), ["isbn"], "left_semi")


def fact_orders(orders: DataFrame) -> DataFrame:
    """Orders with open quantity and lead time in days."""
    delivered = F.coalesce("qte_livree", F.lit(0))
    return orders.select(
        "num_commande",
        "isbn",
        "date_commande",
        "date_livraison",
        F.year("date_commande").alias("annee_commande"),
        "code_client",
        "statut",
        "qte_commandee",
        delivered.alias("qte_livree"),
        (F.col("qte_commandee") - delivered).alias("qte_ouverte"),
        F.datediff("date_livraison", "date_commande").alias("delai_jours"),
        "montant_ht",
    )


def orders_with_publisher(orders: DataFrame, books: DataFrame) -> DataFrame:
    """The order fact with the publisher of the book, by which it is laid out; an unknown book has none."""
    return join_dimension(orders, books.select("isbn", "code_editeur"), ["isbn"], "left")


def book_authors(bridge: DataFrame, authors: DataFrame) -> DataFrame:
    """Book-author pairs with role, order and the author's name; a pair without author record stays, unnamed."""
    names = authors.select("code_auteur", "nom_complet")
    return join_dimension(bridge, names, ["code_auteur"], "left").select(
        "isbn", "code_auteur", "role", "ordre", F.coalesce("nom_complet", F.lit("Inconnu")).alias("nom_complet")
    )


def lead_authors(pairs: DataFrame) -> DataFrame:
    """Per book and role the first-named author and the number of authors; no list is gathered."""
    first = F.min(F.struct("ordre", "code_auteur", "nom_complet"))
    return (
        pairs.groupBy("isbn", "role")
        .agg(first.alias("_first"), F.count("*").alias("nb_auteurs"))
        .select("isbn", "role", "_first.code_auteur", "_first.nom_complet", "nb_auteurs")
    )


def named_leads(bridge: DataFrame, authors: DataFrame) -> DataFrame:
    """`lead_authors` with the names put in last: only the first-named authors meet the author dimension, not all pairs."""
    first = F.min(F.struct("ordre", "code_auteur"))
    leads = bridge.groupBy("isbn", "role").agg(first.alias("_first"), F.count("*").alias("nb_auteurs"))
    leads = leads.select("isbn", "role", "_first.code_auteur", "nb_auteurs")
    return join_dimension(leads, authors.select("code_auteur", "nom_complet"), ["code_auteur"], "left").select(
        "isbn", "role", "code_auteur", F.coalesce("nom_complet", F.lit("Inconnu")).alias("nom_complet"), "nb_auteurs"
    )


# Lookup table, code column and label column per coded column of a fact or dimension.
CODED = {
    "canal": ("ref_canaux", "libelle_canal"),
    "format": ("ref_formats", "libelle_format"),
    "statut": ("ref_statuts", "libelle_statut"),
    "code_entrepot": ("ref_entrepots", "libelle_entrepot"),
}


def resolve_codes(df: DataFrame, lookups: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """Labels of several coded columns from the lookup tables, which win over the fixed labels."""
    out = df
    for column in columns:
        lookup, label = CODED[column]
        out = resolve_code(out, lookups[lookup], column, label)
    return out


