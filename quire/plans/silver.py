"""Silver: every source table trimmed, typed, renamed and, where it has a natural key, deduplicated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import isbn13_valid, movement_label, stock_total
from quire.model import table
from quire.operators.clean import clean, computed_once
from quire.operators.dedupe import keep_latest

# Columns that a cleaned table does not pass on.
DROPPED = {"auteurs": ("email",), "ventes": ("statut",)}
# Tables deduplicated on their key. Sales and stock stay as delivered: the gate reports their repeats.
DEDUPED = (
    "editeurs", "auteurs", "ouvrages", "collections", "ouvrages_auteurs", "commandes", "contrats",
    "ref_canaux", "ref_formats", "ref_statuts", "ref_entrepots",
)


def _added(name: str, df: DataFrame) -> DataFrame:
    if name == "ouvrages":
        return computed_once(df, isbn_valide=isbn13_valid("isbn"))
    if name == "ventes":
        labelled = df.withColumn("type_mouvement", movement_label("statut"))
        return computed_once(labelled, isbn_valide=isbn13_valid("isbn"))
    if name == "stocks":
        return df.withColumn(
            "qte_totale", stock_total("qte_disponible", "qte_reservee", "qte_transit")
        )
    return df


def silver(name: str, bronze: DataFrame) -> DataFrame:
    """The cleaned form of one source table."""
    declared = table(name)
    cleaned = clean(bronze, declared)
    if declared.name in DEDUPED:
        # Derived columns follow the deduplication: they are computed for surviving rows only.
        cleaned = keep_latest(cleaned, list(declared.keys), declared.newest_by)
    return _added(declared.name, cleaned).drop(*DROPPED.get(declared.name, ()))


def excluded_rows(df: DataFrame) -> DataFrame:
    """Rows that gold leaves out for their ISBN."""
    return df.filter(~F.col("isbn_valide"))
