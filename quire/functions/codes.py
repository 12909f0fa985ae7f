"""Code labels, bands and derived columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.columns import ColumnOrName, as_column

# Labels of the coded columns.
MOVEMENT_LABELS = {"V": "Vente", "R": "Retour", "A": "Avoir"}
FORMAT_LABELS = {
    "GFT": "Grand format",
    "POC": "Poche",
    "NUM": "Numérique",
    "AUD": "Audio",
    "BDA": "BD / Album",
}
STATUS_LABELS = {"AC": "Actif", "EP": "Épuisé", "AN": "Annoncé", "PI": "Pilonné"}
UNKNOWN_MOVEMENT = "Inconnu"
OTHER_LABEL = "Autre"

# Upper bounds (exclusive) of the price bands and the label above the last one.
PRICE_BANDS = ((10, "< 10 €"), (20, "10-20 €"), (30, "20-30 €"))
TOP_PRICE_BAND = "≥ 30 €"


def label(code: ColumnOrName, labels: dict[str, str], otherwise: str) -> Column:
    """Label of a code from a small fixed mapping, compiled to a CASE."""
    c = as_column(code)
    chain = F
    for key, text in labels.items():
        chain = chain.when(c == key, text)
    return chain.otherwise(otherwise)


def movement_label(code: ColumnOrName) -> Column:
    return label(code, MOVEMENT_LABELS, UNKNOWN_MOVEMENT)


def format_label(code: ColumnOrName) -> Column:
    return label(code, FORMAT_LABELS, OTHER_LABEL)


def status_label(code: ColumnOrName) -> Column:
    return label(code, STATUS_LABELS, OTHER_LABEL)


def price_band(price: ColumnOrName) -> Column:
    """Half-open price bands; no price, no band."""
    p = as_column(price)
    chain = F.when(p.isNull(), F.lit(None).cast("string"))
    for bound, text in PRICE_BANDS:
        chain = chain.when(p < bound, text)
    return chain.otherwise(TOP_PRICE_BAND)


def display_name(pseudonym: ColumnOrName, first: ColumnOrName, last: ColumnOrName) -> Column:
    """Pseudonym if there is one (a blank one is none), else first and last name."""
    pseudo = F.nullif(F.trim(as_column(pseudonym)), F.lit(""))
    return F.coalesce(pseudo, F.concat_ws(" ", as_column(first), as_column(last)))


def is_missing(value: ColumnOrName) -> Column:
    """Null test as a flag, e.g. alive when no date of death is known."""
    return as_column(value).isNull()


def stock_total(available: ColumnOrName, reserved: ColumnOrName, transit: ColumnOrName) -> Column:
    """Usable stock; a missing part counts as its default of zero, destroyed copies are left out."""
    parts = [F.coalesce(as_column(c), F.lit(0)) for c in (available, reserved, transit)]
    return parts[0] + parts[1] + parts[2]
