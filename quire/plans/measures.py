"""Report queries on the star schema.

Every measure that needs a dimension is first summed to the join key, so a book that holds a third of
the sales reaches the join as a few rows.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import reduce
from math import inf

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.columns import as_column
from quire.operators.joins import HOT_ROWS, join_dimension
from quire.session import discard, stored_once

CENT = Decimal("0.01")
AUTHOR = "AUT"
MONEY = "decimal(28,2)"
SHARE = "decimal(9,6)"
UNKNOWN = "Inconnu"
# Parts that authors are dealt into for royalties, and rows of contracts and book-author pairs in a part until there are so many parts.
SLICES, SLICE_ROWS = 8, 900_000


def cents(value: Column) -> Column:
    """Money as a whole number of cents."""
    return (value * 100).cast("bigint")


def from_cents(value: Column) -> Column:
    return (F.coalesce(value, F.lit(0)).cast("decimal(20,0)") * F.lit(CENT)).cast(MONEY)


def total(column: str | Column, type_name: str = MONEY) -> Column:
    """Sum with NULL as zero. Money is summed as whole cents: a long sum takes half the time of a wide
    decimal one, and it fails rather than wraps should a total ever pass 9.2e16."""
    value = as_column(column)
    if type_name != MONEY:
        return F.coalesce(F.sum(value), F.lit(0)).cast(type_name)
    return from_cents(F.sum(cents(value)))


def net_sales(sales: DataFrame) -> DataFrame:
    """Movements, copies and amounts per movement type; returns are negative, so the sum of rows is net."""
    return sales.groupBy("type_mouvement").agg(
        F.count("*").alias("nb_mouvements"),
        total("quantite", "bigint").alias("quantite"),
        total("montant_ht").alias("montant_ht"),
        total("montant_ttc").alias("montant_ttc"),
    )


def sales_by_book_day_channel(sales: DataFrame) -> DataFrame:
    return sales.groupBy("isbn", "date_vente", "canal").agg(
        total("quantite", "bigint").alias("quantite"),
        total("montant_ht").alias("montant_ht"),
        total("montant_ttc").alias("montant_ttc"),
    )


def sales_by_month(sales: DataFrame) -> DataFrame:
    return sales.groupBy("annee_vente", "mois_vente").agg(
        F.count("*").alias("nb_mouvements"),
        total("quantite", "bigint").alias("quantite"),
        total("montant_ttc").alias("montant_ttc"),
    )


def _per_book(sales: DataFrame, *more: str) -> DataFrame:
    return sales.groupBy("isbn", *more).agg(
        total("quantite", "bigint").alias("quantite"), total("montant_ttc").alias("montant_ttc")
    )


def share_by_format(sales: DataFrame, books: DataFrame) -> DataFrame:
    """Revenue per format and its share of all revenue; books that the dimension lacks have an unknown format.

    The window runs over the handful of formats, after both aggregates.
    """
    formats = books.select("isbn", "libelle_format")
    by_format = (
        _per_book(sales)
        .join(formats, "isbn", "left")
        .groupBy(F.coalesce("libelle_format", F.lit(UNKNOWN)).alias("libelle_format"))
        .agg(total("montant_ttc").alias("montant_ttc"))
    )
    everything = F.sum("montant_ttc").over(Window.partitionBy())
    return by_format.withColumn(
        "part", (F.col("montant_ttc") / F.nullif(everything, F.lit(0))).cast(SHARE)
    )


def _written(bridge: DataFrame, role: str) -> DataFrame:
    """Book-author pairs of one role. In joins they are the large side: a book may have very many."""
    return bridge.filter(F.col("role") == role).select("isbn", "code_auteur").distinct()


def revenue_by_author(sales: DataFrame, bridge: DataFrame, role: str = AUTHOR) -> DataFrame:
    """Revenue per author over the books they wrote."""
    return (
        join_dimension(_written(bridge, role), _per_book(sales), ["isbn"])
        .groupBy("code_auteur")
        .agg(total("quantite", "bigint").alias("quantite"), total("montant_ttc").alias("montant_ttc"))
    )


def top_authors(sales: DataFrame, bridge: DataFrame, authors: DataFrame, k: int = 10) -> DataFrame:
    """The k best-selling authors; the code settles equal revenue."""
    best = revenue_by_author(sales, bridge).orderBy(F.desc("montant_ttc"), "code_auteur").limit(k)
    return best.join(authors.select("code_auteur", "nom_complet"), "code_auteur", "left").select(
        "code_auteur", F.coalesce("nom_complet", F.lit(UNKNOWN)).alias("nom_complet"), "quantite", "montant_ttc"
    )


def sales_by_publisher_author_month(
    sales: DataFrame, books: DataFrame, publishers: DataFrame, leads: DataFrame
) -> DataFrame:
    """Star report: revenue per publisher, lead author and month.

    With the lead author of `gold.lead_authors` each sale counts once. No sale is lost: a book, author or
    publisher that the dimensions lack shows as unknown, so the report adds up to the fact.
    """
    first = leads.filter(F.col("role") == AUTHOR).select("isbn", "code_auteur", "nom_complet")
    summed = (
        _per_book(sales, "annee_vente", "mois_vente")
        .join(books.select("isbn", "code_editeur"), "isbn", "left")
        .join(first, "isbn", "left")
        .groupBy("code_editeur", "code_auteur", "nom_complet", "annee_vente", "mois_vente")
        .agg(total("montant_ttc").alias("montant_ttc"))
    )
    return join_dimension(summed, publishers.select("code_editeur", "nom_editeur"), ["code_editeur"], "left").select(
        "code_editeur",
        F.coalesce("nom_editeur", F.lit(UNKNOWN)).alias("nom_editeur"),
        "code_auteur",
        F.coalesce("nom_complet", F.lit(UNKNOWN)).alias("nom_complet"),
        "annee_vente",
        "mois_vente",
        "montant_ttc",
    )


def sales_filtered(
    sales: DataFrame,
    books: DataFrame,
    publisher: str | None = None,
    year: int | None = None,
    isbn: str | None = None,
) -> DataFrame:
    """Monthly sales of the books that a report filter names. Filters come before the aggregate."""
    if year is not None:
        # On the date itself, so that files can be skipped.
        first, last = dt.date(year, 1, 1), dt.date(year, 12, 31)
        sales = sales.filter(F.col("date_vente").between(F.lit(first), F.lit(last)))
    if isbn is not None:
        sales = sales.filter(F.col("isbn") == isbn)
    summed = _per_book(sales, "annee_vente", "mois_vente")
    if publisher is not None:
        chosen = books.filter(F.col("code_editeur") == publisher).select("isbn")
        summed = summed.join(chosen, "isbn", "left_semi")
    return summed.groupBy("annee_vente", "mois_vente").agg(
        total("quantite", "bigint").alias("quantite"), total("montant_ttc").alias("montant_ttc")
    )


def author_totals(sales: DataFrame, bridge: DataFrame) -> DataFrame:
    """Revenue per author and year beside the author's total over all years.

    Sums per author and year are taken first, so the window holds one row per year.
    """
    yearly = (
        join_dimension(_written(bridge, AUTHOR), _per_book(sales, "annee_vente"), ["isbn"])
        .groupBy("code_auteur", "annee_vente")
        .agg(total("montant_ttc").alias("montant_ttc"))
    )
    whole = F.sum("montant_ttc").over(Window.partitionBy("code_auteur")).cast(MONEY)
    return yearly.withColumn("total_auteur", whole)


def order_fill(orders: DataFrame) -> DataFrame:
    """Per status: ordered, delivered and open copies, fill rate, mean lead time."""
    summed = orders.groupBy("statut").agg(
        F.count("*").alias("nb_commandes"),
        total("qte_commandee", "bigint").alias("qte_commandee"),
        total("qte_livree", "bigint").alias("qte_livree"),
        F.count("delai_jours").alias("_timed"),
        F.coalesce(F.sum("delai_jours"), F.lit(0)).alias("_days"),
    )
    rate = F.col("qte_livree").cast("double") / F.nullif(F.col("qte_commandee"), F.lit(0))
    lead = F.col("_days").cast("double") / F.nullif(F.col("_timed"), F.lit(0))
    return summed.select(
        "statut",
        "nb_commandes",
        "qte_commandee",
        "qte_livree",
        (F.col("qte_commandee") - F.col("qte_livree")).alias("qte_ouverte"),
        rate.cast(SHARE).alias("taux_service"),
        lead.cast("decimal(12,4)").alias("delai_moyen"),
    )


def stock_by_site(stock: DataFrame) -> DataFrame:
    return stock.groupBy("code_entrepot", "date_position").agg(
        F.count("*").alias("nb_positions"),
        total("qte_disponible", "bigint").alias("qte_disponible"),
        total("qte_reservee", "bigint").alias("qte_reservee"),
        total("qte_transit", "bigint").alias("qte_transit"),
        total("qte_pilonnee", "bigint").alias("qte_pilonnee"),
        total("qte_totale", "bigint").alias("qte_totale"),
    )


def in_force(terms: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, num_contrat, _from, _until): by key the contract that counts on each day; the spans of a key do not overlap.

    A span goes from a day on which a term begins or has ended to the next such day, `_until` being the first day after it and NULL for
    ever. Of several contracts in term the latest by (_for_title, date_debut, num_contrat) counts. A NULL key is a key.
    """
    ended = terms.where("date_fin is not null").select(*keys, F.date_add("date_fin", 1).alias("_from"))
    days = terms.select(*keys, F.col("date_debut").alias("_from")).unionByName(ended).distinct()
    until = F.lead("_from").over(Window.partitionBy(*keys).orderBy("_from")).alias("_until")
    spans = days.select(*[F.col(k).alias(f"_s_{k}") for k in keys], "_from", until)
    open_ = (F.col("date_debut") <= F.col("_from")) & (F.col("date_fin").isNull() | (F.col("date_fin") >= F.col("_from")))
    for k in keys:
        open_ = open_ & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
    best = F.max(F.struct("_for_title", "date_debut", "num_contrat")).alias("_best")
    return terms.join(spans, open_).groupBy(*keys, "_from", "_until").agg(best).select(*keys, "_best.num_contrat", "_from", "_until")


def _earning(sales: DataFrame, contracts: DataFrame, bridge: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What `earnings` matches, stored: net HT sales by book and day, contracts with a term, and book-author pairs; of books with sales only."""
    # The bridge has shuffles of its own, whose files go before others come.
    pairs = stored_once(bridge.select("isbn", "code_auteur"), "book-authors")
    daily = sales.filter(F.col("date_vente").isNotNull()).groupBy("isbn", "date_vente").agg(F.sum(cents(F.col("montant_ht"))).alias("_cents"))
    # Side by side, the days of a book take half the room, here and in each shuffle to come.
    daily = stored_once(daily.repartition("isbn").sortWithinPartitions("isbn", "date_vente"), "daily-sales")
    in_term = F.col("date_debut").isNotNull() & (F.col("date_fin").isNull() | (F.col("date_fin") >= F.col("date_debut")))
    isbn = F.nullif("isbn", F.lit(""))
    terms = contracts.where(in_term).select("num_contrat", "code_auteur", isbn.alias("isbn"), "date_debut", "date_fin", F.when(isbn.isNull(), 0).otherwise(1).alias("_for_title"))
    sold = stored_once(daily.select("isbn").distinct(), "sold-books")
    titled = terms.where("isbn is not null").join(sold, "isbn", "left_semi").select(terms.columns)
    terms = stored_once(titled.unionByName(terms.where("isbn is null")), "contract-terms")
    wrote = stored_once(pairs.distinct().join(sold, "isbn", "left_semi"), "written-books")
    discard(pairs, sold)
    return daily, terms, wrote


def _matched(daily: DataFrame, terms: DataFrame, wrote: DataFrame, limit: float | None = None) -> DataFrame:
    """The result of `earnings` from its parts; limit: as in `join_dimension`, for the authors' contracts."""
    titled, untitled = terms.where("isbn is not null"), terms.where("isbn is null")
    for_title = titled.select("isbn", "code_auteur").distinct()
    both = wrote.join(for_title, ["isbn", "code_auteur"], "left_semi").join(untitled.drop("isbn"), "code_auteur").select(terms.columns)
    # An author of very many books is split.
    anywhere = join_dimension(wrote.join(for_title, ["isbn", "code_auteur"], "left_anti"), in_force(untitled, ["code_auteur"]), ["code_auteur"], limit=limit)
    spans = in_force(titled.unionByName(both), ["isbn", "code_auteur"]).unionByName(anywhere.select("isbn", "code_auteur", "num_contrat", "_from", "_until"))
    within = (F.col("date_vente") >= F.col("_from")) & (F.col("_until").isNull() | (F.col("date_vente") < F.col("_until")))
    return spans.join(daily, "isbn").where(within).select("num_contrat", "date_vente", "_cents")


def earnings(sales: DataFrame, contracts: DataFrame, bridge: DataFrame) -> DataFrame:
    """(num_contrat, date_vente, _cents): net HT sales of a book and day under the contract that they fall to.

    A sale counts once per author of the book: under the author's contract for the title if one is in
    term on that day, else under a contract without title; among several the latest start and then the
    highest number. The status does not matter inside the term, and a term without end stays open.

    The choice among contracts is made before any sale is met: by author for contracts without title, by book and author where there is
    one for the title. So a book, author and day meet one contract, and what comes out needs no further grouping. Sales are summed to book
    and day before; a book has a row a day at most.
    """
    return _matched(*_earning(sales, contracts, bridge))


def _earned(sales: DataFrame, contracts: DataFrame, bridge: DataFrame, *keys: str | Column) -> DataFrame:
    """Sums of `earnings` by contract and whatever else is among the keys.

    Books have many authors and authors many books, so what meets is many times the sales. All choices are an author's: the authors go
    through in up to SLICES parts, one after the other, and each leaves its sums only.
    """
    daily, terms, wrote = parts = _earning(sales, contracts, bridge)
    slices = min(SLICES, 1 + (terms.count() + wrote.count()) // SLICE_ROWS)
    # Authors are counted once, not in every part.
    busy = wrote.groupBy("code_auteur").agg(F.count("*").alias("_rows")).where(F.col("_rows") > HOT_ROWS)
    limit = inf if busy.isEmpty() else None
    sums = []
    for number in range(slices):
        own = F.pmod(F.xxhash64("code_auteur"), F.lit(slices)) == number
        matched = _matched(daily, terms.where(own), wrote.where(own), limit)
        sums.append(stored_once(matched.groupBy(*keys).agg(F.sum("_cents").alias("_cents")), "earned"))
    discard(*parts)
    whole = reduce(DataFrame.unionByName, sums)
    # A number may be that of several authors' contracts.
    return whole.groupBy([c for c in whole.columns if c != "_cents"]).agg(F.sum("_cents").alias("_cents"))


def _rated(contracts: DataFrame) -> DataFrame:
    """The contracts, stored: their terms are asked for first, their rates and advances last."""
    return stored_once(contracts.select("num_contrat", "code_auteur", "isbn", "date_debut", "date_fin", "pct_droits", "avance"), "contracts")


def _due(base: Column) -> Column:
    return F.round(base * F.col("pct_droits") / 100, 2).cast(MONEY)


def royalties(sales: DataFrame, contracts: DataFrame, bridge: DataFrame) -> DataFrame:
    """What each contract earned over its life: net HT sales in its term times its rate, against the advance."""
    contracts = _rated(contracts)
    earned = _earned(sales, contracts, bridge, "num_contrat")
    base = from_cents(F.col("_cents"))
    owed = contracts.join(earned, "num_contrat", "left").select(
        "num_contrat",
        "code_auteur",
        base.alias("base_ht"),
        _due(base).alias("droits_dus"),
        F.coalesce("avance", F.lit(0)).cast(MONEY).alias("avance"),
    )
    payable = F.greatest(F.col("droits_dus") - F.col("avance"), F.lit(0)).cast(MONEY)
    return owed.withColumn("droits_a_payer", payable)


PERIODS = {"annee": "year", "trimestre": "quarter", "mois": "month"}


def royalty_ledger(sales: DataFrame, contracts: DataFrame, bridge: DataFrame, period: str = "annee") -> DataFrame:
    """Royalties by contract and period with sales: due, set off against the advance, to pay, and the advance left.

    Each amount is the difference of two running totals, so the periods of a contract add up to its row in `royalties` to the
    cent, and the advance is set off once. A period in which returns outweigh sales has negative amounts. `periode` is
    the period's first day. Sums are per contract and period before the window, which holds a contract's periods.
    """
    contracts = _rated(contracts)
    earned = _earned(sales, contracts, bridge, "num_contrat", F.trunc("date_vente", PERIODS[period]).alias("periode"))
    terms = contracts.select("num_contrat", "code_auteur", "pct_droits", F.coalesce("avance", F.lit(0)).cast(MONEY).alias("avance"))
    up_to = Window.partitionBy("num_contrat").orderBy("periode").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_order = Window.partitionBy("num_contrat").orderBy("periode")
    running = earned.join(terms, "num_contrat").withColumn("_base", from_cents(F.sum("_cents").over(up_to)))
    running = running.withColumn("droits_cumules", _due(F.col("_base")))
    running = running.withColumns({
        "_set_off": F.least(F.greatest(F.col("droits_cumules"), F.lit(0)), F.col("avance")).cast(MONEY),
        "_paid": F.greatest(F.col("droits_cumules") - F.col("avance"), F.lit(0)).cast(MONEY),
    })

    def gained(column: str) -> Column:
        return (F.col(column) - F.coalesce(F.lag(column).over(in_order), F.lit(0))).cast(MONEY)

    return running.select(
        "num_contrat", "code_auteur", "periode", from_cents(F.col("_cents")).alias("base_ht"),
        gained("droits_cumules").alias("droits_dus"), "droits_cumules", gained("_set_off").alias("avance_imputee"),
        (F.col("avance") - F.col("_set_off")).cast(MONEY).alias("avance_restante"), gained("_paid").alias("droits_a_payer"),
    )
