"""The quality gate: every check is one or more rows of a report DataFrame.

Report columns: check, status (PASS, WARN, FAIL), measured, threshold, detail. A check that finds
nothing still reports. Everything stays lazy; a run of the gate is one query.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import ACCENTS, isbn13_has_shape
from quire.functions.dates import cyymmdd_to_date
from quire.functions.text import DAMAGE
from quire.model import table
from quire.model.fields import SourceTable
from quire.operators.joins import orphan_keys
from quire.plans.measures import MONEY, total
from quire.plans.recon import total_if, union_all

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
MEASURE = "decimal(18,6)"
ANY_MEASURE = "decimal(38,6)"  # counts and money


@dataclass(frozen=True)
class Limits:
    """Percentages; the defaults are the preset of the stage-by-stage gate."""

    row_loss: float = 1.0
    bad_isbn: float = 5.0
    null_dates: float = 2.0
    amount_gap: float = 0.01
    null_warn: float = 5.0
    null_fail: float = 20.0
    first_year: int = 1900
    last_year: int = 2030


STAGE_LIMITS = Limits()
STRICT_LIMITS = Limits(row_loss=0.1, bad_isbn=1.0)


def percent(part: Column, whole: Column) -> Column:
    """Percentage with an empty whole as zero."""
    return F.coalesce(
        part.cast("double") * 100 / F.nullif(whole, F.lit(0)).cast("double"), F.lit(0.0)
    )


def entry(check: Column | str, status: Column, measured: Column, threshold: float, detail: Column) -> Column:
    """One report row as a struct."""
    return F.struct(
        (F.lit(check) if isinstance(check, str) else check).alias("check"),
        status.alias("status"),
        measured.cast(MEASURE).alias("measured"),
        F.lit(threshold).cast(MEASURE).alias("threshold"),
        detail.alias("detail"),
    )


def report(measured: DataFrame, *entries: Column) -> DataFrame:
    return measured.select(F.inline(F.array(*entries)))


def fail_above(value: Column, limit: float, otherwise: str | Column = PASS) -> Column:
    rest = F.lit(otherwise) if isinstance(otherwise, str) else otherwise
    return F.when(value > limit, FAIL).otherwise(rest)


def counted(*parts: tuple[str, Column]) -> Column:
    """`name=value` texts; a missing count shows as such."""
    return F.concat_ws(
        " ",
        *[
            F.concat(F.lit(f"{name}="), F.coalesce(value.cast("string"), F.lit("missing")))
            for name, value in parts
        ],
    )


class Scans:
    """What checks ask of tables: all measures of a table come from one aggregate over one scan."""

    def __init__(self) -> None:
        self._tables: dict[int, tuple[DataFrame, list[tuple[str, Column, str]]]] = {}
        self._count = 0

    def of(self, df: DataFrame | None, measure: Column, kind: str = "bigint") -> Column:
        """The measure's value in the row of all measures; NULL for an absent table."""
        if df is None:
            return F.lit(None).cast(kind)
        name = f"_m{self._count}"
        self._count += 1
        self._tables.setdefault(id(df), (df, []))[1].append((name, measure, kind))
        return F.col(name)

    def report(self, entries: list[Column]) -> DataFrame:
        if not self._tables:
            return report(SparkSession.active().range(1), *entries)
        parts, values = [], []
        for df, asked in self._tables.values():
            row = df.agg(*[measure.cast(ANY_MEASURE).alias(name) for name, measure, _ in asked])
            named = [F.struct(F.lit(name).alias("name"), F.col(name).alias("value")) for name, *_ in asked]
            parts.append(row.select(F.inline(F.array(*named))))
            values += [F.max(F.when(F.col("name") == name, F.col("value"))).cast(kind).alias(name) for name, _, kind in asked]
        return report(union_all(parts).agg(*values), *entries)


def _alone(ask: Callable[[Scans], list[Column]]) -> DataFrame:
    scans = Scans()
    return scans.report(ask(scans))


# Completeness ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Layers:
    """One entity in its three layers; None for a table that is not there."""

    name: str
    bronze: DataFrame | None
    silver: DataFrame | None
    gold: DataFrame | None
    filtered_by_design: bool = False


def completeness(layers: list[Layers], limits: Limits = STAGE_LIMITS) -> DataFrame:
    """Losses between layers: FAIL into silver, WARN into gold unless gold filters by design."""
    return _alone(lambda scans: [_complete(scans, entity, limits) for entity in layers])


def _complete(scans: Scans, entity: Layers, limits: Limits) -> Column:
    b, s, g = (scans.of(df, F.count("*")) for df in (entity.bronze, entity.silver, entity.gold))
    lost_silver, lost_gold = percent(b - s, b), percent(s - g, s)
    missing = b.isNull() | s.isNull() | g.isNull()
    status = (
        F.when(missing, FAIL)
        .when(lost_silver > limits.row_loss, FAIL)
        .when((lost_gold > limits.row_loss) & F.lit(not entity.filtered_by_design), WARN)
        .otherwise(PASS)
    )
    measured = F.when(missing, F.lit(100.0)).otherwise(F.greatest(lost_silver, lost_gold))
    detail = counted(("bronze", b), ("silver", s), ("gold", g))
    return entry(f"completeness {entity.name}", status, measured, limits.row_loss, detail)


def row_loss(name: str, bronze: DataFrame, silver: DataFrame, limits: Limits = STRICT_LIMITS) -> DataFrame:
    """Rows lost by cleaning, against the strict limit."""
    return _alone(lambda scans: _row_loss(scans, name, bronze, silver, limits))


def _row_loss(scans: Scans, name: str, bronze: DataFrame, silver: DataFrame, limits: Limits) -> list[Column]:
    b, s = (scans.of(df, F.count("*")) for df in (bronze, silver))
    loss = percent(b - s, b)
    status = fail_above(loss, limits.row_loss)
    return [entry(f"row_loss {name}", status, loss, limits.row_loss, counted(("bronze", b), ("silver", s)))]


def null_ratio(name: str, df: DataFrame, limits: Limits = STAGE_LIMITS) -> DataFrame:
    """Share of NULLs of every column, measured in one aggregate."""
    return _alone(lambda scans: _null_ratio(scans, name, df, limits))


def _null_ratio(scans: Scans, name: str, df: DataFrame, limits: Limits) -> list[Column]:
    rows, entries = scans.of(df, F.count("*")), []
    for c in df.columns:
        nulls = rows - scans.of(df, F.count(c))
        ratio = percent(nulls, rows)
        status = fail_above(ratio, limits.null_fail, F.when(ratio > limits.null_warn, WARN).otherwise(PASS))
        entries.append(entry(f"nulls {name}.{c}", status, ratio, limits.null_warn, counted(("nulls", nulls), ("rows", rows))))
    return entries


def unreadable_measures(table: SourceTable) -> dict[str, Column]:
    """For each column of numbers or coded dates, how many values cleaning turns into NULL.

    An absent value or a date code of zero is no loss. The columns can be observed while a delivery is written.
    """
    measures = {}
    for f in (f for f in table.fields if f.kind != "char"):
        given = F.col(f.source)
        if f.kind == "cyymmdd":
            lost = given.isNotNull() & F.coalesce(given.try_cast("bigint") != 0, F.lit(True)) & cyymmdd_to_date(f.source).isNull()
        else:
            lost = given.isNotNull() & given.try_cast(f.raw_type).isNull()
        measures[f.source] = F.count_if(lost)
    return measures


def unreadable(name: str, delivered: DataFrame, table: SourceTable) -> DataFrame:
    """Values that cleaning turns into NULL: numbers that do not fit their type FAIL, codes that are no day WARN."""
    lost = [measure.alias(column) for column, measure in unreadable_measures(table).items()]
    return unreadable_report(name, delivered.agg(F.count("*").alias("_rows"), *lost), table)


def unreadable_report(name: str, measured: DataFrame, table: SourceTable) -> DataFrame:
    """The same from one row of counts: `_rows` and one column for each column measured."""
    entries = []
    for f in (f for f in table.fields if f.kind != "char"):
        lost = F.col(f.source)
        status = F.when(lost == 0, PASS).otherwise(WARN if f.kind == "cyymmdd" else FAIL)
        entries.append(entry(f"unreadable {name}.{f.source}", status, lost, 0, counted(("unreadable", lost), ("rows", F.col("_rows")))))
    return report(measured, *entries)


# Books: ISBN and dates ---------------------------------------------------------------------------


def isbn_checksum(name: str, df: DataFrame, limits: Limits = STAGE_LIMITS) -> DataFrame:
    """Checksums: FAIL above the limit, WARN for any bad one."""
    return _alone(lambda scans: _isbn_checksum(scans, name, df, limits))


def _isbn_checksum(scans: Scans, name: str, df: DataFrame, limits: Limits) -> list[Column]:
    bad = scans.of(df, F.count_if(~F.coalesce(F.col("isbn_valide"), F.lit(False))))
    rows = scans.of(df, F.count("*"))
    rate = percent(bad, rows)
    status = fail_above(rate, limits.bad_isbn, F.when(bad > 0, WARN).otherwise(PASS))
    return [entry(f"isbn checksum {name}", status, rate, limits.bad_isbn, counted(("invalid", bad), ("rows", rows)))]


def isbn_shape(name: str, df: DataFrame, column: str = "isbn", limits: Limits = STRICT_LIMITS) -> DataFrame:
    """Shape of the ISBNs; a NULL is a bad one."""
    return _alone(lambda scans: _isbn_shape(scans, name, df, column, limits))


def _isbn_shape(scans: Scans, name: str, df: DataFrame, column: str, limits: Limits) -> list[Column]:
    bad, rows = scans.of(df, F.count_if(~isbn13_has_shape(column))), scans.of(df, F.count("*"))
    rate = percent(bad, rows)
    status = fail_above(rate, limits.bad_isbn)
    return [entry(f"isbn shape {name}", status, rate, limits.bad_isbn, counted(("invalid", bad), ("rows", rows)))]


def dates(name: str, df: DataFrame, column: str, limits: Limits = STAGE_LIMITS) -> DataFrame:
    """Decoded dates: any outside the plausible years FAIL, too many NULLs WARN."""
    return _alone(lambda scans: _dates(scans, name, df, column, limits))


def _dates(scans: Scans, name: str, df: DataFrame, column: str, limits: Limits) -> list[Column]:
    outside = scans.of(df, F.count_if(~F.year(column).between(limits.first_year, limits.last_year)))
    nulls, rows = scans.of(df, F.count_if(F.col(column).isNull())), scans.of(df, F.count("*"))
    rate = percent(nulls, rows)
    return [
        entry(f"date range {name}.{column}", fail_above(outside, 0), outside, 0, counted(("outside", outside), ("rows", rows))),
        entry(f"date nulls {name}.{column}", F.when(rate > limits.null_dates, WARN).otherwise(PASS), rate,
              limits.null_dates, counted(("nulls", nulls), ("rows", rows))),
    ]


# Expected values ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Expected:
    """A row picked by `where` must exist and all such rows must meet `holds`."""

    check: str
    where: str
    holds: str
    otherwise: str = FAIL


def expected_values(df: DataFrame, expected: list[Expected]) -> DataFrame:
    """Known values, all measured in one pass; a row that is not there does not pass."""
    return _alone(lambda scans: _expected_values(scans, df, expected))


def _expected_values(scans: Scans, df: DataFrame, expected: list[Expected]) -> list[Column]:
    entries = []
    for e in expected:
        picked = F.coalesce(F.expr(e.where), F.lit(False))
        rows = scans.of(df, F.count_if(picked))
        good = scans.of(df, F.count_if(picked & F.coalesce(F.expr(e.holds), F.lit(False))))
        status = F.when((rows > 0) & (rows == good), PASS).otherwise(e.otherwise)
        entries.append(entry(e.check, status, rows - good, 0, counted(("rows", rows), ("as expected", good))))
    return entries


# Amounts -----------------------------------------------------------------------------------------


def amounts(bronze: DataFrame, silver: DataFrame, gold: DataFrame, limits: Limits = STAGE_LIMITS) -> DataFrame:
    """Cleaning must not move the total; gold must differ by exactly the excluded rows."""
    return _alone(lambda scans: _amounts(scans, bronze, silver, gold, limits))


def _amounts(scans: Scans, bronze: DataFrame, silver: DataFrame, gold: DataFrame, limits: Limits) -> list[Column]:
    left_out = ~F.coalesce(F.col("isbn_valide"), F.lit(False))
    b = scans.of(bronze, total("VEMTTTC"), MONEY)
    s = scans.of(silver, total("montant_ttc"), MONEY)
    x = scans.of(silver, total_if(left_out, "montant_ttc"), MONEY)
    g = scans.of(gold, total("montant_ttc"), MONEY)
    lost, unexplained = F.abs(b - s), F.abs(s - g - x)
    # Against a total of zero any difference is a whole one.
    gap = F.when((b == 0) & (lost > 0), F.lit(100.0)).otherwise(percent(lost, F.abs(b)))
    return [
        entry("amounts bronze to silver", fail_above(gap, limits.amount_gap), gap, limits.amount_gap, counted(("bronze", b), ("silver", s))),
        entry("amounts silver to gold", fail_above(unexplained, 0), unexplained, 0, counted(("silver", s), ("gold", g), ("excluded", x))),
    ]


# Accents -----------------------------------------------------------------------------------------


def accent_audit(name: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that hold each audited character, and rows with signs of damage, from one scan."""
    sought = {**ACCENTS, **DAMAGE}
    text = F.concat_ws(" ", *columns)
    held = df.select(text.alias("_text")).agg(
        *[F.count_if(F.col("_text").contains(c)).alias(f"_n{i}") for i, c in enumerate(sought)]
    )
    entries = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(character).alias("character"),
            F.lit(meaning).alias("meaning"),
            F.lit(character in DAMAGE).alias("is_damage"),
            F.col(f"_n{i}").alias("row_count"),
        )
        for i, (character, meaning) in enumerate(sought.items())
    ]
    return report(held, *entries)


def accents(audits: list[DataFrame]) -> DataFrame:
    """Accented characters found over all audited tables; none at all, or any damage, is a WARN."""
    found = (
        union_all(audits)
        .groupBy("character", "is_damage")
        .agg(F.sum("row_count").alias("n"))
        .agg(
            F.count_if(~F.col("is_damage") & (F.col("n") > 0)).alias("found"),
            F.coalesce(F.sum(F.when(F.col("is_damage"), F.col("n"))), F.lit(0)).alias("damaged"),
        )
    )
    good = (F.col("found") > 0) & (F.col("damaged") == 0)
    return report(
        found,
        entry("accents", F.when(good, PASS).otherwise(WARN), F.col("found"), 1,
              counted(("characters", F.col("found")), ("damaged rows", F.col("damaged")))),
    )


def _accents(scans: Scans, audited: list[tuple[DataFrame, list[str]]]) -> list[Column]:
    """The same over tables and their columns, in the scans of the other checks."""

    def rows_with(character: str) -> Column:
        held = [scans.of(df, F.count_if(F.concat_ws(" ", *columns).contains(character))) for df, columns in audited]
        return reduce(Column.__add__, held)

    zero = F.lit(0).cast("bigint")
    found = reduce(Column.__add__, [(rows_with(c) > 0).cast("bigint") for c in ACCENTS], zero)
    damaged = reduce(Column.__add__, [rows_with(c) for c in DAMAGE], zero)
    status = F.when((found > 0) & (damaged == 0), PASS).otherwise(WARN)
    return [entry("accents", status, found, 1, counted(("characters", found), ("damaged rows", damaged)))]


# Integrity ---------------------------------------------------------------------------------------


def integrity(check: str, child: DataFrame, parent: DataFrame, on: str) -> DataFrame:
    """Rows without a parent: any is a WARN."""
    lost = orphan_keys(child, parent, on).agg(
        F.coalesce(F.sum("orphan_rows"), F.lit(0)).alias("orphans"), F.count("*").alias("keys")
    )
    return report(
        lost,
        entry(check, F.when(F.col("orphans") > 0, WARN).otherwise(PASS), F.col("orphans"), 0,
              counted(("orphan rows", F.col("orphans")), ("keys", F.col("keys")))),
    )


# Outcome -----------------------------------------------------------------------------------------


def summary(checks: DataFrame) -> DataFrame:
    """Counts by status, the global status and the decision, in one row."""
    failed = F.count_if(F.col("status") == FAIL)
    return checks.agg(
        F.count_if(F.col("status") == PASS).alias("nb_pass"),
        F.count_if(F.col("status") == WARN).alias("nb_warn"),
        failed.alias("nb_fail"),
        F.when(failed > 0, FAIL).otherwise(PASS).alias("global_status"),
        F.when(failed > 0, "HUMAN_REVIEW_REQUIRED").otherwise("GO").alias("decision"),
    )


# Rows whose decoding is known.
KNOWN_BOOKS = [
    Expected("date C=0 (19xx)", "isbn = '9782070368228'", "year(date_publication) = 1978"),
]
KNOWN_AUTHORS = [
    Expected("spanish accents", "nom LIKE '%Garc%'", "nom LIKE '%í%' AND nom LIKE '%á%'", WARN),
    Expected("acute accent", "code_auteur = 'AUT00001'", "prenom LIKE '%é%'", WARN),
]


# The gold table of each entity.
GOLD_NAMES = {
    "ouvrages": "dim_ouvrages",
    "ventes": "fact_ventes",
    "stocks": "fact_stocks",
    "editeurs": "dim_editeurs",
    "auteurs": "dim_auteurs",
}


def full_gate(
    bronze: Mapping[str, DataFrame],
    silver: Mapping[str, DataFrame],
    gold: Mapping[str, DataFrame],
    limits: Limits = STAGE_LIMITS,
    known_books: list[Expected] | None = None,
    known_authors: list[Expected] | None = None,
    delivered: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """All checks on the three layers; gold by the names dim_* and fact_*. What is absent fails its checks.

    Every table is scanned once for all checks together; only the integrity checks join. `delivered` are the tables before they
    got their types: what bronze holds no more is counted there.
    """
    layers = [
        Layers(name, bronze.get(name), silver.get(name), gold.get(gold_name), name == "ventes")
        for name, gold_name in GOLD_NAMES.items()
    ]
    books, authors, sales = (silver.get(name) for name in ("ouvrages", "auteurs", "ventes"))
    raw_sales, fact, editors = bronze.get("ventes"), gold.get("fact_ventes"), silver.get("editeurs")
    scans = Scans()

    def ask(check: str, tables: list[DataFrame | None], entries: Callable[..., list[Column]]) -> list[Column]:
        """The check's entries, or one FAIL if a table that it needs is absent."""
        if all(df is not None for df in tables):
            return entries(*tables)
        return [entry(check, F.lit(FAIL), F.lit(100.0), 0, F.lit("table missing"))]

    entries = [_complete(scans, entity, limits) for entity in layers]
    entries += ask("row_loss ventes", [raw_sales, sales], lambda b, s: _row_loss(scans, "ventes", b, s, limits))
    entries += ask("nulls auteurs", [authors], lambda df: _null_ratio(scans, "auteurs", df, limits))
    entries += ask("nulls ventes", [sales], lambda df: _null_ratio(scans, "ventes", df, limits))
    entries += ask("isbn checksum ouvrages", [books], lambda df: _isbn_checksum(scans, "ouvrages", df, limits))
    entries += ask("isbn shape ventes", [sales], lambda df: _isbn_shape(scans, "ventes", df, "isbn", limits))
    entries += ask("dates ouvrages", [books], lambda df: _dates(scans, "ouvrages", df, "date_publication", limits))
    entries += ask("amounts", [raw_sales, sales, fact], lambda b, s, g: _amounts(scans, b, s, g, limits))
    entries += ask("accents", [authors, books], lambda a, b: _accents(scans, [(a, ["nom", "prenom"]), (b, ["titre"])]))
    if known_books:
        entries += ask("known books", [books], lambda df: _expected_values(scans, df, known_books))
    if known_authors:
        entries += ask("known authors", [authors], lambda df: _expected_values(scans, df, known_authors))
    parts = []
    for check, child, parent, key in (
        ("fk ventes to ouvrages", sales, books, "isbn"),
        ("fk ouvrages to editeurs", books, editors, "code_editeur"),
    ):
        if child is not None and parent is not None:
            parts.append(integrity(check, child, parent, key))
        else:
            entries += ask(check, [None], list)
    parts += [unreadable(name, df, table(name)) for name, df in (delivered or {}).items() if unreadable_measures(table(name))]
    return union_all([scans.report(entries), *parts])
