"""Incremental runs: each reads what changed since the run before it, and rewrites only the years that this touches.

Bronze keeps every delivery as it came. Silver and gold are the state: a delivered row replaces the rows with its key. Movement tables
are kept by year; the years of a delivery, and those in which its keys stood before, are written anew, the others are taken over
as they are. All tables of a run, its marks and its manifest become visible with one commit.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quire.functions import cyymmdd_to_date
from quire.functions.columns import literal
from quire.model import table
from quire.operators.clean import to_raw
from quire.operators.merge import replace_by_key
from quire.plans import gold, measures, recon
from quire.plans.pipeline import gold_tables
from quire.plans.silver import silver
from quire.sources.commits import Commit, Commits
from quire.sources.incremental import since

# Raw change date of the tables that have one; the others are read whole in every run.
CHANGED_BY = {"ventes": "VEDTVT", "commandes": "CMDTCM", "stocks": "SKDTPS", "ouvrages": "OVDTMJ"}
# Tables kept by year, with the date that the year is taken from.
DATED = {"ventes": "date_vente", "commandes": "date_commande", "stocks": "date_position"}
FACTS = {"ventes": "fact_ventes", "commandes": "fact_commandes", "stocks": "fact_stocks"}
YEAR, NO_YEAR = "_year", -1


@dataclass(frozen=True)
class Increment:
    """What a run has committed; `years` are those it wrote anew, by silver table."""

    version: int
    delivered: dict[str, int]
    years: dict[str, list[str]]
    manifest: DataFrame


def year_of(column: str) -> Column:
    return F.coalesce(F.year(column), F.lit(NO_YEAR)).alias(YEAR)


class Run:
    """One run from the newest commit to the next."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.lake = spark, Commits(spark, root)
        self.before = self.lake.latest()
        self.tables, self.marks = dict(self.before.tables), dict(self.before.marks)
        self.delivered: dict[str, int] = {}
        self.years: dict[str, list[str]] = {}

    def known(self, name: str, parts: set[str] | None = None) -> DataFrame | None:
        return self.lake.read(Commit(0, self.tables), name, parts)

    def _point(self, name: str, df: DataFrame, folders: dict[str, str]) -> DataFrame:
        self.tables[name] = {"schema": df.schema.json(), "folders": folders}
        return self.known(name)

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """A table written whole."""
        folder = self.lake.new_folder(name)
        df.write.parquet(folder)
        return self._point(name, df, {"": folder})

    def write_years(self, name: str, df: DataFrame, date: str, touched: set[str], laid_out: bool = False) -> set[str]:
        """The touched years of a table replaced by df, which holds these years only; gives the years that df has.

        laid_out: df lies in files of one year each, so its tasks write few years without a shuffle.
        """
        folder, dated = self.lake.new_folder(name), df.withColumn(YEAR, year_of(date))
        # A heavy year is cut over as many tasks and files as its rows need, by their measured size: no sample computes df before.
        (dated if laid_out else dated.hint("rebalance", YEAR)).write.partitionBy(YEAR).parquet(folder)
        kept = {year: path for year, path in self.tables.get(name, {}).get("folders", {}).items() if year not in touched}
        written = self.lake.parts(folder, YEAR)
        self._point(name, df, {**kept, **written})
        return set(written)

    def deliver(self, name: str, source: DataFrame, full: bool) -> DataFrame:
        """Bronze: what the source holds since the last mark, stored in one read that also counts it and finds the next mark."""
        changed = None if full else CHANGED_BY.get(name)
        mark = self.marks.get(name)
        if changed and mark is not None:
            # A code of zero is no day either.
            source = source.where(since(F.col(changed), literal(mark, source.schema[changed].dataType)) | (F.col(changed) == 0))
        fresh = to_raw(source, table(name))
        seen, measured = Observation(f"delivery of {name}"), [F.count(F.lit(1)).alias("rows")]
        if name in CHANGED_BY:
            # A code that is no day, such as a month of thirteen, must not become the mark.
            code = F.col(CHANGED_BY[name])
            measured.append(F.max(F.when(cyymmdd_to_date(CHANGED_BY[name]).isNotNull(), code)).alias("mark"))
        folder = self.lake.new_folder(f"bronze_{name}")
        fresh.observe(seen, *measured).write.parquet(folder)
        found = seen.get
        self.delivered[name] = found["rows"]
        if found.get("mark") is not None:
            self.marks[name] = max(found["mark"], self.marks.get(name) or found["mark"])
        self._point(f"bronze_{name}", fresh, {**self.before.folders(f"bronze_{name}"), str(self.before.version + 1): folder})
        return self.spark.read.schema(fresh.schema).parquet(folder)

    def merge(self, name: str, batch: DataFrame, full: bool) -> set[str]:
        """Silver: the delivery put into the state; gives the years written."""
        own, keys = f"silver_{name}", list(table(name).keys)
        clean, old = silver(name, batch), None if full else self.known(own)
        if name not in DATED:
            whole = old is None or name not in CHANGED_BY
            self.write(own, clean if whole else replace_by_key(old, clean, keys))
            return set()
        if old is None:
            touched = set(self.tables.get(own, {}).get("folders", {}))
            state = clean
        else:
            # Years and keys are asked of the delivery by their own columns; all of it is cleaned once, as it is written.
            fields = {f.name: f for f in table(name).fields}
            named = batch.select([fields[k].cleaned() for k in keys])
            touched = self._years(batch.select(fields[DATED[name]].cleaned()), DATED[name])
            # A delivered key may stand in a year that the delivery does not name.
            rest = self.known(own, set(self.tables[own]["folders"]) - touched)
            if rest is not None:
                touched |= self._years(rest.join(named.distinct(), keys, "left_semi"), DATED[name])
            state = replace_by_key(self.known(own, touched), clean, keys, named)
        touched |= self.write_years(own, state, DATED[name], touched)
        self.years[name] = sorted(touched)
        return touched

    def _years(self, df: DataFrame, date: str) -> set[str]:
        """At most a row for each year."""
        return {str(row[0]) for row in df.select(year_of(date)).distinct().collect()}

    def build(self, touched: Mapping[str, set[str]], full: bool) -> None:
        """Gold: facts of the touched years, and the dimensions."""
        state = {name: self.known(f"silver_{name}") for name in self.names}
        books_before = self.lake.read(self.before, "gold_dim_ouvrages")
        for name, built in gold_tables(self.spark, {n: df for n, df in state.items() if n not in DATED}).items():
            self.write(f"gold_{name}", built)
        for name, fact in FACTS.items():
            if name not in state:
                continue
            years = set(touched[name]) if name in touched else set()
            if name == "stocks":
                if "ouvrages" not in state:
                    continue
                # A book that has come or gone decides over positions of any year.
                books = self.known("gold_dim_ouvrages")
                if books_before is None or not _same_keys(books_before, books, "isbn"):
                    years = set(self.tables["silver_stocks"]["folders"])
            own = f"gold_{fact}"
            if own not in self.tables or full:
                years = set(self.tables[f"silver_{name}"]["folders"]) | set(self.tables.get(own, {}).get("folders", {}))
            rows = self.known(f"silver_{name}", years)
            built = gold.fact_sales(rows) if name == "ventes" else gold.fact_orders(rows) if name == "commandes" else gold.fact_stock(rows, books)
            # Facts of sales and orders are rows of silver, which lies by year; that of stocks comes from a join.
            self.write_years(own, built, DATED[name], years, laid_out=name != "stocks")
        if {"commandes", "ouvrages"} <= state.keys():
            by_publisher = gold.orders_with_publisher(self.known("gold_fact_commandes"), self.known("gold_dim_ouvrages"))
            self.write("gold_fact_commandes_editeurs", by_publisher)
        if {"ventes", "contrats", "ouvrages_auteurs"} <= state.keys():
            earned = self.known("gold_fact_ventes"), state["contrats"], state["ouvrages_auteurs"]
            self.write("gold_fact_droits", measures.royalties(*earned))
            self.write("gold_fact_droits_periodes", measures.royalty_ledger(*earned))

    @property
    def names(self) -> list[str]:
        return [name.removeprefix("silver_") for name in self.tables if name.startswith("silver_")]


def _same_keys(old: DataFrame, new: DataFrame, key: str) -> bool:
    gone, come = old.join(new, key, "left_anti"), new.join(old, key, "left_anti")
    return gone.select(key).unionByName(come.select(key)).isEmpty()


def run(spark: SparkSession, sources: Mapping[str, DataFrame], root: str, loaded_at: dt.datetime, full: bool = False) -> Increment:
    """Take the given tables (by cleaned name) over into the lake under root, and commit.

    `full` reads all of them and replaces their state; a correction that does not move the change date needs it. Within a
    delivery repeated keys stay as silver leaves them; a later delivery replaces all rows of its keys.
    """
    run_ = Run(spark, root)
    touched = {}
    for name, source in sources.items():
        touched[name] = run_.merge(name, run_.deliver(name, source, full), full)
    run_.build({name: years for name, years in touched.items() if name in DATED}, full)
    entry = recon.counted_manifest(spark, run_.delivered, loaded_at)
    past = run_.known("manifest")
    run_.write("manifest", entry if past is None else past.unionByName(entry))
    version = run_.before.version + 1
    run_.lake.commit(Commit(version, run_.tables, run_.marks))
    return Increment(version, run_.delivered, run_.years, entry)


def read(spark: SparkSession, root: str, layer: str, name: str, version: int | None = None) -> DataFrame | None:
    """A table of the newest version, or of an older one that is kept."""
    lake = Commits(spark, root)
    return lake.read(lake.latest() if version is None else lake.at(version), f"{layer}_{name}")
