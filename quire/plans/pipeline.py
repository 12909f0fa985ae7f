"""All stages in order: raw tables in, bronze, silver and gold tables and the gate's report out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quire.model import table
from quire.operators.calendar import calendar
from quire.operators.clean import to_raw
from quire.operators.clustering import CLUSTER_COLUMNS
from quire.plans import gate, gold, measures, monitor, recon
from quire.plans.silver import silver
from quire.sources.sinks import overwrite, overwrite_clustered, write_json


@dataclass(frozen=True)
class Lake:
    """Parquet tables under one root folder, one folder per layer and table."""

    spark: SparkSession
    root: str
    # What was measured while a table was written, by layer and name.
    seen: dict[tuple[str, str], dict[str, int]] = field(default_factory=dict)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    def store(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Write once and read back, so that later stages never compute a table again; the rows are counted by the way."""
        seen = Observation(f"{layer} {name}")
        df = df.observe(seen, F.count(F.lit(1)).alias("_rows"))
        columns = CLUSTER_COLUMNS.get(name) if layer == "gold" else None
        present = columns and all(c in df.columns for c in columns)
        if present:
            overwrite_clustered(df, self.path(layer, name), columns)
        else:
            overwrite(df, self.path(layer, name))
        self.seen[layer, name] = seen.get
        return self.read(layer, name)

    def store_raw(self, name: str, delivered: DataFrame) -> DataFrame:
        """Bronze of a delivery. The one read of it also counts the rows and the values that do not fit their type."""
        measures = {"_rows": F.count(F.lit(1)), **gate.unreadable_measures(table(name))}
        seen = Observation(f"delivery of {name}")
        noted = delivered.observe(seen, *[measure.alias(c) for c, measure in measures.items()])
        overwrite(to_raw(noted, table(name)), self.path("bronze", name))
        self.seen["bronze", name] = seen.get
        return self.read("bronze", name)

    def unreadable(self, name: str) -> DataFrame:
        """The gate's rows on values of a delivery that bronze could not take over."""
        found = self.seen["bronze", name]
        measured = self.spark.createDataFrame([tuple(found.values())], ", ".join(f"{c} bigint" for c in found))
        return gate.unreadable_report(name, measured, table(name))

    def view(self, layer: str, name: str) -> None:
        """Offer a table to SQL as `layer_name`."""
        self.read(layer, name).createOrReplaceTempView(f"{layer}_{name}")


@dataclass(frozen=True)
class Outcome:
    bronze: dict[str, DataFrame]
    silver: dict[str, DataFrame]
    gold: dict[str, DataFrame]
    manifest: DataFrame
    report: DataFrame
    load_log: DataFrame


def gold_tables(spark: SparkSession, clean: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every gold table that the cleaned tables at hand allow."""
    out = {"dim_dates": calendar(spark)}
    if "editeurs" in clean:
        out["dim_editeurs"] = gold.dim_publisher(clean["editeurs"])
    if "auteurs" in clean:
        out["dim_auteurs"] = gold.dim_author(clean["auteurs"])
    if "ouvrages" in clean:
        out["dim_ouvrages"] = gold.dim_book(clean["ouvrages"])
    if {"collections", "editeurs"} <= clean.keys():
        out["dim_collections"] = gold.dim_collection(clean["collections"], clean["editeurs"])
    if "ref_entrepots" in clean:
        out["dim_entrepots"] = gold.dim_warehouse(clean["ref_entrepots"])
    if "ventes" in clean:
        out["fact_ventes"] = gold.fact_sales(clean["ventes"])
    if {"stocks", "ouvrages"} <= clean.keys():
        out["fact_stocks"] = gold.fact_stock(clean["stocks"], clean["ouvrages"].filter("isbn_valide"))
    if "commandes" in clean:
        out["fact_commandes"] = gold.fact_orders(clean["commandes"])
        if "ouvrages" in clean:
            out["fact_commandes_editeurs"] = gold.orders_with_publisher(out["fact_commandes"], out["dim_ouvrages"])
    if {"ouvrages_auteurs", "auteurs"} <= clean.keys():
        out["pont_ouvrages_auteurs"] = gold.book_authors(
            clean["ouvrages_auteurs"], gold.dim_author(clean["auteurs"])
        )
    if {"ventes", "contrats", "ouvrages_auteurs"} <= clean.keys():
        earned = gold.fact_sales(clean["ventes"]), clean["contrats"], clean["ouvrages_auteurs"]
        out["fact_droits"] = measures.royalties(*earned)
        out["fact_droits_periodes"] = measures.royalty_ledger(*earned)
    return out


def run(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    loaded_at: dt.datetime,
    known_books: list[gate.Expected] | None = None,
    known_authors: list[gate.Expected] | None = None,
) -> Outcome:
    """Load the given source tables (by cleaned name) through all layers.

    The load log and the manifest grow by this run under `history`; the report is written there as JSON.
    """
    lake = Lake(spark, root)
    bronze = {n: lake.store_raw(n, df) for n, df in sources.items()}
    clean = {n: lake.store("silver", n, silver(n, df)) for n, df in bronze.items()}
    built = {n: lake.store("gold", n, df) for n, df in gold_tables(spark, clean).items()}
    manifest = recon.counted_manifest(spark, {n: lake.seen["bronze", n]["_rows"] for n in bronze}, loaded_at)
    report = gate.full_gate(
        bronze, clean, built, known_books=known_books, known_authors=known_authors
    )
    report = recon.union_all([report, *(lake.unreadable(n) for n in bronze if gate.unreadable_measures(table(n)))])
    log = recon.union_all([monitor.load_entry(n, df, loaded_at) for n, df in built.items()])
    past = lake.path("history", "load_log")
    log.write.mode("append").parquet(past)
    manifest.write.mode("append").parquet(lake.path("history", "manifest"))
    write_json(report, lake.path("history", f"report-{loaded_at:%Y%m%dT%H%M%S}"))
    return Outcome(bronze, clean, built, manifest, report, spark.read.parquet(past))
