"""Reconciliation: counts, control totals, balances and the load manifest."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.columns import literal
from quire.functions.types import spark_type_name
from quire.model import table
from quire.operators.merge import union_evolved
from quire.plans.measures import MONEY, SHARE, total


# 2 ** 12 counters: a standard error of 1.6 %, 4 KB.
SKETCH_BITS = 12


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table in one result; counting reads no column."""
    return union_all(
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


def manifest(tables: Mapping[str, DataFrame], extracted_at: dt.datetime, status: str = "OK") -> DataFrame:
    """One row per loaded raw table: source, rows, storage kind, time and status of the load."""
    return union_all(
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(f"bronze_{name}").alias("table_name"),
                F.lit(table(name).source).alias("source_name"),
                "row_count",
                F.lit(table(name).column_organised).alias("is_blu_source"),
                literal(extracted_at, T.TimestampNTZType()).alias("extracted_at"),
                F.lit(status).alias("status"),
            )
            for name, df in tables.items()
        ]
    )


def counted_manifest(spark: SparkSession, counts: Mapping[str, int], extracted_at: dt.datetime, status: str = "OK") -> DataFrame:
    """The manifest from rows counted while the tables were written, so that none is read again."""
    rows = [(f"bronze_{name}", table(name).source, count, table(name).column_organised, extracted_at, status) for name, count in counts.items()]
    return spark.createDataFrame(
        rows, "table_name string, source_name string, row_count bigint, is_blu_source boolean, extracted_at timestamp_ntz, status string"
    )


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column of every table: storage kind, rows, type, length, scale, nullable, code page.

    The table's rows are counted once; its declared columns are unfolded from the one result row.
    """
    parts = []
    for name, df in tables.items():
        declared = table(name)
        described = F.array(
            *[
                F.struct(
                    F.lit(place).alias("ordinal"),
                    F.lit(meta["name"]).alias("column_name"),
                    F.lit(meta["type"]).alias("column_type"),
                    F.lit(meta["length"]).alias("length"),
                    F.lit(meta["scale"]).alias("scale"),
                    F.lit(meta["nullable"]).alias("nullable"),
                    F.lit(meta["ccsid"]).alias("ccsid"),
                    F.lit(spark_type_name(meta["type"], meta["length"], meta["scale"])).alias("spark_type"),
                )
                for place, meta in enumerate(declared.metadata(), 1)
            ]
        )
        storage = "COLUMN" if declared.column_organised else "ROW"
        counted = df.agg(F.count("*").alias("row_count")).select(
            F.lit(declared.source).alias("table_name"), F.lit(storage).alias("storage"), "row_count"
        )
        parts.append(counted.select("*", F.inline(described)))
    return union_all(parts)


def file_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Files, bytes, rows and mean row size of stored tables, the largest first; each is scanned for its metadata only."""
    parts = []
    for name, df in tables.items():
        files = df.groupBy("_metadata.file_path").agg(F.max("_metadata.file_size").alias("bytes"), F.count("*").alias("row_count"))
        summed = files.agg(F.count("*").alias("files"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("bytes", "row_count")])
        parts.append(summed.select(F.lit(name).alias("table_name"), "files", "bytes", "row_count"))
    per_row = (F.col("bytes") / F.nullif("row_count", F.lit(0))).cast("decimal(18,2)").alias("bytes_per_row")
    return union_all(parts).select("*", per_row).orderBy(F.desc("bytes"), "table_name")


def distinct_sketches(df: DataFrame, load: str, columns: list[str], bits: int = SKETCH_BITS) -> DataFrame:
    """A load's distinct values as one sketch for each column: (load, column_name, row_count, sketch), to be stored beside it."""
    measured = df.agg(F.count("*").alias("_rows"), *[F.hll_sketch_agg(F.col(c).cast("string"), bits).alias(f"_s{i}") for i, c in enumerate(columns)])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("row_count"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(columns)]
    return measured.select(F.lit(load).alias("load"), F.inline(F.array(*entries)))


def merged_distinct(sketches: DataFrame) -> DataFrame:
    """Distinct values over all loads: (column_name, loads, row_count, approx_distinct); no load is read again.

    A sketch of 2 ** bits counters errs by about 1.04 / sqrt(2 ** bits); merging adds no error, the union of the loads'
    sketches is the sketch of all rows.
    """
    return sketches.groupBy("column_name").agg(
        F.count("*").alias("loads"),
        F.sum("row_count").alias("row_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"),
    )


def control_totals(df: DataFrame, name: str, ht: str, ttc: str, quantity: str, day: str) -> DataFrame:
    """Count, amounts, quantity and date range in one pass."""
    return df.agg(
        F.lit(name).alias("table_name"),
        F.count("*").alias("nb_lignes"),
        total(ht).alias("total_ht"),
        total(ttc).alias("total_ttc"),
        total(quantity, "bigint").alias("total_qte"),
        F.min(day).alias("date_min"),
        F.max(day).alias("date_max"),
    )


def load_verification(
    df: DataFrame, key: str = "isbn", day: str = "date_vente", amount: str = "montant_ht", exact: bool = True
) -> DataFrame:
    """Rows, distinct keys, date range and amount of a loaded fact; `exact=False` sketches the distinct count."""
    distinct = F.count_distinct(F.col(key)) if exact else F.approx_count_distinct(key)
    return df.agg(
        F.count("*").alias("nb_lignes"),
        distinct.alias("nb_isbn"),
        F.min(day).alias("date_min"),
        F.max(day).alias("date_max"),
        total(amount).alias("ca_total"),
    )


def invalid_rate(df: DataFrame, flag: str = "isbn_valide") -> DataFrame:
    """Invalid rows, all rows and the percentage, guarded for an empty table."""
    bad = F.count_if(~F.coalesce(F.col(flag), F.lit(False)))
    counted = df.agg(bad.alias("nb_invalides"), F.count("*").alias("nb_total"))
    pct = F.coalesce(
        F.col("nb_invalides").cast("double") * 100 / F.nullif(F.col("nb_total"), F.lit(0)), F.lit(0.0)
    )
    return counted.withColumn("pct_invalides", pct.cast(SHARE))


def amount_balance(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """One row of totals: raw, cleaned, gold, and what gold leaves out by its own rule.

    The excluded amount is summed in the same pass as the cleaned one.
    """
    kept = F.coalesce(F.col("isbn_valide"), F.lit(False))
    raw = bronze.agg(total("VEMTTTC").alias("total_bronze"))
    cleaned = silver.agg(
        total("montant_ttc").alias("total_silver"),
        total_if(~kept, "montant_ttc").alias("total_exclu"),
    )
    final = gold.agg(total("montant_ttc").alias("total_gold"))
    totals = union_evolved(raw, cleaned, final).agg(
        *[
            F.max(c).alias(c)
            for c in ("total_bronze", "total_silver", "total_gold", "total_exclu")
        ]
    )
    return totals.select(
        "total_bronze",
        "total_silver",
        "total_gold",
        "total_exclu",
        (F.col("total_bronze") - F.col("total_silver")).cast(MONEY).alias("ecart_bronze_silver"),
        (F.col("total_silver") - F.col("total_gold")).cast(MONEY).alias("ecart_silver_gold"),
    )


def total_if(condition: Column, column: str) -> Column:
    """Sum of the rows that meet a condition, zero for none."""
    return total(F.when(condition, F.col(column)))
