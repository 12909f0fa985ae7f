"""Load log, freshness and volume anomalies."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.columns import literal

MAX_AGE_HOURS = 24
TRAILING_LOADS = 7
DEVIATIONS = 3

GOLD_FACTS = ("fact_ventes", "fact_stocks", "fact_commandes", "fact_droits")


def load_entry(table_name: str, df: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """One row for the load log: which table, when, how many rows."""
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(table_name).alias("table_name"),
        literal(loaded_at, T.TimestampNTZType()).alias("loaded_at"),
        "row_count",
    )


def freshness(
    load_log: DataFrame, tables: list[str], as_of: dt.datetime, max_age_hours: int = MAX_AGE_HOURS
) -> DataFrame:
    """Last load, its rows and its age per expected table at a given moment; a table never loaded is stale.

    Of loads at the same moment the larger one counts.
    """
    moment = literal(as_of, T.TimestampNTZType())
    loaded = (
        load_log.filter(F.col("loaded_at") <= moment)
        .groupBy("table_name")
        .agg(
            F.max("loaded_at").alias("last_load"),
            F.max(F.struct("loaded_at", "row_count"))["row_count"].cast("bigint").alias("row_count"),
        )
    )
    expected = load_log.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(t) for t in tables])).alias("table_name")
    )
    age = F.timestamp_diff("SECOND", F.col("last_load"), moment)
    stale = F.col("last_load").isNull() | (age > max_age_hours * 3600)
    return expected.join(loaded, "table_name", "left").select(
        "table_name",
        "last_load",
        (age / 3600).cast("decimal(12,1)").alias("age_hours"),
        stale.alias("is_stale"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.when(stale, "STALE").otherwise("HEALTHY").alias("status"),
    )


def volume_anomalies(
    load_log: DataFrame, trailing: int = TRAILING_LOADS, deviations: int = DEVIATIONS
) -> DataFrame:
    """Rows per table and day, flagged when far from the mean of the days before.

    The window runs over daily sums. Mean and variance are compared as whole numbers, multiplied out, so
    the flag does not depend on rounding or on the order of summation.
    """
    daily = load_log.groupBy("table_name", F.to_date("loaded_at").alias("load_day")).agg(
        F.sum("row_count").cast("bigint").alias("row_count")
    )
    before = Window.partitionBy("table_name").orderBy("load_day").rowsBetween(-trailing, -1)
    n = F.col("row_count").cast("decimal(18,0)")
    seen = daily.withColumns(
        {
            "_days": F.count("*").over(before),
            "_sum": F.sum(n).over(before),
            "_squares": F.sum(n * n).over(before),
        }
    )
    distance = n * F.col("_days") - F.col("_sum")
    spread = F.col("_days") * F.col("_squares") - F.col("_sum") * F.col("_sum")
    enough = F.col("_days") >= 2
    odd = enough & (distance * distance > spread * (deviations * deviations))
    return seen.select(
        "table_name",
        "load_day",
        "row_count",
        F.when(enough, (F.col("_sum") / F.col("_days"))).cast("decimal(18,4)").alias("trailing_mean"),
        F.coalesce(odd, F.lit(False)).alias("is_anomaly"),
    )
