"""Deduplication with a total order, so that a rerun keeps the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNORDERED = (T.MapType, T.VariantType)


def keep_latest(df: DataFrame, keys: list[str], newest_by: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """One row per key: the newest by `newest_by`, ties broken by every other column.

    A `row_number() = 1` filter lets Spark cut each key to one row per input partition before the
    shuffle, so a key that holds a third of the table sends a handful of rows, not the third.
    """
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in keys and f.name not in newest_by and not isinstance(f.dataType, UNORDERED)
    ]
    order = [F.col(c).desc_nulls_last() for c in [*newest_by, *rest]]
    if not order:
        return df.dropDuplicates(keys)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def latest_with_ties(df: DataFrame, keys: list[str], newest_by: str) -> DataFrame:
    """All rows that carry the newest value of their key.

    The maximum is a hash aggregate with map-side partials. The join back is on key and value, so the
    rows of one key are spread by value, and AQE splits a value that is hot in itself.
    """
    newest = df.groupBy(*keys).agg(F.max(newest_by).alias(newest_by))
    return df.join(newest, [*keys, newest_by], "left_semi")


def collapse_report(df: DataFrame, **key_sets: list[str]) -> DataFrame:
    """How many rows each candidate key would collapse: total, distinct keys, rows lost.

    One hash aggregate per candidate key with map-side partials; only counts are brought together.
    """
    reports = []
    for name, keys in key_sets.items():
        groups = df.groupBy(*keys).agg(F.count("*").alias("_n"))
        reports.append(
            groups.agg(
                F.lit(name).alias("key_name"),
                F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_rows"),
                F.count("*").alias("distinct_keys"),
                F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("rows_lost"),
            )
        )
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out
