"""Column profile of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def profile_columns(df: DataFrame, table_name: str, approx_distinct: bool = True) -> DataFrame:
    """One row per column: type, rows, nulls, minimum, maximum, longest text, about how many values.

    All columns are measured in one aggregate over one scan; the single result row is then unfolded.
    Distinct counts are sketches, because exact ones would multiply the rows by the columns.
    """
    plain = [f for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    measures: list[Column] = [F.count("*").alias("_rows")]
    entries = []
    for place, field in enumerate(plain):
        c = F.col(field.name)
        measures += [
            F.count(c).alias(f"_n{place}"),
            F.min(c).cast("string").alias(f"_lo{place}"),
            F.max(c).cast("string").alias(f"_hi{place}"),
            F.max(F.length(c.cast("string"))).alias(f"_len{place}"),
        ]
        values = [
            F.lit(place + 1).alias("ordinal"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("column_type"),
            F.col("_rows").alias("row_count"),
            (F.col("_rows") - F.col(f"_n{place}")).alias("null_count"),
            F.col(f"_lo{place}").alias("min_value"),
            F.col(f"_hi{place}").alias("max_value"),
            F.col(f"_len{place}").alias("max_length"),
        ]
        if approx_distinct:
            measures.append(F.approx_count_distinct(c).alias(f"_d{place}"))
            values.append(F.col(f"_d{place}").alias("approx_distinct"))
        entries.append(F.struct(*values))
    measured = df.agg(*measures)
    rows = measured.select(F.inline(F.array(*entries)))
    return rows.select(F.lit(table_name).alias("table_name"), "*")


def exact_distinct(df: DataFrame) -> DataFrame:
    """(column_name, exact): the number of distinct values of each column, NULL not counted.

    A column at a time, read alone: one aggregate over all would copy each row once for every column, with keys as wide as the row.
    """
    counts = [df.select(c).where(F.col(c).isNotNull()).distinct().agg(F.lit(c).alias("column_name"), F.count("*").alias("exact")) for c in df.columns]
    return reduce(DataFrame.unionByName, counts)
