"""Incremental and sliced loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.columns import literal


def high_water_mark(target: DataFrame, column: str) -> object:
    """The newest value already loaded; one number comes to the driver, None for an empty target."""
    return target.agg(F.max(column)).first()[0]


def rows_since(source: DataFrame, column: str, mark: object, strict: bool = False) -> DataFrame:
    """Rows changed since a mark.

    The mark is a literal, so the filter is pushed to Parquet or to the database. By default the mark's
    own day is read again from its start, as rows of that day may have come later, and so are rows without
    a change date, which no mark can prove to be loaded; an upsert by key absorbs the repeats.
    """
    if mark is None:
        return source
    c = F.col(column)
    kind = source.schema[column].dataType
    if not strict and isinstance(mark, dt.datetime) and isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        mark = mark.replace(hour=0, minute=0, second=0, microsecond=0)
    # The literal takes the column's type, or the column would be cast and the filter not pushed.
    bound = literal(mark, kind)
    return source.filter(c > bound if strict else since(c, bound))


def since(changed: Column, mark: Column) -> Column:
    """Changed at the mark or after it, or not known when."""
    return (changed >= mark) | changed.isNull()


def slice_predicates(column: str, values: list[object]) -> list[str]:
    """One predicate per slice plus one for what no slice names, so that no row is lost."""

    def quoted(value: object) -> str:
        return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"

    listed = [quoted(v) for v in values]
    if not listed:
        return ["1=1"]
    rest = f"{column} IS NULL OR {column} NOT IN ({', '.join(listed)})"
    return [f"{column} = {v}" for v in listed] + [rest]


def slice_counts(df: DataFrame, *by: str) -> DataFrame:
    """Rows per slice of a load."""
    return df.groupBy(*by).agg(F.count("*").alias("row_count"))
