"""Schemas that change from delivery to delivery: what may widen does, what would lose values fails by name."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.merge import union_evolved

WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
WHOLE_ORDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
MOST_DIGITS = 38
CHANGES = "column_name string, version string, change string, type_before string, type_after string"


class SchemaConflict(ValueError):
    """Columns whose type no longer holds what earlier deliveries held."""


def widened(before: T.DataType, after: T.DataType) -> T.DataType | None:
    """The type for a column that was `before` and is delivered as `after`; None if `after` cannot hold what was there.

    Whole numbers grow into longer ones and into decimals, decimals into decimals with no fewer digits on either side of the
    point, floats into doubles, dates into timestamps, and anything without a value into anything.
    """
    if before == after:
        return after
    if isinstance(before, T.NullType):
        return after
    if isinstance(after, T.NullType):
        return before
    if type(before) in WHOLE_ORDER and type(after) in WHOLE_ORDER:
        return after if WHOLE_ORDER.index(type(after)) > WHOLE_ORDER.index(type(before)) else None
    if isinstance(after, T.DecimalType):
        scale = before.scale if isinstance(before, T.DecimalType) else 0
        whole = before.precision - scale if isinstance(before, T.DecimalType) else WHOLE_DIGITS.get(type(before), MOST_DIGITS + 1)
        return after if after.scale >= scale and after.precision - after.scale >= whole else None
    if isinstance(before, T.FloatType) and isinstance(after, T.DoubleType):
        return after
    if isinstance(before, T.DateType) and isinstance(after, (T.TimestampType, T.TimestampNTZType)):
        return after
    return None


def evolution(schemas: Mapping[str, T.StructType], renames: Mapping[str, str] | None = None) -> tuple[T.StructType, list[tuple]]:
    """The schema that holds all versions, in the order given, and what changed: rows of CHANGES.

    renames: old column name to new one. A column that a version lacks is NULL there. Changes that would lose values are listed as
    `conflict`.
    """
    names, kinds, changes = [], {}, []
    last: set[str] = set()
    for version, schema in schemas.items():
        now = {}
        for f in schema.fields:
            name = (renames or {}).get(f.name, f.name)
            if name in now:
                raise SchemaConflict(f"{version}: two columns are named {name}")
            now[name] = f.dataType
            if name != f.name:
                changes.append((name, version, f"renamed from {f.name}", f.dataType.simpleString(), f.dataType.simpleString()))
        for name, kind in now.items():
            if name not in kinds:
                names.append(name)
                if version != next(iter(schemas)):
                    changes.append((name, version, "added", None, kind.simpleString()))
                kinds[name] = kind
                continue
            wide = widened(kinds[name], kind)
            if wide is None:
                changes.append((name, version, "conflict", kinds[name].simpleString(), kind.simpleString()))
            elif wide != kinds[name]:
                changes.append((name, version, "widened", kinds[name].simpleString(), wide.simpleString()))
                kinds[name] = wide
        changes += [(name, version, "missing", kinds[name].simpleString(), None) for name in sorted(last - now.keys())]
        last = set(now)
    return T.StructType([T.StructField(name, kinds[name]) for name in names]), changes


def changes_report(spark: SparkSession, schemas: Mapping[str, T.StructType], renames: Mapping[str, str] | None = None) -> DataFrame:
    return spark.createDataFrame(evolution(schemas, renames)[1], CHANGES)


def read_evolved(frames: Mapping[str, DataFrame], renames: Mapping[str, str] | None = None) -> DataFrame:
    """The deliveries, in the order given, as one table; fails before any row is read if a type has become narrower."""
    schema, changes = evolution({version: df.schema for version, df in frames.items()}, renames)
    if lost := [f"{name} ({before} to {after} in {version})" for name, version, change, before, after in changes if change == "conflict"]:
        raise SchemaConflict("narrower or unlike types: " + ", ".join(lost))
    kinds = {f.name: f.dataType for f in schema.fields}

    def widest(df: DataFrame) -> DataFrame:
        pairs = [(f.name, (renames or {}).get(f.name, f.name)) for f in df.schema.fields]
        return df.select([F.col(f"`{old}`").cast(kinds[new]).alias(new) for old, new in pairs])

    return reduce(union_evolved, map(widest, frames.values())).select([f"`{name}`" for name in kinds])
