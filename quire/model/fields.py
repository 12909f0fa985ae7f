"""Declaring a source table: one `Field` per column, from which schema, renames and metadata follow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.dates import cyymmdd_to_date
from quire.functions.text import trim_fixed

INT_DIGITS = 9  # a longer whole number needs a long


@dataclass(frozen=True)
class Field:
    source: str
    kind: str  # char, number or cyymmdd
    name: str  # cleaned name
    length: int = 0
    scale: int = 0
    required: bool = False

    @property
    def raw_type(self) -> T.DataType:
        if self.kind == "char":
            return T.StringType()
        if self.scale:
            return T.DecimalType(self.length, self.scale)
        return T.IntegerType() if self.length <= INT_DIGITS else T.LongType()

    def cleaned(self) -> Column:
        raw = F.col(self.source)
        if self.kind == "char":
            value = trim_fixed(raw)
        elif self.kind == "cyymmdd":
            value = cyymmdd_to_date(self.source)
        else:
            value = raw.try_cast(self.raw_type)
        return value.alias(self.name)


def char(source: str, length: int, name: str, required: bool = False) -> Field:
    return Field(source, "char", name, length, 0, required)


def number(source: str, length: int, scale: int, name: str, required: bool = False) -> Field:
    return Field(source, "number", name, length, scale, required)


def day(source: str, name: str, required: bool = False) -> Field:
    return Field(source, "cyymmdd", name, 7, 0, required)


@dataclass(frozen=True)
class SourceTable:
    source: str
    name: str
    keys: tuple[str, ...]  # cleaned names
    fields: tuple[Field, ...]
    newest_by: tuple[str, ...] = ()  # cleaned names that say which copy of a key is newest
    column_organised: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f.source, f.raw_type, not f.required) for f in self.fields]
        )

    @property
    def source_columns(self) -> list[str]:
        return [f.source for f in self.fields]

    @property
    def source_keys(self) -> list[str]:
        by_name = {f.name: f.source for f in self.fields}
        return [by_name[k] for k in self.keys]

    def metadata(self) -> list[dict]:
        """The columns as discovery describes them, with the two facts cleaning needs: format and key."""
        return [
            {
                "name": f.source,
                "type": "CHAR" if f.kind == "char" else "DECIMAL",
                "length": f.length,
                "scale": f.scale,
                "nullable": not f.required,
                "ccsid": 297 if f.kind == "char" else 0,
                "format": "CYYMMDD" if f.kind == "cyymmdd" else "",
                "is_pk": f.name in self.keys,
            }
            for f in self.fields
        ]
